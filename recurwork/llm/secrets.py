"""Secret scan with structural confirmation.

Patterns find the base kinds (``assign``, ``access``, ``hex``).  Runs of base64
or hex digits and dotted triples are only candidates: they are decoded and
reported when their structure holds,

* ``signed_token``: header and payload are JSON objects, white space before and in
  them or not, the header names an algorithm, and a signature follows unless that is "none";
* ``private_key``: DER whose nested lengths add up exactly and whose members are
  those of a PKCS#1, PKCS#8 (plain or encrypted) or SEC 1 private key, in a run
  of base64, in hex, or between the lines of a PEM block, which may be in base64 or hex
  as a whole (also after blocks without a key);
* ``ssh_key``: the OpenSSH private key container with all inner lengths in place.

A key may be wrapped over lines, its line ends written out or as escapes (``\\n`` in
JSON and env files), each line quoted (``> ``) or a string literal of its own, with or
without armour.  Its own lengths say where it ends, so
there is no least length besides that of the structures, and what follows on the next
line does not matter; more digits in the same run do.

Public keys and random digits are not reported.  Positions are code points, the
end exclusive.  Null text counts as empty; texts are read whole; repeated rows
are scanned as they come; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurwork.llm.common import map_rows, sha256_hex, slices

# The base patterns, with the fewest characters that count, in the order of report.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # whole runs, so the same as [0-9a-f]+ of 24 or more
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "signed_token", "private_key", "ssh_key")
BASE = KINDS[:3]

#: Three dotted runs, the first of which begins like an object or white space; only the first is consumed.
TOKEN = re.compile(r"[eICD](?<![A-Za-z0-9_-].)[A-Za-z0-9_-]{7,}+(?=\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]*+))")
#: Between digits of a key: white space, and \n, \r and \t as escapes, escaped more than once too; JSON may escape / and =.
GAP = r"\s|\\++(?:[nrt]|(?=[\s/]))"
PAD = r"=|\\++u003[dD]"
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,40})-----((?:[^-]++|-(?!----))*+)-----END \1-----")
#: A block that may go on: what a longer part of the text can turn into one.
PEM_BEGUN = re.compile(r"-----BEGIN [A-Z0-9 ]{1,40}-----(?:[^-]++|-(?!----))*+(?:-{5}(?:E|EN|END|END [A-Z0-9 ]{0,40}-{0,5})?)?")
PAD_ESCAPE = re.compile(r"\\+u003[dD]")
#: A line end between string literals or behind marks of quoting, which may stand between digits too.
FOLD = r"""(?:\\++[nrt])*+["'`]?[ \t]*+(?:[+,.&\\][ \t]*+)?\r?\n[ \t>|\#*]*+["'`]?"""
GAPS = re.compile(rf"(?:{FOLD}|(?:{GAP})++)++")
PADS = re.compile(rf"(?:{PAD}){{0,2}}")
PADS_BEYOND = re.compile(rf"(?:{GAP})+(?:{PAD}){{1,2}}(?!{PAD})")
RUN64, RUN16 = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(r"[0-9A-Fa-f]+")
#: Where a key may begin, not within a run: a DER sequence or the name of the container, in base64 and in hex.
STARTS64 = (("M", re.compile(r"M(?:(?<![A-Za-z0-9+/_-]M)|(?<=\\[nrt]M))[A-I]")),
            ("b3Blbn", re.compile(r"b3Blbn(?:(?<![A-Za-z0-9+/_-]b3Blbn)|(?<=\\[nrt]b3Blbn))")))
STARTS16 = (("30", re.compile(r"30(?:(?<![0-9A-Fa-f]30)|(?<=\\[nrt]30))[0-8]")),
            ("6", re.compile(r"6[fF]70656[eE](?:(?<![0-9A-Fa-f].{8})|(?<=\\[nrt].{8}))")))
#: Where an encoded block of armour may begin.
ARMOUR64 = ("LS0tLS1CRUdJTi", re.compile(r"LS0tLS1CRUdJTi(?:(?<![A-Za-z0-9+/_-].{14})|(?<=\\[nrt].{14}))"))
ARMOUR16 = ("424547494", re.compile(r"(?:2[dD]){5}424547494[eE]20(?:(?<![0-9A-Fa-f].{22})|(?<=\\[nrt].{22}))"))
MAGIC = b"openssh-key-v1\0"
FIRST = 18  # bytes read to see whether more are worth it: a header, the first tags, the container's name

Span = tuple[int, int, str]


def bare(text: str) -> str:
    """The digits without gaps and escapes."""
    return GAPS.sub("", PAD_ESCAPE.sub("=", text))


def decode64(text: str) -> bytes | None:
    text = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def members(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of each element of a DER series, None unless the lengths fill ``data`` exactly."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, n, at = data[at], data[at + 1], at + 2
        if n >= 0x80:
            size = n & 0x7F
            if not 1 <= size <= 4 or at + size > len(data):
                return None
            n, at = int.from_bytes(data[at:at + size], "big"), at + size
            if n < 0x80:  # DER asks for the short form
                return None
        if at + n > len(data):
            return None
        out.append((tag, data[at:at + n]))
        at += n
    return out


INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def is_private_der(data: bytes) -> bool:
    outer = members(data)
    if outer is None or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    inner = members(outer[0][1])
    if not inner:
        return False
    tags = [t for t, _ in inner]
    if len(inner) >= 9 and tags[:9] == [INTEGER] * 9 and inner[0][1] in (b"\0", b"\1"):
        return all(len(v) > 0 for _, v in inner[:9])  # PKCS#1
    algorithm = next((members(v) for t, v in inner[:2] if t == SEQUENCE), None)
    named = bool(algorithm) and algorithm[0][0] == OID
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and inner[0][1] in (b"\0", b"\1"):
        return named  # PKCS#8
    if tags == [SEQUENCE, OCTETS]:
        return named and len(algorithm) == 2  # PKCS#8, encrypted
    return tags[:2] == [INTEGER, OCTETS] and inner[0][1] == b"\1" and len(inner[1][1]) in (28, 32, 48, 66)  # SEC 1


def ssh_size(data: bytes) -> int | None:
    """The size of the container that ``data`` begins with, or at least so many bytes as tell more of it; None if it is none."""
    at, left, keys = len(MAGIC), 3, False  # cipher, key derivation and its options; then the keys
    if not data.startswith(MAGIC):
        return None
    while left or not keys:
        if at + 4 > len(data):
            return at + 4
        n = int.from_bytes(data[at:at + 4], "big")
        at += 4
        if left:
            if keys and not n:
                return None
            at, left = at + n, left - 1
        elif 1 <= n <= 64:
            left, keys = n + 1, True
        else:
            return None
    return at


def is_ssh_key(data: bytes) -> bool:
    return ssh_size(data) == len(data)


def der_size(data: bytes) -> int | None:
    """The size of the DER sequence that ``data`` begins with."""
    if len(data) < 2 or data[0] != SEQUENCE:
        return None
    n, size = data[1], 0
    if n >= 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or len(data) < 2 + size:
            return None
        n = int.from_bytes(data[2:2 + size], "big")
    inner = data[2 + size:2 + size + 2]
    return 2 + size + n if inner[:1] == bytes([SEQUENCE]) or inner == b"\2\1" else None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    parts = []
    for text in (header, payload):
        try:
            parts.append(json.loads(decode64(text) or b""))
        except (ValueError, RecursionError):
            return False
    if not all(isinstance(p, dict) for p in parts) or not isinstance(parts[0].get("alg"), str):
        return False
    return bool(signature) or parts[0]["alg"].lower() == "none"


def kind_of_key(data: bytes | None) -> str | None:
    if not data:
        return None
    return "ssh_key" if is_ssh_key(data) else "private_key" if is_private_der(data) else None


def digits_at(text: str, at: int, n: int, run: re.Pattern) -> tuple[str, int]:
    """The next n digits, or as many as there are, over gaps; and where they end."""
    parts: list[str] = []
    end = at
    while n > 0 and (m := run.match(text, at, at + n)):
        parts.append(m[0])
        n, at = n - len(m[0]), m.end()
        end = at
        if n > 0 and (gap := GAPS.match(text, at)):
            at = gap.end()
    return "".join(parts), end


def decode16(text: str) -> bytes | None:
    return bytes.fromhex(text[:len(text) // 2 * 2])


def key_at(text: str, at: int, hexed: bool) -> Span | None:
    """The key that begins here."""
    run, decode = (RUN16, decode16) if hexed else (RUN64, decode64)
    need = FIRST
    while True:
        n = 2 * need if hexed else -(-4 * need // 3)
        digits, end = digits_at(text, at, n, run)
        short = len(digits) < n
        data = decode(digits if hexed or len(digits) % 4 != 1 else digits[:-1]) or b""
        size = ssh_size(data) if data.startswith(MAGIC) else der_size(data)
        if size is None or size > len(text) - at or short and size > len(data):  # a byte takes more than a digit
            return None
        if size == need:
            break
        need = size
    if not (kind := kind_of_key(data[:size])) or run.match(text, end):
        return None
    if not hexed and (pads := PADS.match(text, end)):
        if pads.end() == end and n % 4 and (beyond := PADS_BEYOND.match(text, end)):
            pads = beyond
        end = pads.end()
    return at, end, kind


def encoded_armour_at(text: str, at: int, hexed: bool) -> Span | None:
    """The encoded blocks of armour that begin here, up to the last one that holds a key and the line ends after it."""
    run, decode = (RUN16, decode16) if hexed else (RUN64, decode64)
    n = 256
    while True:
        digits, _ = digits_at(text, at, n, run)
        told = (decode(digits if hexed or len(digits) % 4 != 1 else digits[:-1]) or b"").decode("latin-1")
        done, kind, size = 0, None, 0
        while m := PEM.match(told, done):
            done = m.end() + len(told) - m.end() - len(told[m.end():].lstrip("\r\n"))
            if own := kind_of_key(decode64(bare(m[2]))):
                kind, size = own, done
        if len(digits) < n or done < len(told) and not PEM_BEGUN.fullmatch(told, done) and not "-----BEGIN ".startswith(told[done:]):
            break
        n *= 2
    if kind is None:
        return None
    _, end = digits_at(text, at, 2 * size if hexed else -(-4 * size // 3), run)
    return at, end if hexed else PADS.match(text, end).end(), kind


def encoded_armour_of(text: str) -> list[Span]:
    """The keys whose armour is itself in base64 or hex."""
    found: list[Span] = []
    for hexed, (literal, pattern) in ((False, ARMOUR64), (True, ARMOUR16)):
        done = 0
        for m in pattern.finditer(text) if literal in text else ():
            if m.start() >= done and (key := encoded_armour_at(text, m.start(), hexed)):
                found.append(key)
                done = key[1]
    return found


def tokens_of(text: str) -> list[Span]:
    found: list[Span] = []
    done = 0
    for m in TOKEN.finditer(text):
        if m.start() >= done and is_signed_token(m[0], m[1], m[2]):
            done = m.end(2)
            found.append((m.start(), done, "signed_token"))
    return found


def keys_of(text: str, at: list[Span]) -> list[Span]:
    """The keys without armour; ``at`` are those with it."""
    found: list[Span] = []
    for hexed, starts in ((False, STARTS64), (True, STARTS16)):
        for literal, pattern in starts:
            done = 0
            for m in pattern.finditer(text) if literal in text else ():
                if m.start() >= done and not any(a <= m.start() < b for a, b, _ in at) and (key := key_at(text, m.start(), hexed)):
                    found.append(key)
                    done = key[1]
    return found


def scan(text: str) -> list[Span]:
    """All spans of a text by start, then kind."""
    found: list[Span] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += ((*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST)
    if "AKIA" in text:
        found += ((*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST)
    found += ((*m.span(), "hex") for m in HEX.finditer(text))
    found += tokens_of(text)
    armoured = [(*m.span(), kind) for m in PEM.finditer(text) if (kind := kind_of_key(decode64(bare(m[2]))))] if "-----BEGIN " in text else []
    armoured += encoded_armour_of(text)
    found += armoured
    found += keys_of(text, armoured)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                   ("base_sha256", pa.string()), ("spans", pa.string()), ("n_confirmed", pa.int64())])


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: its spans and their counts; no shuffle."""

    def run(columns: list[list]) -> list[list]:
        out: list[list] = [columns[0], [], [], [], [], [], []]
        for text in columns[1]:
            spans = scan(text or "")
            kinds = [s[2] for s in spans]
            for column, kind in zip(out[1:4], BASE, strict=True):
                column.append(kinds.count(kind))
            out[4].append(sha256_hex(listed([s for s in spans if s[2] in BASE]).encode()))
            out[5].append(listed(spans))
            out[6].append(sum(k not in BASE for k in kinds))
        return out

    return map_rows(docs.select("doc_id", "text"), run, SCHEMA, ARROW)


def redact(text: str | None, mark: str) -> str | None:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    if not text:
        return text
    out, at = [], 0
    for a, b, _ in scan(text):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


def redact_documents(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with secrets replaced in ``text`` (null stays null) and ``n_chars`` recounted; all rows and columns stay."""

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in slices(batch):
                clean = [redact(t, mark) for t in part.column(at).to_pylist()]
                yield part.set_column(at, part.schema.field(at), pa.array(clean, type=part.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
