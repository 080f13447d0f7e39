"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

Encoding.  The merges of a vocabulary are compiled once (:func:`compile_merges`):
for every token the two parts of its last merge.  From them follows whether two
tokens can stand next to each other in an encoding: they can if no merge would
have crossed the seam (:meth:`Transducer.adjacent`).  The encoding of a byte
string is the only chain of tokens all of whose neighbours are compatible, so a
left-to-right machine finds it: its state is the bytes read but not yet emitted
and what the last emitted token still forbids (:meth:`Transducer.guard`), it reads one byte at a time and emits a token as
soon as every token boundary that can still be used agrees on it.  What is
pending stays within the length of the longest token.  States and transitions
are made when first met and kept, up to ``max_states``; beyond that the machine
forgets them and makes them anew, with the same output.

Decoding.  :class:`StreamDecoder` turns ids into text as they arrive; its state
is the unfinished UTF-8 sequence (at most three bytes) and its transitions, per
state and token, are made when first met.

Null text counts as empty: no tokens, and the digests of the empty string.  A very
long text is encoded piece by piece and held once with its ids.  Repeated rows are
encoded as they come, an empty table gives none, and other columns are ignored.
"""

from __future__ import annotations

import base64
import gc
from array import array

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from recurwork.llm.common import map_rows, sha256_hex

NONE, NEVER = -1, 1 << 60
#: Tokens that the decoder takes at a time.
RUN = 256


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def compile_merges(ranks: dict[bytes, int]) -> dict[int, tuple[int, int]]:
    """For each token of two bytes or more: the ids of the two parts of its last merge.

    Tokens that their own bytes do not encode to are left out; they can only
    stand for a whole piece.
    """
    parts: dict[int, tuple[int, int]] = {}
    for token, rank in ranks.items():
        if len(token) < 2:
            continue
        ids = [ranks[token[i:i + 1]] for i in range(len(token))]
        own = [token[i:i + 1] for i in range(len(token))]
        while len(own) > 2:
            best, at = min(((ranks.get(own[i] + own[i + 1], 1 << 60), i) for i in range(len(own) - 1)))
            if best >= rank:
                break
            own[at:at + 2] = [own[at] + own[at + 1]]
            ids[at:at + 2] = [best]
        if len(own) == 2:
            parts[rank] = (ids[0], ids[1])
    return parts


class Transducer:
    """Bytes in, token ids out; see the module's text."""

    def __init__(self, ranks: dict[bytes, int], parts: dict[int, tuple[int, int]], max_states: int = 1 << 19):
        self.ranks, self.parts, self.max_states = ranks, parts, max_states
        self.reachable = {t: r for t, r in ranks.items() if len(t) == 1 or r in parts}
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, self.reachable), default=1)
        self.sizes = {r: len(t) for t, r in ranks.items()}
        #: For each proper prefix of a token: the lowest rank of the tokens that extend it.
        self.open: dict[bytes, int] = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                self.open[token[:i]] = min(rank, self.open.get(token[:i], NEVER))
        self.seams: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        #: Last token, pending bytes, the tokens of these if nothing follows, for each prefix of them the token that
        #: ends it, the boundaries at which a token can start that is not yet read to its end, and the guard.
        self.states: list[tuple[int, bytes, tuple[int, ...], array, tuple[int, ...], tuple[int, ...]]] = [(NONE, b"", (), array("i", [NONE]), (), ())]
        self.index: dict[tuple, int] = {}
        self.guards: dict[tuple[int, ...], tuple[int, ...]] = {}
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]

    def right_edge(self, token: int) -> list[int]:
        """The token and the parts of it that end where it ends, longest first."""
        out = [token]
        while out[-1] in self.parts:
            out.append(self.parts[out[-1]][1])
        return out

    def adjacent(self, left: int, right: int) -> bool:
        """Whether no merge crosses the seam between the two tokens."""
        if left == NONE:
            return True
        known = self.seams.get((left, right))
        if known is not None:
            return known
        lefts, rights = self.right_edge(left), [right]
        while rights[-1] in self.parts:
            rights.append(self.parts[rights[-1]][0])
        i, j, ok = len(lefts) - 1, len(rights) - 1, True
        while True:
            crossing = self.ranks.get(self.bytes_of[lefts[i]] + self.bytes_of[rights[j]], NEVER)
            left_end = lefts[i - 1] if i else NEVER
            right_end = rights[j - 1] if j else NEVER
            # Of equal merges the leftmost goes first: the one inside the left token, then the crossing one.
            if crossing != NEVER and crossing < left_end and crossing <= right_end:
                ok = False
                break
            if i == 0 and j == 0:
                break
            if left_end <= right_end:
                i -= 1
            else:
                j -= 1
        if len(self.seams) >= self.max_states:
            self.seams.clear()
        self.seams[(left, right)] = ok
        return ok

    def guard(self, last: int, pending: bytes) -> tuple[int, ...]:
        """What of the last token can still matter: its parts at the seam that some
        token across the seam, consistent with the pending bytes, would take before
        the merge inside the last token does.  States that agree in this are one.
        """
        if last == NONE:
            return ()
        out, edge = [], self.right_edge(last)
        for k, part in enumerate(edge):
            end, text = edge[k - 1] if k else NEVER, self.bytes_of[part]
            for i in range(1, len(pending) + 1):
                over = text + pending[:i]
                if self.ranks.get(over, NEVER) < end:
                    out += part, end
                    break
                if over not in self.open:
                    break
            else:
                if self.open.get(text + pending, NEVER) < end:
                    out += part, end
        return self.guards.setdefault(tuple(out), tuple(out))

    def chain(self, ends: list[int], at: int) -> list[int]:
        """The tokens of the prefix that ends at ``at``."""
        out, sizes = [], self.sizes
        while at:
            token = ends[at]
            out.append(token)
            at -= sizes[token]
        out.reverse()
        return out

    def make_step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        last, pending, _, ends, starts, guard = self.states[state]
        pending += bytes((byte,))
        size, open_, token_of, token = len(pending), self.open, self.reachable.get, NONE
        live = []
        for at in (*starts, size - 1):  # what starts at any other boundary is read to its end
            text = pending[at:]
            if token == NONE:  # only one token ends the chain of all that is pending
                found = token_of(text)
                if found is not None and self.adjacent(ends[at] if at else last, found):
                    token = found
            if text in open_:
                live.append(at)
        ends = [*ends, token]
        whole = self.chain(ends, size)
        emit = len(whole)
        for at in live:
            other, same = self.chain(ends, at), 0
            for x, y in zip(whole[:emit], other):
                if x != y:
                    break
                same += 1
            emit = same
            if not emit:
                break
        out, rest = tuple(whole[:emit]), tuple(whole[emit:])
        if out:
            cut = sum(map(self.sizes.__getitem__, out))
            last, pending = out[-1], pending[cut:]
            ends, live = [NONE, *ends[cut + 1:]], [at - cut for at in live]  # all live boundaries are past the cut
        if out or guard:  # else what does not matter now will not matter later
            guard = self.guard(last, pending)
        key = (guard, pending)
        to = self.index.get(key)
        if to is None:
            to = self.index[key] = len(self.states)
            self.states.append((last, pending, rest, array("i", ends), tuple(live), guard))
            self.steps.append({})
        self.steps[state][byte] = (to, out)
        return to, out

    def encode(self, piece: bytes) -> list[int]:
        if len(self.states) > self.max_states:
            self.forget()
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        state, steps = 0, self.steps
        for byte in piece:
            step = steps[state].get(byte)
            state, emitted = step if step is not None else self.make_step(state, byte)
            if emitted:
                out.extend(emitted)
        out.extend(self.states[state][2])
        return out


class StreamDecoder:
    """Token ids to text as they arrive; ill-formed bytes become U+FFFD."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        #: By unfinished sequence and token: the text that is complete now, and what is unfinished now.
        self.rows: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}
        #: Of these, the tokens that leave nothing unfinished and follow nothing unfinished.
        self.whole: dict[int, str] = {}
        for token in bytes_of:
            text, rest = self.step(b"", token)
            if not rest:
                self.whole[token] = text

    def step(self, held: bytes, token: int) -> tuple[str, bytes]:
        data = held + self.bytes_of[token]
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):  # an unfinished sequence starts with its lead byte
            lead = data[-back]
            if lead >= 0xC0:
                need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                if need > back:
                    cut = len(data) - back
                break
            if lead < 0x80:
                break
        out = data[:cut].decode("utf-8", "replace"), data[cut:]
        self.rows.setdefault(held, {})[token] = out
        self.rows.setdefault(out[1], {})
        return out

    def decode(self, ids: list[int]) -> str:
        out: list[str] = []
        held, whole = b"", self.whole.__getitem__
        for at in range(0, len(ids), RUN):
            run = ids[at:at + RUN]
            if not held:
                try:
                    out.append("".join(map(whole, run)))
                    continue
                except KeyError:  # some token ends inside a character
                    pass
            for token in run:
                text, held = self.rows[held].get(token) or self.step(held, token)
                out.append(text)
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out)


class Codec:
    """The transducer and decoder of one vocabulary, with a bounded memory of pieces.

    A piece is remembered among the ``young`` when first met and for good when met
    again; either memory is emptied when full.
    """

    def __init__(self, ranks: dict[bytes, int], parts: dict[int, tuple[int, int]], pattern: str, max_pieces: int = 1 << 18, max_states: int = 1 << 19):
        self.machine = Transducer(ranks, parts, max_states)
        self.decoder = StreamDecoder(self.machine.bytes_of)
        self.pattern, self.compiled, self.max_pieces = pattern, None, max_pieces
        #: Ids as four bytes each.
        self.pieces: dict[str, bytes] = {}
        self.young: dict[str, bytes] = {}
        self.decimal = {r: str(r) for r in ranks.values()}

    def __reduce__(self):
        return Codec, (self.machine.ranks, self.machine.parts, self.pattern, self.max_pieces, self.machine.max_states)

    def unknown(self, piece: str) -> bytes:
        ids = self.young.pop(piece, None)
        if ids is not None:
            if len(self.pieces) >= self.max_pieces:
                self.pieces.clear()
            self.pieces[piece] = ids
            return ids
        ids = array("I", self.machine.encode(piece.encode("utf-8", "surrogatepass"))).tobytes()
        if len(piece) <= 64:
            if len(self.young) >= self.max_pieces // 2:
                self.young.clear()
            self.young[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        if self.compiled is None:
            self.compiled = regex.compile(self.pattern)
        known, unknown = self.pieces.get, self.unknown
        found = (m.group() for m in self.compiled.finditer(text)) if len(text) > 1 << 20 else self.compiled.findall(text)
        return array("I", b"".join([known(p) or unknown(p) for p in found])).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.decoder.decode(ids)

    def joined(self, ids: list[int]) -> str:
        return ",".join(map(self.decimal.__getitem__, ids))


def codec(path: str, pattern: str, max_pieces: int = 1 << 18, max_states: int = 1 << 19) -> Codec:
    ranks = read_ranks(path)
    return Codec(ranks, compile_merges(ranks), pattern, max_pieces, max_states)


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_documents(spark: SparkSession, docs: DataFrame, path: str, pattern: str, max_pieces: int = 1 << 18, max_states: int = 1 << 19) -> DataFrame:
    """Ids and digests of every text: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    The vocabulary (a file of fixed size, read on the driver) is broadcast; a
    worker keeps its machine from task to task.  ``max_pieces`` and ``max_states``
    bound what it remembers (about 0.7 GB a worker by default); less makes it
    slower and changes no result.
    """
    shared = spark.sparkContext.broadcast(codec(path, pattern, max_pieces, max_states))

    def run(columns: list[list]) -> list[list]:
        own = shared.value
        counts, ids_hex, back_hex = [], [], []
        gc.disable()  # the machine's tables hold no cycles, and looking for some costs more than encoding
        try:
            for text in columns[1]:
                ids = own.encode(text or "")
                counts.append(len(ids))
                ids_hex.append(sha256_hex(own.joined(ids).encode()))
                back_hex.append(sha256_hex(own.decode(ids).encode("utf-8", "surrogatepass")))
        finally:
            gc.enable()
        return [columns[0], counts, ids_hex, back_hex]

    return map_rows(docs.select("doc_id", "text"), run, SCHEMA, ARROW)
