import base64
import hashlib
import json
import re

import pytest

from recurwork.llm import secrets

KEYWORDS = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain(text):
    """The base kinds by the words of the contract."""
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(KEYWORDS, text, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def tlv(tag, body):
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")) + body


RSA = tlv(0x30, tlv(2, b"\0") + b"".join(tlv(2, bytes([1 + i] * 40)) for i in range(8)))
PKCS8 = tlv(0x30, tlv(2, b"\0") + tlv(0x30, tlv(6, b"\x2a\x86\x48") + tlv(5, b"")) + tlv(4, RSA))
SEC1 = tlv(0x30, tlv(2, b"\1") + tlv(4, bytes(range(32))) + tlv(0xA0, tlv(6, b"\x2a\x86\x48\xce\x3d")))
SPKI = tlv(0x30, tlv(0x30, tlv(6, b"\x2a\x86\x48") + tlv(5, b"")) + tlv(3, bytes(100)))


def ssh_string(b):
    return len(b).to_bytes(4, "big") + b


SSH = b"openssh-key-v1\0" + ssh_string(b"none") + ssh_string(b"none") + ssh_string(b"") + (1).to_bytes(4, "big") + ssh_string(b"pub" * 9) + ssh_string(b"priv" * 20)


def segment(o):
    return base64.urlsafe_b64encode(json.dumps(o).encode()).decode().rstrip("=")


def b64(b):
    return base64.b64encode(b).decode()


@pytest.mark.parametrize(("text", "kinds"), [
    ("key " + b64(RSA), ["private_key"]), ("key " + b64(PKCS8) + " end", ["private_key"]), (b64(SEC1), ["private_key"]),
    ("x " + RSA.hex().upper(), ["private_key"]), (b64(SSH), ["ssh_key"]),
    ("-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(RSA).decode() + "-----END RSA PRIVATE KEY-----", ["private_key"]),
    (segment({"alg": "HS256"}) + "." + segment({"sub": 1}) + ".c2lnbmF0dXJl", ["signed_token"]),
    (segment({"alg": "none"}) + "." + segment({"sub": 1}) + ".", ["signed_token"]),
    # what only looks so
    (b64(SPKI), []), (b64(RSA[:-1] + b""), []), (b64(RSA + b"\0"), []), (b64(bytes(range(200))), []), (b64(SSH[:-3]), []),
    (segment({"alg": "HS256"}) + "." + segment({"sub": 1}) + ".", []), (segment({"typ": "JWT"}) + "." + segment({"sub": 1}) + ".c2ln", []),
    ("eyJhbGciOiJ.eyJzdWIiOjF9.c2ln", []), ("A" * 60, []), ("", []),
])
def test_structure(text, kinds):
    assert [k for _, _, k in secrets.scan(text) if k not in secrets.BASE] == kinds


def test_public_key_in_hex_is_only_hex():
    assert [k for *_, k in secrets.scan(SPKI.hex())] == ["hex"]


CASES = ["token=abcdef", "Token : 'abc'", "token=token :abcdefg", "API_KEY=\"a.b-c/d+e=\"", "passwd  =  123456 token=zzzzzz", "AKIA" + "A" * 16,
         "AKIA" + "A" * 15, "AKIAAKIA" + "B" * 20, "f" * 24, "f" * 23, "é" * 5 + "a1" * 20, "apikey:xxxxxxapi_key:yyyyyy", "ſecret=abcdefgh",
         "secret=" + "ab" * 30, "token=" * 5000, "a" * 200_000, "password=" + " " * 5000 + "x" * 9]


def test_base_spans_as_in_the_contract(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(CASES)], "doc_id long, text string, spans string")
    for r in secrets.find_secrets(df).collect():
        want = plain(CASES[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [want.count(k + ":") for k in ("assign", "access", "hex")]


def test_documents_keep_base_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: plain(r.text) for r in docs.collect()}
    got = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    assert any(want.values()) and got.keys() == want.keys()
    assert all(hashlib.sha256(want[i].encode()).hexdigest() == got[i].base_sha256 for i in want)


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "token=abcdef"), (2, "token=abcdef")], "doc_id long, text string")
    rows = secrets.find_secrets(df).collect()
    assert sorted(r.spans for r in rows) == ["", "", "", "assign:0:12", "assign:0:12"]
    assert secrets.find_secrets(df.limit(0)).count() == 0


def test_redaction_takes_effect_and_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, "a token=abcdefgh z", "k", 18), (2, None, None, None), (3, "clean", "", 5), (4, "secret=" + "ab" * 20, "", 47)],
                               "doc_id long, text string, key string, n_chars long")
    rows = {r.doc_id: r for r in secrets.redact_documents(df).collect()}
    assert rows[1].text == "a [SECRET] z" and rows[1].n_chars == 12 and rows[1].key == "k"
    assert rows[2].text is None and rows[3].text == "clean" and rows[4].text == "[SECRET]"


def wrapped(digits, width, end):
    return end.join(digits[i:i + width] for i in range(0, len(digits), width))


SMALLEST = tlv(0x30, tlv(2, b"\0") + tlv(0x30, tlv(6, b"\x2a")) + tlv(4, b""))  # the least that the parser accepts, near enough
PLAIN_SEC1 = tlv(0x30, tlv(2, b"\1") + tlv(4, bytes(range(32))))


@pytest.mark.parametrize("end", ["\n", "\r\n", "\\n", "\\r\\n", "\\\\n", "\n    "])
@pytest.mark.parametrize(("data", "kind"), [(RSA, "private_key"), (PKCS8, "private_key"), (SEC1, "private_key"), (SSH, "ssh_key")])
def test_keys_over_lines(data, kind, end):
    for width in (64, 76, 50):
        lines = wrapped(b64(data), width, end)
        block = f"-----BEGIN PRIVATE KEY-----{end}{lines}{end}-----END PRIVATE KEY-----"
        assert secrets.scan('{"private_key": "' + block + '"}') == [(17, 17 + len(block), kind)]
        for before, after in (("", ""), ("see ", " and on"), (f"first{end}", f"{end}last word"), ('k="', f'{end}"')):
            got = secrets.scan(before + lines + after)
            assert got == [(len(before), len(before + lines), kind)], (width, before, after)
    assert not [k for *_, k in secrets.scan(wrapped(b64(data[:-1]), 64, end) + ".") if k not in secrets.BASE]


@pytest.mark.parametrize("data", [PLAIN_SEC1, SMALLEST])
def test_smallest_structures(data):
    assert len(PLAIN_SEC1) == 39
    for digits in (b64(data), b64(data).rstrip("="), data.hex().upper(), "x " + b64(data) + " y"):
        assert [k for *_, k in secrets.scan(digits) if k not in secrets.BASE] == ["private_key"]
    assert secrets.scan("x" + b64(data)) == secrets.scan(b64(data) + "x" if not b64(data).endswith("=") else "x") == []


def test_escaped_digits_and_redaction():
    digits = b64(bytes(RSA)).replace("/", "\\/").replace("=", "\\u003d")
    assert secrets.scan('"' + digits + '"') == [(1, 1 + len(digits), "private_key")]
    assert secrets.redact("a\n" + wrapped(b64(RSA), 64, "\n") + "\nz", "[X]") == "a\n[X]\nz"


def test_public_key_over_lines_is_not_reported():
    assert secrets.scan(wrapped(b64(SPKI), 64, "\n")) == []
    assert secrets.scan("-----BEGIN PUBLIC KEY-----\\n" + wrapped(b64(SPKI), 64, "\\n") + "\\n-----END PUBLIC KEY-----") == []


def pem(data, label="PRIVATE KEY"):
    return f"-----BEGIN {label}-----\n{wrapped(b64(data), 64, chr(10))}\n-----END {label}-----\n"


@pytest.mark.parametrize("data", [RSA, PKCS8, SEC1])
def test_armour_that_is_encoded_as_a_whole(data):
    block = pem(data)
    for whole in (block, block.rstrip("\n"), pem(SPKI, "CERTIFICATE") + block):
        for digits in (b64(whole.encode()), whole.encode().hex().upper(), wrapped(b64(whole.encode()), 76, "\n  ")):
            for before, after in (("", ""), ("tls.key: ", "\nkind: Secret and more"), ('"', '"')):
                got = [s for s in secrets.scan(before + digits + after) if s[2] not in secrets.BASE]
                assert got == [(len(before), len(before + digits), "private_key")], (before, digits[-20:])
    for whole in (pem(SPKI, "PUBLIC KEY"), block.replace("M", "N"), block[:-20], "-----BEGIN " * 2000):
        assert not [s for s in secrets.scan(b64(whole.encode())) if s[2] not in secrets.BASE]


@pytest.mark.parametrize(("first", "line"), [("", "> {}\n"), ("", "  | {}\n"), ('k = "', '{}\\n" +\n    "'), ("k = '", "{}' \\\n  '"), ("", "# {}\n"), ('["', '{}",\n "')])
def test_quoted_lines_and_literals(first, line):
    text = first + "".join(line.format(part) for part in pem(RSA).splitlines())
    at, end = text.index("-----BEGIN"), text.rindex("-----") + 5
    assert secrets.scan(text) == [(at, end, "private_key")]
    digits = wrapped(b64(RSA), 64, "\n").splitlines()
    text = first + "".join(line.format(part) for part in digits)
    assert secrets.scan(text) == [(text.index(digits[0]), text.index(digits[-1]) + len(digits[-1]), "private_key")]


def raw(text):
    return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")


@pytest.mark.parametrize("head", ['{ "alg": "RS256" }', '{\n  "alg": "RS256"}', ' {"alg":"RS256"}', '\t{"alg":"RS256"}', '\r\n{"alg":"RS256"}', '{\r\n"alg":"RS256"}'])
def test_tokens_whose_json_holds_white_space(head):
    token = raw(head) + "." + raw('\n{ "sub": 1 }') + ".c2ln"
    for before in ("", "Internal.address.", "see ", "Cookie.of."):
        assert secrets.scan(before + token) == [(len(before), len(before + token), "signed_token")]
    assert secrets.scan("x" + token) == secrets.scan("Internal.address.example and Internet.words.e.g.") == []


def test_folds_are_linear():
    for text in (b64(RSA)[:40] + " " * 300_000, (b64(RSA)[:40] + "\n") * 5000, "LS0tLS1CRUdJTiAg " * 20_000, "eyJh." * 60_000, "-----BEGIN A-----" * 20_000):
        assert [s for s in secrets.scan(text) if s[2] not in secrets.BASE] == []
