import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from recurwork.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ours():
    return bpe.codec(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def theirs():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text("aeinrstho' \n\té😀1", max_size=80))
def test_any_text(ours, theirs, text):
    ids = ours.encode(text)
    assert ids == theirs.encode_ordinary(text) and ours.decode(ids) == text


def test_long_words(ours, theirs):
    r = random.Random(1)
    for n in (1, 50, 3000):
        for alphabet in ("a", "ab", "theinrs", "日本語", "é̀"):
            text = "".join(r.choice(alphabet) for _ in range(n))
            assert ours.encode(text) == theirs.encode_ordinary(text)


def test_forgetting_states_changes_nothing(theirs):
    ranks = bpe.read_ranks(PATH)
    small = bpe.Transducer(ranks, bpe.compile_merges(ranks), max_states=20)
    r = random.Random(2)
    for _ in range(300):
        word = "".join(r.choice("aeionrstlhd") for _ in range(r.randrange(1, 30)))
        assert small.encode(word.encode()) == theirs.encode_ordinary(word)


def test_lookahead_stays_within_the_longest_token(ours):
    ours.encode("".join(random.Random(3).choice("aeionrst") for _ in range(5000)))
    assert max(len(s[1]) for s in ours.machine.states) <= ours.machine.longest


def test_decoder_takes_characters_in_pieces(ours):
    for text in ("é", "日本", "😀x😀", "á"):
        ids = [ours.machine.ranks[bytes([b])] for b in text.encode()]
        assert ours.decode(ids) == text
    assert ours.decode([ours.machine.ranks[bytes([b])] for b in b"a\xe6\x97"]) == "a�"
    assert ours.decode([]) == ""


def test_documents(spark, theirs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(-1, None), (-2, ""), (-3, " word" * 100_000), (None, "x"), (-4, "y"), (-4, "y")], "doc_id long, text string")
    docs = docs.union(more).selectExpr("*", "1 AS n_tokens")
    found = bpe.encode_documents(spark, docs, PATH, P.PATTERN).collect()
    texts = {(r.doc_id): r.text or "" for r in docs.collect()}
    assert len(found) == docs.count()
    for r in found:
        ids = theirs.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert bpe.encode_documents(spark, docs.limit(0), PATH, P.PATTERN).count() == 0
