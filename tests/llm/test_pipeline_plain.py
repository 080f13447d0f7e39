"""Stages of the pipeline against versions that share no code with them."""

import random
import re
from math import exp, isclose

import corpus_pipeline
import public_tokenizers as P
import tiktoken
from test_ngram_join import brute
from test_secrets import KEYWORDS

from recurwork.llm import bpe, langid
from recurwork.llm.common import table

SF = "/root/testdata/sf0.001"


def test_bound_follows_the_number_of_languages():
    assert [round(langid.least_score(n, 1 / 3), 4) for n in (1, 2, 3, 4, 10)] == [1, 0.6667, 0.5556, 0.5, 0.4]


def test_language_rejects_what_two_languages_cannot_tell(spark):
    r = random.Random(5)
    words = {"de": "der die das und nicht".split(), "en": "the and that not with".split()}
    both = words["de"] + words["en"]
    train = [(i, " ".join(r.choices(words[lang] if i < 200 else both, k=12)), lang) for i in range(400) for lang in [r.choice(["de", "en"])]]
    odd = [(1000 + i, t, None) for i, t in enumerate(("кжщ", "der the", "qqq", "1 2", "das nicht"))]
    df = spark.createDataFrame(train + odd, "doc_id long, text string, lang string")
    model, (letters, hashes) = langid.learn(spark, df), langid.tables()

    def plain_score(text):
        words = "".join(c.lower() if c.isalpha() else " " for c in text)
        words = re.sub(" +", " ", words)
        counts = {}
        for n in (1, 2, 3):
            for i in range(len(words) - n + 1):
                code = 0
                for c in words[i:i + n]:
                    code = (code * 0x9E3779B1 + int(hashes[ord(c)])) % 2**32
                at = ((code ^ code >> 15) * 0x9E3779B1) % 2**32 >> 17
                counts[at] = counts.get(at, 0) + 1
        x = {at: n * model.idf[at] for at, n in counts.items()}
        norm = sum(v * v for v in x.values()) ** 0.5
        logits = [(sum(v / norm * model.weights[at, k] for at, v in x.items()) + model.bias[k]) / model.temperature for k in range(2)]
        return 1 / (1 + exp(min(700, -abs(logits[0] - logits[1]))))

    want = {i for i, t, _ in train + odd if any(c.isalpha() for c in t) and plain_score(t) >= 2 / 3}
    kept = {r.doc_id for r in langid.keep_identified(spark, df).collect()}
    unsure = [i for i, t, _ in train if plain_score(t) < 2 / 3]  # a score of two is never under a half
    assert kept == want and len(unsure) > 20 and not kept & set(unsure)
    assert isclose(model.predict(langid.grams("qqq", (letters, hashes))[0])[1], plain_score("qqq"), rel_tol=1e-6)


def test_near_copies_keeps_the_least_of_each_class(spark):
    docs = table(spark, SF, "documents")
    classes = {i: c for i, c, _ in brute([(r.doc_id, r.text) for r in docs.collect()])}
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, SF).collect()}
    assert kept == set(classes.values()) < classes.keys()


def test_secrets_leaves_no_span_and_changes_nothing_else(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")

    def spans(text):
        return sorted([m.span() for m in re.finditer(KEYWORDS, text, re.I | re.A) if len(m[2]) >= 6]
                      + [m.span() for m in re.finditer("AKIA[A-Z0-9]{16,}", text)] + [m.span() for m in re.finditer("[0-9a-f]{24,}", text)])

    got = {r.doc_id: r for r in corpus_pipeline.without_secrets(spark, docs, SF).collect()}
    changed = 0
    for r in docs.collect():
        out, at = "", 0
        for a, b in spans(r.text):
            out, at = (out + r.text[at:a] + "[SECRET]" if a >= at else out), max(at, b)
        assert got[r.doc_id].text == out + r.text[at:]
        changed += bool(at)
    assert changed


def test_tokens_as_tiktoken_counts_them(spark):
    docs = table(spark, SF, "documents")
    path = P.path("byte_bpe_multi_50k.tiktoken")
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    want = {r.doc_id: len(theirs.encode_ordinary(r.text)) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in corpus_pipeline.tokens(spark, docs, SF).collect()} == want
