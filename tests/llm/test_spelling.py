import random
import re
from collections import Counter
from zlib import crc32

import pytest

from recurwork.llm import queries, spelling
from recurwork.llm.common import table

DOCS = "doc_id long, text string"
SF = "/root/testdata/sf0.001"


def plain_count(rows, every=199, least=6, often=5):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x7f" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= often}


def edits(word, letters):
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in letters)
        if i < len(word):
            yield word[:i] + word[i + 1:]
            yield from (word[:i] + c + word[i + 1:] for c in letters)


def plain_groups(words, ratio=5):
    letters = sorted(set("".join(words)))
    near = {w: {x for x in edits(w, letters) if x in words} - {w} for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def same(df, want):
    got = sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == sorted(want)


def random_words(r, alphabet, low, high, n):
    return {"".join(r.choice(alphabet) for _ in range(r.randint(low, high))): r.choice([5, 5, 6, 30, 200, 1500, 10000]) for _ in range(n)}


def words_df(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


@pytest.mark.parametrize("most", [1 << 15, 60, 3])
def test_groups_equal_a_plain_version_at_any_depth(spark, most):
    r = random.Random(most)
    words = random_words(r, "abcé", 3, 6, 500) | random_words(r, "xyz😀÷", 2, 4, 150)
    assert spelling.depth_for(spelling.with_vectors(words_df(spark, words)), 3) > 3
    same(spelling.group_variants(words_df(spark, words), subtree_words=most), plain_groups(words))


def test_long_words_and_chains(spark):
    long = "ab" * 40_000
    words = {long: 100, long + "a": 10, long[:-1] + "c": 10, "x" * 300: 7, "x" * 299: 50, "x" * 298: 400, "y" * 130: 5, "y" * 121: 90}
    word, n = "q", 5
    for _ in range(9):  # forms one after the other
        words[word], word, n = n, word + "q", n * 5
    same(spelling.group_variants(words_df(spark, words)), plain_groups(words))


def test_ties_go_to_the_least_word_and_the_ratio_counts(spark):
    words = {"zaaaaa": 50, "baaaaa": 50, "éaaaaa": 50, "caaaaa": 10, "daaaaa": 11}
    same(spelling.group_variants(words_df(spark, words)), plain_groups(words))
    got = {r.word: r.form for r in spelling.group_variants(words_df(spark, words)).collect()}
    assert got["caaaaa"] == "baaaaa" and got["daaaaa"] is None


def test_counting_equals_a_plain_version(spark, monkeypatch):
    r = random.Random(4)
    words = ["straße", "Ärgernis", "ÉCOLE×÷x", "letters", "Letters", "abcdefghij" * 3, "short", "ÿÀ" * 4, "égalite", "naïveté7", "KelvinK"]
    rows = [(i, " ".join(r.choices(words, k=40))) for i in range(60)] + [(None, "letters Letters nowhere"), (None, None), (3, ""), (4, "again again"), (4, "again again"), (5, "x" * 300_000)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'a' AS word", "1 AS n")
    monkeypatch.setattr(spelling, "HELD_WORDS", 4)
    for every, often in ((199, 5), (2, 1), (1, 2)):
        got = {r.word: r.n for r in spelling.count_words(docs, min_count=often, every=every).collect()}
        assert got == plain_count(rows, every, often=often) and got


def test_empty_tables(spark):
    assert spelling.group_variants(spelling.count_words(spark.createDataFrame([], DOCS))).collect() == []


def test_query_equals_a_plain_version(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    want = plain_groups(plain_count(rows))
    assert any(w[1] for w in want)
    same(queries.op12_spelling(spark, SF), want)
