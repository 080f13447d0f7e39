import numpy as np
import pytest
from pyspark.sql import functions as F

from recurwork.llm import ngram_join
from recurwork.llm.components import components


def plain_sets(text):
    words = (text or "").split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Per row: sorted doc_ids of its class and its number of links."""
    sets = [plain_sets(t) for _, t in rows]
    n = len(rows)
    linked = [[j for j in range(n) if j != i and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], min(ids, default=None), len(linked[i])))
    return sorted(out, key=repr)


def got(df, **kw):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in ngram_join.join_similar(df, **kw).collect()), key=repr)


def near_copies(n, seed=1, words=120):
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 10_000, words)]
    out = []
    for i in range(n):
        own = list(base)
        for at in rng.integers(0, words, rng.integers(0, 5)):
            own[at] = f"n{i}x{at}"
        out.append((i, " ".join(own)))
    return out


def test_sql(spark, same_as_sql):
    same_as_sql(spark, "op9_ngram_join")


@pytest.mark.parametrize("block", [1024, 7])
def test_large_group_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", block)
    rows = near_copies(60) + [(100 + i, t) for i, t in near_copies(20, 2)] + [(200 + i, f"alone {i} " + " ".join(f"q{i}z{j}" for j in range(30))) for i in range(20)]
    rows += [(300 + i, rows[0][1]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows)


def test_nulls_short_long_repeats_and_empty(spark):
    t = " ".join(f"w{i}" for i in range(200))
    near = t.replace("w100 ", "zz ")
    rows = [(1, t), (2, t), (3, near), (None, near), (5, None), (6, ""), (7, "a b"), (8, " a \n b "), (9, "a b c"), (5, None), (3, near), (12, "   "),
            (13, "x y z " * 50_000), (14, "x y z " * 50_001), (15, "é ü\x85ß")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("class_id", F.lit(1)).withColumn("told", F.lit(1))
    assert got(df) == brute(rows)
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5, 5, 6, 7, 9, 12, 13, 15]
    assert got(df.limit(0)) == [] and ngram_join.one_of_each(df.limit(0)).count() == 0


def test_one_stays_of_rows_that_repeat(spark):
    df = spark.createDataFrame([(1, "a b c d e f")] * 5 + [(None, "g h i j k l")] * 3, "doc_id long, text string")
    assert sorted(r.text for r in ngram_join.one_of_each(df).collect()) == ["a b c d e f", "g h i j k l"]


def test_columns_of_the_join_may_be_columns_of_the_documents(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (None, "a b c d e f"), (None, "x y")]
    names = ["_ng_id", "_ng_told", "_ng_doc", "key", "n", "kept", "told", "class_id"]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.concat(F.lit(c), F.coalesce("text", F.lit("-"))) for c in names})
    got = ngram_join.one_of_each(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted([(1, "a b c d e f"), (3, None), (None, "x y")], key=repr)
    assert all(r[c] == c + (r.text or "-") for r in got.collect() for c in names)


def test_all_ids_null(spark):
    df = spark.createDataFrame([(None, "a b c d e f")] * 7 + [(None, "other words")], "doc_id long, text string")
    assert {(r.doc_id, r.class_id, r.n_links) for r in ngram_join.join_similar(df).collect()} == {(None, None, 6), (None, None, 0)}
    assert ngram_join.one_of_each(df).count() == 2


def test_prefix_is_as_long_as_the_recall_allows():
    for trees, recall in ((32, 0.9999), (8, 0.9), (64, 0.999)):
        depth = ngram_join.matched_depth(trees, recall)
        reached = [1 - (1 - 0.8 ** d) ** trees for d in (depth, depth + 1)]
        assert reached[0] >= recall > reached[1]


def test_common_shingles_of_every_two():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 80, n).astype(np.uint64)) for n in rng.integers(1, 60, 50)]
    m = ngram_join.shared(sets)
    assert all(m[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(50) for j in range(i + 1, 50))


def test_tries_meet_as_often_as_sets_are_alike():
    rng = np.random.default_rng(3)
    meets = []
    for _ in range(300):
        own = rng.integers(0, 1 << 63, 90, dtype=np.uint64)
        a, b = np.unique(own[:80]), np.unique(own[10:])  # 70 of 90
        meets.append((ngram_join.trie_nodes(a, 32, 1) == ngram_join.trie_nodes(b, 32, 1)).mean())
    assert abs(np.mean(meets) - 70 / 90) < 0.02


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (101, 103), (7, 7), (None, 3)] + [(500, i) for i in range(501, 540)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 104)} | {i: 500 for i in range(500, 540)}
