import numpy as np
import pytest

from recurwork.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=10, every=100):
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i, v in zip(ids, matrix, strict=True):
        if i % every == 0:
            d = np.sqrt(((matrix - v) ** 2).sum(axis=1))
            out[int(i)] = sorted((x, int(y)) for x, y in zip(d, ids, strict=True) if y != i)[:k]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    out = {q: sorted(v) for q, v in out.items()}
    assert all([x[0] for x in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [x[1:] for x in v] for q, v in out.items()}


@pytest.mark.parametrize("cell_rows", [8192, 300])
def test_recall_against_brute_force(spark, cell_rows):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    got = found(ann.nearest(spark, df, cell_rows=cell_rows))
    hits = sum(len({i for _, i in got[q]} & {i for _, i in w}) for q, w in want.items())
    assert got.keys() == want.keys() and hits >= 0.9 * sum(map(len, want.values()))
    by_id = {r.vec_id: np.array(r.embedding) for r in df.collect()}
    assert all(abs(s - np.sqrt(((by_id[q] - by_id[i]) ** 2).sum())) < 1e-12 for q, v in got.items() for s, i in v)


def test_clustered_vectors_ties_and_a_very_common_vector(spark):
    rng = np.random.default_rng(2)
    rows = [(i, np.repeat(rng.integers(0, 2, 4), 2).astype(float) + 0.5) for i in range(1500)]
    rows += [(2000 + i, np.ones(8)) for i in range(800)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], SCHEMA)
    got = found(ann.nearest(spark, df, cell_rows=4))
    assert {q: [(round(s, 9), i) for s, i in v] for q, v in got.items()} == {q: [(round(s, 9), i) for s, i in v] for q, v in brute(rows).items()}


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [1.0]), (7, [3.0, 1.0]),
            (8, [inf, 0.0]), (None, [1.0, 1.0]), (100, [0.0, -0.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS score", "2 AS cell")
    assert found(ann.nearest(spark, df)) == {0: [(0.0, 1), (5 ** 0.5, 7)]}
    assert ann.nearest(spark, df.limit(0)).count() == 0
    assert ann.nearest(spark, df.where("vec_id = 0")).count() == 0


def test_stopping_bound():
    draws = np.random.default_rng(1).chisquare(ann.DIMS, 200_000)
    for p in (0.5, 0.9, 0.97):
        assert abs((draws <= ann.reach(p)).mean() - p) < 0.01


@pytest.mark.parametrize("block_rows", [2048, 7])
def test_cells_beyond_the_top_of_the_tree_are_dealt_into_shares(spark, block_rows):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows)
    got = found(ann.nearest(spark, df, cell_rows=50, sample_rows=64, block_rows=block_rows))  # four cells, some ten shares or more
    hits = sum(len({i for _, i in got[q]} & {i for _, i in w}) for q, w in want.items())
    assert len(rows) > 8 * 50 and got.keys() == want.keys() and hits >= 0.9 * sum(map(len, want.values()))


def test_points_are_sent_only_where_a_query_asks(spark):
    rows = [(i, [float(i % 7), 1.0 + i, 2.0]) for i in range(1, 90)] + [(100, [3.0, 50.0, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(ann.nearest(spark, df, cell_rows=8, sample_rows=64)).keys() == {100}
    assert ann.nearest(spark, df.where("vec_id <> 100")).count() == 0
