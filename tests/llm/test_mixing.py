import itertools
import random

import pytest
from pyspark.sql import functions as F

from recurwork.llm import mixing, queries
from recurwork.llm.mixing import Weights

SCHEMA = "doc_id long, text string, lang string, source string"
FLAT = (Weights({"b": 3}, 1), Weights({}, 1), Weights({"zero": 0}, 1))


def total(n):
    return F.sum("tokens") * 0 + n


def mix(df, n, epochs=2, weights=FLAT, seed=1):
    return mixing.mixture(df, F.substring("source", 1, 1), weights, total(n).cast("long"), epochs, seed)


def test_sql(spark, same_as_sql):
    same_as_sql(spark, "op8_mixture")


def fill(room, weight, budget):
    """Water filling by trial: the highest level that the budget pays for."""
    best = [0] * len(room)
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        now = [min(r, w * mid) for r, w in zip(room, weight, strict=True)]
        low, high, best = (mid, high, now) if sum(now) <= budget else (low, mid, best)
    return best


def test_shares_are_the_level_of_the_water(spark):
    r = random.Random(4)
    cases = [([r.randrange(1, 100) for _ in range(n)], [r.randrange(1, 6) for _ in range(n)], r.randrange(0, 200)) for n in (1, 2, 5, 9) for _ in range(6)]
    rows = [(g, f"c{i}", room, w, b) for g, (rooms, ws, b) in enumerate(cases) for i, (room, w) in enumerate(zip(rooms, ws, strict=True))]
    df = spark.createDataFrame(rows, "g int, name string, room long, weight long, total long")
    got = {}
    for x in mixing.shared_out(df, ["g"], "name").collect():
        got.setdefault(x.g, {})[x.name] = x.budget
    for g, (rooms, ws, b) in enumerate(cases):
        own = [got[g][f"c{i}"] for i in range(len(rooms))]
        assert sum(own) <= b and all(abs(x - y) <= 1 for x, y in zip(own, fill(rooms, ws, b), strict=True))


def test_shortage_stays_in_the_family(spark):
    # a: en has one short source, so its sibling source takes the rest; b's share is not touched
    rows = [(i, "w " * 10, "en", "a1") for i in range(2)] + [(10 + i, "w " * 10, "en", "a2") for i in range(50)] + [(100 + i, "w " * 10, "en", "b1") for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    budget = {(r.domain, r.source): r.leaf_budget for r in mix(df, 400, epochs=1).collect()}
    assert budget == {("a", "a1"): 20, ("a", "a2"): 80, ("b", "b1"): 300}
    # the whole of a is short: now b takes what a cannot
    budget = {(r.domain, r.source): r.leaf_budget for r in mix(df.where("source <> 'a2'"), 400, epochs=1).collect()}
    assert budget == {("a", "a1"): 20, ("b", "b1"): 380}


def test_epochs_and_the_prefix_of_the_next(spark):
    df = spark.createDataFrame([(i, "w " * 10, "en", "a") for i in range(10)], SCHEMA)
    once = {r.doc_id: r.times for r in mix(df, 35, epochs=3).collect()}
    assert sorted(once.values()) == [0] * 7 + [1] * 3
    more = {r.doc_id: r.times for r in mix(df, 135, epochs=3).collect()}
    assert sorted(more.values()) == [1] * 7 + [2] * 3
    assert {r.times for r in mix(df, 10_000, epochs=3).collect()} == {3} and {r.times for r in mix(df, 0).collect()} == {0}
    other = {r.doc_id for r in mix(df, 35, seed=2).where("times > 0").collect()}
    assert other != {i for i, n in once.items() if n}


@pytest.mark.parametrize("bucket_rows", [10_000, 7])
def test_prefix_by_key_ranges_is_the_prefix_by_sorting(spark, bucket_rows):
    r = random.Random(5)
    df = spark.createDataFrame([(i, "w " * r.randrange(1, 30), "en", "a") for i in range(400)], SCHEMA)
    counted = mixing.with_leaf(df, F.lit("d"))
    plan = mixing.plan(counted, FLAT, total(2500).cast("long"), 1, 9, bucket_rows).collect()[0]
    keyed = sorted((x.key, x._mix_tokens) for x in counted.withColumn("key", mixing.key(9, F.lit(0))).collect())
    until = itertools.accumulate(t for _, t in keyed)
    assert plan.bound == max(k for (k, _), u in zip(keyed, until, strict=True) if u <= 2500) and plan.epochs == 0


def test_nulls_repeats_zero_weight_and_empty(spark):
    rows = [(None, "a b", None, None), (None, "a b", None, None), (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t", "en", "a"), (4, "x", "en", "a"),
            (4, "x", "en", "a"), (5, "y " * 100_000, "en", "a"), (6, "q", "en", "zero")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("budget", F.lit(0)).withColumn("key", F.lit(0))
    got = mix(df, 10**6, epochs=1).collect()
    assert len(got) == len(rows)
    times = {}
    for r in got:
        times.setdefault(r.doc_id, []).append(r.times)
    assert times == {None: [1, 1], 1: [0], 2: [0], 3: [0], 4: [1, 1], 5: [1], 6: [0]}
    assert mix(df.limit(0), 10).count() == 0
    kept = mixing.mixed_documents(df, F.substring("source", 1, 1), FLAT, total(10**6).cast("long"), 2, 1)
    assert kept.columns == df.columns and kept.count() == 10 and mixing.mixed_documents(df.limit(0), F.lit("d"), FLAT, total(1).cast("long"), 1, 1).count() == 0


def test_columns_of_the_plan_may_be_columns_of_the_documents(spark):
    rows = [(i, "one two three", "de", "bc"[i % 2]) for i in range(40)] + [(None, "four five", "de", "b")] * 3
    names = ["epochs", "bound", "budget", "n", "key", "room", "_mix_domain", "_mix_tokens", "_mix_times", "_mix_doc", "domain", "rest"]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.concat(F.lit(c), "source") for c in names})
    got = mixing.mixed_documents(df, F.substring("source", 1, 1), FLAT, total(60).cast("long"), 2, 1)
    plain = mixing.mixed_documents(df.select("doc_id", "text", "lang", "source"), F.substring("source", 1, 1), FLAT, total(60).cast("long"), 2, 1)
    assert got.columns == df.columns
    assert sorted(map(str, got.select(plain.columns).collect())) == sorted(map(str, plain.collect())) and got.count() > 10
    assert all(r[c] == c + r.source for r in got.collect() for c in names)


def test_all_ids_null(spark):
    df = spark.createDataFrame([(None, "one two", "de", "b")] * 30, SCHEMA)
    assert mixing.mixed_documents(df, F.substring("source", 1, 1), FLAT, total(200).cast("long"), 2, 1).count() == 60
    assert mix(df, 200).count() == 30


def test_no_python(spark):
    plan = queries.op8_mixture(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
