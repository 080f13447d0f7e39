"""Pages by cursor concatenate to the whole, forwards and backwards, with NULL keys and mixed directions."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from helpers import MEDIUM
from recurwork.operators.ordering import Key, cursor, cursor_page, page_after
from recurwork.plans import catalog, views
from recurwork.sources.files import ROW


def whole(df, order):
    return [tuple(r) for r in df.orderBy(*[k.column() for k in order]).collect()]


def forwards(turn, order):
    out, after = [], None
    while rows := turn(after=after).collect():
        out += rows
        after = cursor(order, rows[-1])
    return out


def backwards(turn, order, last):
    out, before = [last], cursor(order, last)
    while rows := turn(before=before).collect():
        out = rows + out
        before = cursor(order, rows[0])
    return out


def check(turn, order, df, back=True):
    want = whole(df, order)
    rows = forwards(turn, order)
    assert [tuple(r) for r in rows] == want and len(want) > 1
    assert not back or [tuple(r) for r in backwards(turn, order, rows[-1])] == want


@pytest.fixture(scope="module")
def nulls(spark):
    r = random.Random(1)
    rows = {(r.choice([None, 1, 2]), r.choice([None, "", "b", "é"]), i) for i in range(29)} | {(None, None, None)}
    return spark.createDataFrame(sorted(rows, key=repr), "a long, b string, c long").cache()


@pytest.mark.parametrize("a, b", list(itertools.product([(False, None), (True, None), (False, False), (True, True)], repeat=2)))
def test_every_direction_and_place_of_null(nulls, a, b):
    order = [Key("a", *a), Key("b", *b), Key("c")]
    check(lambda **at: cursor_page(nulls, order, 11, **at), order, nulls)


def test_nothing_is_lost_behind_a_null_key(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "a long")
    assert [r.a for r in page_after(df, ["a"], (None,), 5).collect()] == [1, 2]
    assert [r.a for r in page_after(df, ["a"], (1,), 5, descending=True).collect()] == [None]


def test_bad_cursors(nulls):
    order = [Key("a"), Key("c")]
    for bad in ({"after": (1,)}, {"after": (1, 1), "before": (1, 1)}):
        with pytest.raises(ValueError):
            cursor_page(nulls, order, 5, **bad)
    with pytest.raises(ValueError):
        cursor_page(nulls, order, 0)


def test_the_cursor_is_filtered_at_the_scan(spark):
    df = spark.read.parquet(f"{MEDIUM}/orders.parquet").select("o_orderkey", "o_custkey")
    plan = cursor_page(df, [Key("o_orderkey")], 5, after=(100,))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,100)" in plan and "TakeOrderedAndProject" in plan


@pytest.fixture(scope="module")
def detail(spark):
    rows = catalog._detail_enriched(spark, MEDIUM)
    nulled = [F.when(F.col("tracking_nbr") % 7 == 0, F.lit(None)).otherwise(F.col(c)).alias(c) if c in ("days_between", "store_nbr", "tech_name", "city") else F.col(c)
              for c in rows.columns]
    out = rows.select(*nulled).where("tracking_nbr % 5 = 0").cache()
    assert out.where("days_between IS NULL").count() and out.count() > 60
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("key", views.GAP_SORT_NUM + views.GAP_SORT_TEXT)
def test_gap_finder(detail, key, descending):
    size = max(20, detail.count() // 2)
    chosen = {"sort_key": key, "descending": descending}
    check(lambda **at: views.gap_page(detail, size, **at, **chosen), views.gap_order(**chosen), views.gap_rows(detail, **chosen), back=key == "city")
    first = views.gap_finder(detail, size=size, **chosen)
    assert [tuple(r) for r in first.collect()] == [tuple(r) for r in views.gap_page(detail, size, **chosen).drop("sort_value").collect()]


@pytest.fixture(scope="module")
def stores(spark):
    return catalog._hotspots(spark, MEDIUM).cache()


@pytest.mark.parametrize("key", views.STORE_SORT)
def test_store_list(stores, key):
    size = max(2, stores.count() // 3)
    check(lambda **at: views.store_page(stores, size, sort_key=key, **at), views.store_order(key), views.store_rows(stores), back=key == "repeats_180d")


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("field", views.DETAIL_SORT)
def test_repeat_detail(groups, field, descending):
    size = groups.count() // 3
    turn = lambda **at: views.detail_page(groups, None, False, size, sort_field=field, descending=descending, **at)
    order = views.detail_order(field, descending)
    rows = forwards(turn, order)
    want = [tuple(r) for r in views.repeat_detail_view(groups, None, False, field, descending).collect()]
    assert [tuple(r) for r in rows] == want and len(want) > 100


@pytest.fixture(scope="module")
def groups(spark):
    return catalog._groups(spark, MEDIUM).cache()


def test_equal_rows_of_an_extract(spark):
    df = spark.createDataFrame([("a", None, i) for i in range(7)] + [(None, "b", i + 7) for i in range(4)], f"x string, y string, {ROW} long")
    order = views.extract_order(df)
    check(lambda **at: views.extract_page(df, "", 3, **at), order, df)
    with pytest.raises(ValueError):
        views.extract_page(df.drop(ROW))
