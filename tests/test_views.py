"""Literal-row checks of view semantics: thresholds, tie-breaks, missing values."""

from pyspark.sql import functions as F

from helpers import AS_OF, r_df, rec
from recurwork.plans import reports, views

GROUP_COLS = ("sn long, prob string, pcd string, trade string, cat string, cnt long, r30 long, nte double, "
              "sr string, dir string, rm string, fsm string")


def groups_df(spark, rows):
    return spark.createDataFrame(rows, GROUP_COLS)


def test_director_top_problem_ties_go_alphabetical(spark):
    g = groups_df(spark, [
        (1, "ROOF", None, "FM - A", "A", 5, 2, 10.0, "S", "D1", "R", "F"),
        (2, "DOOR", None, "FM - A", "A", 5, 2, 20.0, "S", "D1", "R", "F"),
        (3, "LEAK", None, "FM - A", "A", 5, 3, 30.0, "S", "D2", "R", "F"),
    ])
    got = {r.director: (r.store_count, r.repeat_incidents, r.top_problem) for r in views.by_director(g).collect()}
    assert got == {"D1": (2, 4, "DOOR"), "D2": (1, 3, "LEAK")}
    f = {r.director: r.repeat_groups for r in views.by_director_filtered(g, {"sr": "S"}).collect()}
    assert f == {"D1": 2, "D2": 1}


def test_store_first_seen_follows_repeats_then_money(spark):
    g = groups_df(spark, [
        (7, "ROOF", None, "FM - A", "A", 5, 2, 99.0, "S", "Low", "R1", "F"),
        (7, "DOOR", None, "FM - A", "A", 5, 3, 10.0, "S", "High", "R2", "F"),
        (7, "LEAK", None, "FM - A", "A", 5, 3, 50.0, "S", "Mid", "R3", "F"),
    ])
    r = views.by_store(g).first()
    assert (r.director, r.region, r.repeat_incidents, r.problems) == ("Mid", "R3", 8, "DOOR, LEAK, ROOF")
    assert r.total_nte == 159.0


def test_rate_and_priority_thresholds(spark):
    g = groups_df(spark, [
        (1, "A", None, "FM - A", "A", 100, 30, 1.0, "S", "D", "R", "F"),   # 30 %: not > 30
        (1, "B", None, "FM - A", "A", 100, 31, 1.0, "S", "D", "R", "F"),
        (1, "C", None, "FM - A", "A", 100, 15, 1.0, "S", "D", "R", "F"),
        (1, "D", None, "FM - A", "A", 0, 0, 1.0, "S", "D", "R", "F"),
    ])
    got = {r.problem: (r.rate, r.rate_band) for r in views.by_problem(g).collect()}
    assert got == {"A": (30, "medium"), "B": (31, "high"), "C": (15, "low"), "D": (0, "low")}
    codes = spark.createDataFrame([("T", "x", 10, 1, 6, 6), ("T", "y", 10, 1, 3, 3), ("T", "z", 200, 1, 59, 59)],
                                  "trade string, problem_code string, repeat_count long, stores_affected long, "
                                  "within_90d long, within_180d long")
    pr = {r.problem_code: (r.pct_90d, r.priority) for r in views.trade_codes(codes).collect()}
    assert pr == {"x": (60, "high"), "y": (30, "medium"), "z": (30, "medium")}  # 29.5 rounds up


def test_store_severity_is_strict(spark):
    hs = spark.createDataFrame(
        [(1, "C", "S", "d", "s", "b", 30, 1, 21, 21, None), (2, "C", "S", "d", "s", "b", 30, 1, 20, 20, None),
         (3, "C", "S", "d", "s", "b", 30, 1, 10, 10, None)],
        "store_nbr long, city string, state string, sr_director string, fm_director string, banner string, "
        "total_repeats long, trades_affected long, repeats_90d long, repeats_180d long, top_trades string")
    got = {r.store_nbr: r.severity for r in views.store_list(hs, sort_key="repeats_90d").collect()}
    assert got == {1: "high", 2: "medium", 3: "low"}


def test_gap_finder_missing_days_pass_urgency_and_empty_columns_search_as_blank(spark):
    rows = [rec(10, "2001-07-01", 5), rec(11, "2001-07-02", 80)]
    d = reports.repeat_detail(r_df(spark, rows), AS_OF)
    d = d.withColumn("days_between", F.when(F.col("tracking_nbr") == 11, None).otherwise(F.col("days_between")))
    d = d.select("*", F.lit("X").alias("city"), F.lit(None).cast("string").alias("state"),
                 F.lit("Dir").alias("fm_director"), F.lit("Sr").alias("sr_director"),
                 F.lit(None).cast("string").alias("tech_name"))
    got = [r.tracking_nbr for r in views.gap_finder(d, urgency=30).collect()]
    assert sorted(got) == [10, 11]  # missing days count as 0
    assert views.gap_count(d, q="fm - hvac").first().repeat_wos == 2
    assert views.gap_count(d, q="x  fm - hvac").first().repeat_wos == 2  # state '' between city and trade
    assert views.gap_count(d, q="x fm").first().repeat_wos == 0
    assert views.gap_count(d, director="Sr").first().repeat_wos == 2
    u = {r.tracking_nbr: r.urgency for r in views.gap_finder(d).collect()}
    assert u == {10: "high", 11: "high"}


def test_kpis_from_uncapped_r(spark):
    rows = [rec(i, "2001-07-01", 5, store_nbr=i % 3, trade="FM - B" if i % 2 else "FM - A") for i in range(10, 30)]
    rows += [rec(99, "2001-07-01", 200, store_nbr=50, trade=None)]
    k = views.kpi_overview(r_df(spark, rows), AS_OF).first()
    assert (k.total_repeats, k.repeats_90d, k.stores_affected) == (20, 20, 3)
    assert (k.top_trade, k.top_trade_label, k.pct_90d) == ("FM - A", "A", 100)
    assert (k.top_code_trade, k.top_code, k.top_code_count) == ("FM - A", "P1", 10)


def test_top_trend_meets_few_trades_in_one_row(spark):
    trades = [(f"FM - T{i:04}", f"2001-0{1 + i % 7}", i * 37 % 1000) for i in range(2000)] + [("FM - T0007", "2001-09", 5000), (None, "2001-08", 3)]
    trend = spark.createDataFrame(trades, "trade string, month string, total_repeats long")
    parts = views.top_trend_parts(trend, 3).collect()
    assert len(parts) <= views.TREND_PARTS and all(len(p["items"]) <= 3 for p in parts)
    totals = {}
    for t, _, n in trades:
        totals[t] = totals.get(t, 0) + n
    first = sorted(totals, key=lambda t: (-totals[t], t or ""))[:3]
    want = [(m, t, sum(n for a, b, n in trades if (a, b) == (t, m)), totals[t]) for m in sorted({m for _, m, _ in trades}) for t in first]
    assert [(r.month, r.trade, r.total_repeats, r.trade_total) for r in views.top_trend(trend, 3).collect()] == want
