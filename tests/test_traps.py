"""Literal-row fixtures for the semantic traps the test tables cannot supply."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import AS_OF, dim, r_df, rec, s_df, w_df, wo
from recurwork import schemas
from recurwork.functions.exprs import strip_first, strip_label_prefixes
from recurwork.functions.measures import gap_score, pct, rate_pct
from recurwork.operators.lag import previous_date
from recurwork.operators.repeats import KEY, repeat_pairs_30d, work_orders
from recurwork.plans import reports, views
from recurwork.sources import files


def pairs(spark, s_rows, w_rows=None, **kw):
    kw.setdefault("lookback_months", 12)
    w_rows = w_rows if w_rows is not None else [dim(r[0]) for r in s_rows]
    return repeat_pairs_30d(s_df(spark, s_rows), w_df(spark, w_rows), AS_OF, **kw)


def test_null_and_blank_code_are_one_key(spark):
    rows = [wo(1, "2001-06-01", code=None), wo(2, "2001-06-05", code=""), wo(3, "2001-06-09", code=None)]
    out = pairs(spark, rows).collect()
    assert len(out) == 1
    r = out[0]
    assert r.problem_code_desc is None
    assert r.completion_count == 3 and r.repeat_count_30d == 2


def test_padded_asset_names_count_as_one(spark):
    rows = [wo(1, "2001-06-01", desc=" a"), wo(2, "2001-06-05", desc="a"), wo(3, "2001-06-09", desc="  ")]
    r = pairs(spark, rows).collect()[0]
    assert r.asset_counts_str == "a~T1~2"


def test_same_day_ties_give_zero_gap_and_stable_order(spark):
    rows = [wo(5, "2001-06-01"), wo(4, "2001-06-01"), wo(6, "2001-06-20")]
    rk = previous_date(work_orders(s_df(spark, rows), AS_OF, 12), KEY, "completion_date", "tracking_nbr", "prev")
    got = {r.tracking_nbr: (r.completion_date - r.prev).days if r.prev else None for r in rk.collect()}
    assert got == {4: None, 5: 0, 6: 19}
    r = pairs(spark, rows).collect()[0]
    assert r.tracking_numbers == "6,5,4" and r.min_days_between == 0


def test_null_tracking_numbers_and_copies_count_as_in_a_plain_lag(spark):
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in schemas.WORKORDERS])

    def pairs_of(rows, **kw):
        return repeat_pairs_30d(spark.createDataFrame(rows, loose), w_df(spark, [dim(1)]), AS_OF, 12, **kw)

    lone = pairs_of([wo(None, "2001-06-01")], min_repeats=0).collect()
    assert lone == []  # a lone work order is no repeat of itself
    rows = [wo(None, "2001-06-01"), wo(1, "2001-06-01"), wo(2, "2001-06-10"), wo(2, "2001-06-10"), wo(3, "2001-06-10"), wo(4, "2001-07-30")]
    r = pairs_of(rows).collect()[0]
    # gaps: none, 0, 9, 0, 0, 50
    assert (r.completion_count, r.repeat_count_30d, r.min_days_between) == (6, 4, 0)
    keyed = [(1, "2001-06-01", None), (2, "2001-06-01", None), (2, "2001-06-05", 7)]
    df = spark.createDataFrame(keyed, "k int, d string, t long").withColumn("d", F.to_date("d"))
    got = sorted((x.k, x.t, str(x.p)) for x in previous_date(df, ["k"], "d", "t", "p").fillna(-1).collect())
    assert got == [(1, -1, "None"), (2, -1, "None"), (2, 7, "2001-06-01")]


def test_one_dimension_row_survives_in_every_query(spark):
    full, bare = dim(10, director="Z", tech="Ann"), (10, None, None, None, "A", None, None, None, None)
    rows = [rec(10, "2001-07-01", 5), rec(11, "2001-07-02", 5)]
    for w_rows in ([full, bare, dim(11, tech="Ann")], [bare, full, dim(11, tech="Ann")]):
        w = w_df(spark, w_rows)
        assert [(t.tech_name, t.repeat_wos) for t in reports.tech_repeats(r_df(spark, rows), w, AS_OF).collect()] == [("Ann", 2)]
        assert reports.store_hotspots(r_df(spark, rows), w, AS_OF).collect()[0].fm_director == "Z"


def test_nothing_is_capped_below_the_views(spark):
    """150 stores, 60 trades and 12,000 repeats all count."""
    many = [rec(i, "2001-07-01", 5, store_nbr=i % 150, trade=f"FM - T{i % 60}", code=f"C{i % 130}") for i in range(12_000)]
    r, w = r_df(spark, many), w_df(spark, [dim(0)])
    hot = reports.store_hotspots(r, w, AS_OF)
    assert views.store_count(hot).collect()[0].stores == 150
    assert views.store_list(hot, q="149", size=50).count() == 1
    t = reports.repeats_by_trade(r, AS_OF)
    totals = views.trade_band_totals(t).collect()[0]
    assert t.count() == 60 and totals.band_0_90 == 12_000 and views.trade_summary(t).count() == 60
    detail = reports.repeat_detail(r, AS_OF, w=w)
    assert views.gap_count(detail).collect()[0].repeat_wos == 12_000
    codes = reports.problem_codes(r, AS_OF, min_count=1)
    assert views.trade_codes(codes, "FM - T7").count() == codes.filter("trade = 'FM - T7'").count() > 0
    assert codes.count() > 100 and views.trade_codes(codes, first=25).count() == 25
    assert views.trade_bands(t, 15).count() == 15 and views.top_stores(hot, 10).count() == 10
    k = views.kpi_overview(r, AS_OF).collect()[0]
    assert (k.total_repeats, k.stores_affected, k.top_trade, k.top_trade_repeats, k.top_trade_stores) == (12_000, 150, "FM - T0", 200, 5)


def test_store_trades_are_listed_up_to_five(spark):
    rows = [rec(i, "2001-07-01", 5, trade=f"FM - T{i % 8}") for i in range(16)] + [rec(99, "2001-07-01", 5, trade=None)]
    r = reports.store_hotspots(r_df(spark, rows), w_df(spark, [dim(0)]), AS_OF).collect()[0]
    assert (r.total_repeats, r.trades_affected, r.top_trades) == (17, 8, ", ".join(f"FM - T{i}" for i in range(5)))
    badge = views.top_stores(reports.store_hotspots(r_df(spark, rows), w_df(spark, [dim(0)]), AS_OF), 1).collect()[0]
    assert (badge.trade_badges, badge.trades_affected) == ("T0, T1, T2", 8)


def test_gate_without_an_organisation_filter(spark):
    g = views.repeat_groups(pairs(spark, [wo(1, "2001-06-01"), wo(2, "2001-06-05"), wo(3, "2001-06-09")], sort=False))
    assert g.count() == 1
    assert views.repeat_detail_view(g, {"prob": "LEAK"}).count() == 0
    assert views.repeat_detail_view(g, {"prob": "LEAK"}, require_org_filter=False).count() == 1
    assert views.repeat_detail_view(g, {"sr": "Sr A", "prob": "LEAK"}).count() == 1
    assert views.by_problem_filtered(g, {"prob": "LEAK"}).count() == 0


def test_chosen_sorts_order_the_rows(spark):
    rows = [wo(10 * st + i, f"2001-06-{1 + i:02d}", store_nbr=st, ptype=p, amount=a)
            for st, p, a, n in ((1, "LEAK", "1.00", 3), (2, "DOOR", "9.00", 5), (3, "HEAT", "5.00", 4)) for i in range(n)]
    w_rows = [dim(r[0], director=f"D{r[1]}", rm=f"R{9 - r[1]}") for r in rows]
    g = views.repeat_groups(pairs(spark, rows, w_rows, sort=False))
    assert [r.store for r in views.by_store(g, "total_nte", False).collect()] == [1, 3, 2]
    assert [r.store for r in views.by_store(g, "region", True).collect()] == [1, 2, 3]
    assert [r.problem for r in views.by_problem(g, "problem", False).collect()] == ["DOOR", "HEAT", "LEAK"]
    assert [r.director for r in views.by_director(g, "director", True).collect()] == ["D3", "D2", "D1"]
    org = {"sr": "Sr A"}
    assert [r.store for r in views.by_store_filtered(g, org, sort_field="rm", descending=False).collect()] == [3, 2, 1]
    assert [r.sn for r in views.repeat_detail_view(g, org, sort_field="cnt", descending=True).collect()] == [2, 3, 1]
    for bad in (lambda: views.by_store(g, "x"), lambda: views.by_problem(g, "store"), lambda: views.by_director(g, "sn")):
        with pytest.raises(ValueError):
            bad()


def test_recent_work_orders_come_back_as_rows(spark):
    rows = [wo(i, f"2001-06-{i:02d}", problem_desc=f" d,{i}; ") for i in range(1, 26)]
    out = views.recent_work_orders(pairs(spark, rows, keep_arrays=True)).collect()
    assert [(r["rank"], r.tracking_nbr, r.description) for r in sorted(out, key=lambda r: r["rank"])] == [(i, str(26 - i), f"d,{26 - i};") for i in range(1, 21)]
    wide = pairs(spark, rows, keep_arrays=True, n_tracking=25, n_descs=25, description_chars=None).collect()[0]
    assert len(wide.tracking_numbers.split(",")) == 25 and len(wide.recent) == 25


def test_duplicate_dimension_rows_do_not_fan_out(spark):
    rows = [wo(1, "2001-06-01"), wo(2, "2001-06-05"), wo(3, "2001-06-09")]
    w_rows = [dim(1, director="B"), dim(1, director="A"), dim(2), dim(3)]
    r = pairs(spark, rows, w_rows).collect()[0]
    assert r.completion_count == 3
    assert r.fm_director == "Dir A"  # max over the de-duplicated rows: 'A' won for 1, 'Dir A' for 2, 3


def test_lookback_edge_and_pad(spark):
    # edge = 2001-08-02 - 1 month = 2001-07-02; WO 1 is 20 days before it
    rows = [wo(1, "2001-06-12"), wo(2, "2001-07-05"), wo(3, "2001-07-20")]
    plain = pairs(spark, rows, lookback_months=1, min_repeats=1).collect()
    assert plain[0].completion_count == 2 and plain[0].repeat_count_30d == 1
    padded = pairs(spark, rows, lookback_months=1, min_repeats=1, lookback_pad_days=30).collect()
    assert padded[0].completion_count == 2 and padded[0].repeat_count_30d == 2


def test_percent_rounding(spark):
    df = spark.createDataFrame([(1, 200), (5, 0), (1, 3), (3, 8)], "n long, d long")
    got = df.select(pct("n", "d").alias("p"), rate_pct("n", "d").alias("r"),
                    gap_score("n", "d").alias("g")).collect()
    assert [r.p for r in got] == [1, 0, 33, 38]  # 0.5 goes up, d = 0 gives 0
    assert [r.r for r in got] == [1, 0, 33, 38]
    assert [r.g for r in got] == [1, 500, 33, 38]  # max(d, 1)


def test_only_first_label_prefix_goes(spark):
    df = spark.createDataFrame([("FM - a FM - b",), ("x PM - y",), (None,)], "t string")
    got = df.select(strip_first("t", "FM - ").alias("a"), strip_label_prefixes("t").alias("b")).collect()
    assert got[0].a == "a FM - b" and got[1].b == "x y" and got[2].a is None


def test_ordered_lists_are_capped(spark):
    rows = [wo(i, f"2001-06-{i:02d}") for i in range(1, 26)]
    r = pairs(spark, rows).collect()[0]
    tn = r.tracking_numbers.split(",")
    assert tn == [str(i) for i in range(25, 5, -1)]
    assert r.sample_descs_raw == "desc 25,desc 24,desc 23"
    assert r.completion_count == 25


def test_asset_list_capped_at_six_by_count(spark):
    rows = [wo(i, f"2001-06-{i:02d}", desc=f"U{i % 8}") for i in range(1, 25)]
    r = pairs(spark, rows).collect()[0]
    items = r.asset_counts_str.split(",")
    assert len(items) == 6
    assert items[0] == "U0~T1~3"


def test_facet_keeps_a_selection_the_other_filters_exclude(spark):
    rows = [wo(1, "2001-06-01", store_nbr=1), wo(2, "2001-06-05", store_nbr=1), wo(3, "2001-06-09", store_nbr=1),
            wo(4, "2001-06-01", store_nbr=2, ptype="DOOR"), wo(5, "2001-06-03", store_nbr=2, ptype="DOOR"),
            wo(6, "2001-06-05", store_nbr=2, ptype="DOOR")]
    w_rows = [dim(i, sr="North" if i <= 3 else "South") for i in range(1, 7)]
    g = views.repeat_groups(pairs(spark, rows, w_rows, sort=False))
    f = {(r.field, r.value) for r in views.facets(g, {"sr": "North", "prob": "DOOR"}).collect()}
    assert ("prob", "DOOR") in f and ("prob", "LEAK") in f
    assert ("sr", "North") in f and ("sr", "South") in f


def test_unassigned_defaults_and_gate(spark):
    rows = [wo(1, "2001-06-01"), wo(2, "2001-06-05"), wo(3, "2001-06-09")]
    w_rows = [dim(i, director="", fsm=None) for i in (1, 2, 3)]
    g = views.repeat_groups(pairs(spark, rows, w_rows, sort=False))
    r = g.collect()[0]
    assert r.dir == "Unassigned" and r.fsm == "Unassigned" and r.mkt == ""
    assert views.filtered_kpis(g, {"prob": "LEAK"}).count() == 0  # no org filter: gated
    k = views.filtered_kpis(g, {"prob": "LEAK"}, require_org_filter=False).collect()[0]
    assert (k.pairs, k.repeat_incidents, k.stores, k.problems) == (1, 2, 1, 1)


def test_none_technician_is_missing(spark):
    rows = [rec(10, "2001-07-01", 5), rec(11, "2001-07-02", 5), rec(12, "2001-07-03", 5), rec(13, "2001-07-04", 5)]
    w_rows = [dim(10, tech="None"), dim(11, tech=""), dim(12, tech="Ann"), dim(13, tech="Ann")]
    out = reports.tech_repeats(r_df(spark, rows), w_df(spark, w_rows), AS_OF).collect()
    assert [(r.tech_name, r.repeat_wos) for r in out] == [("Ann", 2)]


def test_csv_extract_round_trip(spark):
    d = tempfile.mkdtemp(prefix="recurwork-csv-")
    p = os.path.join(d, "x.csv")
    with open(p, "wb") as f:
        f.write(b'name,note\n"Smith, J","line1\nline2"\nbad\xffbyte,ok\n')
    df = files.read_extract(spark, p)
    assert df.columns == ["name", "note"]
    got = sorted(df.collect(), key=lambda r: r.name)
    assert got[0].name == "Smith, J" and got[0].note == "line1\nline2"
    assert "�" in got[1].name
    e = os.path.join(d, "empty.csv")
    open(e, "wb").close()
    for absent in (e, os.path.join(d, "absent.csv")):
        assert files.read_extract(spark, absent).count() == 0
        assert views.extract_search(files.read_extract(spark, absent), "x").count() == 0
    assert files.ingest_extract(spark, p, os.path.join(d, "ingested")).count() == 2
    with open(os.path.join(d, "plain.csv"), "w") as f:
        f.write("a,b\n1,x\n2,y\n")
    assert files.read_extract(spark, os.path.join(d, "plain.csv"), multi_line=False).count() == 2
    hits = views.extract_search(df, "smith").collect()
    assert len(hits) == 1


def test_result_round_trip_and_missing_default(spark):
    d = tempfile.mkdtemp(prefix="recurwork-res-")
    assert files.load_result(spark, os.path.join(d, "absent"), schemas.REPEAT_PAIRS).count() == 0
    rows = [wo(1, "2001-06-01"), wo(2, "2001-06-05"), wo(3, "2001-06-09")]
    p = pairs(spark, rows)
    files.write_result(p, os.path.join(d, "pairs"))
    back = files.load_result(spark, os.path.join(d, "pairs"), schemas.REPEAT_PAIRS)
    assert back.collect() == p.collect()
    files.export_json(p, os.path.join(d, "pairs_json"))
    js = files.load_result(spark, os.path.join(d, "pairs_json"), schemas.REPEAT_PAIRS, fmt="json")
    assert js.collect() == p.collect()
    many = spark.createDataFrame([(*p.collect()[0][:9], i, *p.collect()[0][10:]) for i in range(50)], schemas.REPEAT_PAIRS).repartition(5)
    files.export_json(many, os.path.join(d, "many_json"))
    back = files.load_result(spark, os.path.join(d, "many_json"), schemas.REPEAT_PAIRS, fmt="json")
    assert sorted(back.collect(), key=str) == sorted(many.collect(), key=str)
    assert files.load_result(spark, os.path.join(d, "no_json"), schemas.REPEAT_PAIRS, fmt="json").count() == 0
    files.export_csv(views.by_store(views.repeat_groups(p)), os.path.join(d, "by_store_csv"))
    assert files.read_extract(spark, os.path.join(d, "by_store_csv")).count() == 1
    files.write_if_absent(spark, schemas.REPEAT_PAIRS, os.path.join(d, "empty"))
    assert files.load_result(spark, os.path.join(d, "empty"), schemas.REPEAT_PAIRS).count() == 0
    files.write_if_absent(spark, schemas.REPEAT_PAIRS, os.path.join(d, "pairs"))
    assert files.load_result(spark, os.path.join(d, "pairs"), schemas.REPEAT_PAIRS).count() == 1


def test_exact_copies_are_not_zero_day_repeats_of_each_other_row_by_row(spark):
    rows = [(1, "2001-06-01", 10), (1, "2001-06-01", 10), (1, "2001-06-01", 11), (1, "2001-06-05", 12)]
    df = spark.createDataFrame(rows, "k int, d string, t long").withColumn("d", F.to_date("d"))
    got = sorted((r.t, str(r.p)) for r in previous_date(df, ["k"], "d", "t", "p").collect())
    assert got == [(10, "None"), (10, "None"), (11, "2001-06-01"), (12, "2001-06-01")]
