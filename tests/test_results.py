"""Saved results, versions, months and extracts on files of literal rows."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import SMALL, s_df, wo
from recurwork.plans import views
from recurwork.sources import files
from recurwork.sources.tables import scan_workorders, write_by_month

PAIRS = "store long, name string, amount decimal(18,2), day date, share double"


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="recurwork-results-")


def schema_of(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def save(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


ROWS = [{"store": i, "name": f"store {i}, \"é\"", "amount": f"{i}.50", "day": "2001-02-03", "share": i / 4} for i in range(300)]


@pytest.mark.parametrize("text", [json.dumps(ROWS, indent=2), json.dumps(ROWS), "\n".join(map(json.dumps, ROWS)),
                                  "\n\n  " + json.dumps([{k: str(v) for k, v in r.items()} for r in ROWS], indent=2)])
def test_both_forms_of_saved_json_read_equal(spark, folder, text):
    back = files.load_result(spark, save(f"{folder}/rows.json", text), schema_of(spark, PAIRS), "json")
    got = [(r.store, r.name, str(r.amount), str(r.day), r.share) for r in back.orderBy("store").collect()]
    assert got == [(r["store"], r["name"], r["amount"], r["day"], r["share"]) for r in ROWS]


@pytest.mark.parametrize("form", ["array", "lines"])
def test_a_bad_row_is_told(spark, folder, form):
    rows = [{"store": 1, "name": "a"}, {"store": "12abc", "name": "b"}, {"store": "", "amount": None, "other": 3}, {"store": 4, "day": "2001-02-30"}, {}]
    text = json.dumps(rows, indent=2) if form == "array" else "\n".join(map(json.dumps, rows)) + '\n{"store": 9, "name"\n'
    path, schema = save(f"{folder}/rows.json", text), schema_of(spark, PAIRS)
    got = files.read_saved_json(spark, path, schema).collect()
    assert [(r.store, r.name) for r in got][:5] == [(1, "a"), (None, None), (None, None), (None, None), (None, None)]
    assert [r[files.BAD_ROW] is not None for r in got] == [False, True, False, True, False] + [True] * (form == "lines")
    assert "12abc" in got[1][files.BAD_ROW]
    strict = files.load_result(spark, path, schema, "json")
    for df in (strict, strict.select("name"), strict.agg(F.sum("store"))):
        with pytest.raises(Exception, match="does not fit the schema"):
            df.collect()


def test_a_broken_array_and_no_file(spark, folder):
    schema = schema_of(spark, PAIRS)
    got = files.read_saved_json(spark, save(f"{folder}/cut.json", json.dumps(ROWS, indent=2)[:-40]), schema)
    assert got.where(F.col(files.BAD_ROW).isNotNull()).count() >= 1
    for text in ("[]", ""):
        assert files.load_result(spark, save(f"{folder}/none.json", text), schema, "json").count() == 0
    assert files.load_result(spark, f"{folder}/absent.json", schema, "json").collect() == []


def test_nested_columns_survive_json(spark, folder):
    df = spark.sql("SELECT 1L AS store, array(named_struct('rank', 1, 'name', 'a')) AS assets, array('x', 'y') AS problems")
    files.export_json(df, f"{folder}/nested")
    assert files.load_result(spark, f"{folder}/nested", df.schema, "json").collect() == df.collect()


def test_only_manifests_make_a_version(spark, folder):
    schema = schema_of(spark, "id long")
    files.write_result(spark.range(3), folder)
    good = files.versions(spark, folder)
    later = good[-1] + 10**9
    spark.range(7).write.parquet(files.version_path(folder, later))  # committed, but its writer died before the manifest
    spark.range(5).coalesce(1).write.mode("append").parquet(files.version_path(folder, good[-1]))  # a lost attempt's file
    save(f"{folder}/manifest/draft-{later}", '{"version": ')  # and a manifest that was not finished
    assert files.versions(spark, folder) == good
    assert files.load_result(spark, folder, schema).count() == 3
    files.finish_version(spark, folder, later)
    assert files.load_result(spark, folder, schema).count() == 7
    with pytest.raises(OSError):
        files.finish_version(spark, folder, later)


def test_old_versions_go_and_running_ones_stay(spark, folder):
    for n in range(5):
        files.write_result(spark.range(n), folder, keep=10)
    found = files.versions(spark, folder)
    for unfinished in (found[0] - 1, found[3] + 1):
        spark.range(9).write.parquet(files.version_path(folder, unfinished))
    gone = files.retain(spark, folder, keep=2)
    assert gone == [found[0] - 1, *found[:3]]
    assert files.versions(spark, folder) == found[3:]
    assert {f for f in os.listdir(folder) if f.startswith("version=")} == {f"version={v}" for v in (found[3], found[3] + 1, found[4])}
    assert files.load_result(spark, folder, schema_of(spark, "id long")).count() == 4
    files.write_result(spark.range(1), folder, keep=1)
    assert len(files.versions(spark, folder)) == 1


def months(path):
    return {m: sorted(f for f in os.listdir(f"{path}/{m}") if f.endswith(".parquet")) for m in os.listdir(path) if m.startswith("completion_month=")}


def test_rewriting_a_month_leaves_the_others(spark, folder):
    rows = [wo(i, f"2001-{1 + i % 4:02d}-15") for i in range(80)]
    write_by_month(s_df(spark, rows).repartition(8), folder, "completion_date")
    first = months(folder)
    assert len(first) == 4 and all(len(f) == 1 for f in first.values())  # one file a month and task
    write_by_month(s_df(spark, [wo(900 + i, "2001-02-20") for i in range(3)]), folder, "completion_date")
    second = months(folder)
    changed = "completion_month=2001-02"
    assert {m: f for m, f in second.items() if m != changed} == {m: f for m, f in first.items() if m != changed}
    got = scan_workorders(spark, folder)
    assert got.where("completion_month = '2001-02'").count() == 3 and got.count() == 63

    broken = s_df(spark, [wo(1, "2001-02-01"), wo(2, "2001-03-01")]).withColumn("problem_desc", F.raise_error(F.lit("source unavailable")).cast("string"))
    with pytest.raises(Exception, match="source unavailable"):
        write_by_month(broken, folder, "completion_date")
    assert months(folder) == second


def test_a_search_over_an_ingested_extract(spark, folder):
    text = 'city,note,amount\n' 'Bern,"two\nlines, one field",1\n' 'Basel,short\n' 'Chur,long,3,4\n' 'Bern,say ""hi"",5\n' 'Bern,same,6\n' 'Bern,same,6\n' '"Genève","he said ""x""",7\n'
    path = save(f"{folder}/extract.csv", text)
    df = files.ingest_extract(spark, path, f"{folder}/extract")
    assert df.count() == 5 and df.columns == ["city", "note", "amount", files.ROW]
    bad = files.load_result(spark, f"{folder}/extract-bad", schema_of(spark, f"{files.BAD_ROW} string, city string"))
    assert {r.city for r in bad.collect()} == {"Basel", "Chur"} and all(r[0] for r in bad.collect())
    assert views.extract_search(df, "lines, ONE").count() == 1
    assert [r.city for r in views.extract_search(df, "genÈve").collect()] == ["Genève"]
    assert views.extract_search(df, "same").count() == 2
    assert files.read_extract(spark, path).count() == 7


@pytest.mark.parametrize("kind", ["by_problem", "by_store", "by_director", "repeat_detail_view"])
def test_views_survive_a_csv_export(spark, folder, kind):
    from recurwork.plans import catalog
    groups = catalog._whole_groups(spark, SMALL)
    df = views.repeat_detail_view(groups, {}, require_org_filter=False) if kind == "repeat_detail_view" else getattr(views, kind)(groups)
    files.export_csv(df, f"{folder}/{kind}")
    want = files.flat(df)
    back = files.read_extract(spark, f"{folder}/{kind}")
    assert back.columns == df.columns and df.count() > 0
    text = lambda rows: sorted(tuple("" if v is None else str(v) for v in r) for r in rows)
    assert text(back.collect()) == text(want.select(*[F.col(c).cast("string") for c in want.columns]).collect())


def test_nested_columns_in_csv(spark, folder):
    df = spark.sql("SELECT 1L AS store, array('a', 'b, c') AS problems, array(named_struct('rank', 1)) AS assets, map('k', 1) AS m")
    files.export_csv(df, f"{folder}/nested")
    assert [tuple(r) for r in files.read_extract(spark, f"{folder}/nested").collect()] == [("1", "a, b, c", '[{"rank":1}]', '{"k":1}')]
