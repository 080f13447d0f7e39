import numpy as np
from pyspark.sql import functions as F

from recurwork.llm import langid


def test_held_out_accuracy_and_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    own = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and len(own) > 150
    assert np.mean([r.lang_pred == r.lang for r in own]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_nothing_is_learned_from_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.withColumn("lang", F.when(langid.held_out(), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s")).withColumn("score", F.lit("clash"))
    changed = changed.unionByName(changed.where(langid.held_out()).withColumn("text", F.lit("zzz qqq")))
    same = langid.identify(spark, docs).collect()
    other = {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(spark, changed).collect()}
    assert all((r.doc_id, r.lang_pred, r.score) in other for r in same)


def test_unknown_nulls_repeats_long_and_empty(spark):
    train = [(i, f"der die das und nicht {i}" if i % 2 else f"the and that not with {i}", "de" if i % 2 else "en") for i in range(200)]
    odd = [(1000, None, "en"), (1001, "", None), (1002, "12 !? 😀", "en"), (None, "the and with", None), (1003, "nicht und das", None), (1003, "nicht und das", None),
           (1004, "the that and not " * 40_000, None)]
    df = spark.createDataFrame(train + odd, "doc_id long, text string, lang string")
    got = {}
    for r in langid.identify(spark, df).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [got[i][0].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1000][0].score == 0
    assert got[None][0].lang_pred == "en" and [r.lang_pred for r in got[1003]] == ["de", "de"] and got[1004][0].lang_pred == "en"
    assert langid.identify(spark, df.limit(0)).count() == 0
    assert langid.identify(spark, df.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred <> 'und'").count() == 0
    kept = langid.keep_identified(spark, df)
    assert kept.columns == df.columns and kept.where("doc_id >= 1000 and doc_id <= 1002").count() == 0 and kept.where("doc_id < 1000").count() == 200


def test_grams_as_counted_one_by_one():
    tables = langid.tables()
    for text in ("", "a", "Ab  c1-d", "é" * 10, "x y " * 50):
        plain = "".join(c.lower() if c.isalpha() else " " for c in text)
        plain = "".join(c for i, c in enumerate(plain) if i == 0 or c != " " or plain[i - 1] != " ")
        counts, letters = langid.grams(text, tables)
        assert letters == sum(c.isalpha() for c in text)
        assert counts.sum() == sum(max(0, len(plain) - n + 1) for n in range(1, langid.ORDERS + 1))


def test_runs_of_a_long_text_count_as_the_whole(monkeypatch):
    tables = langid.tables()
    text = "the quick brown fox " * 300
    whole = langid.grams(text, tables)[0]
    monkeypatch.setattr(langid, "RUN", 1000)
    assert (langid.grams(text, tables)[0] == whole).all()


def test_penalties_make_the_model_sparse_and_temperature_calibrates():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(300):
        lang = int(rng.integers(2))
        at = np.unique(np.r_[lang, rng.integers(10, 500, 8)])
        rows.append((at, np.full(len(at), len(at) ** -0.5), lang))
    weights, bias = langid.fit(rows, 2, l1=0.5)
    assert (weights != 0).any(axis=1).sum() < 250 and weights[0, 0] > 0 > weights[1, 0]
    logits = np.array([x @ weights[at] + bias for at, x, _ in rows])
    langs = np.array([lang for *_, lang in rows])
    loss = [-np.log(langid.softmax(logits / t)[np.arange(300), langs]).mean() for t in (langid.best_temperature(logits, langs), 1.0, 0.5, 2.0)]
    assert loss[0] <= min(loss) + 1e-9
