"""Paging, key-set paging, sort allow-lists, first-k, and the sink that keeps the last result."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from recurwork import schemas
from recurwork.operators.ordering import page, page_after, sort_by_field, top_k
from recurwork.sources import files


@pytest.fixture(scope="module")
def nums(spark):
    return spark.range(0, 237).select((F.col("id") % 17).alias("a"), F.col("id").alias("b"))


def test_offset_pages_and_keyset_pages_agree(nums):
    ordered = nums.orderBy(F.col("a").desc(), F.col("b").desc())
    full = [tuple(r) for r in ordered.collect()]
    by_offset, by_key, after = [], [], None
    for p in range(0, 237 // 50 + 1):
        by_offset += [tuple(r) for r in page(ordered, p, 50).collect()]
        chunk = [tuple(r) for r in page_after(nums, ["a", "b"], after, 50, descending=True).collect()]
        by_key += chunk
        after = chunk[-1] if chunk else after
    assert by_offset == full and by_key == full


def test_page_rejects_bad_arguments(nums):
    with pytest.raises(ValueError):
        page(nums, -1, 10)
    with pytest.raises(ValueError):
        page(nums, 0, 0)


def test_sort_field_allow_list(nums):
    out = sort_by_field(nums, "x", True, {"x": "a"}, [F.col("b").asc()]).first()
    assert (out.a, out.b) == (16, 16)
    with pytest.raises(ValueError):
        sort_by_field(nums, "b; drop", True, {"x": "a"}, [])


def test_first_k_bites_and_none_keeps_all(nums):
    order = [F.col("a").desc(), F.col("b").desc()]
    full = [tuple(r) for r in nums.orderBy(*order).collect()]
    assert [tuple(r) for r in top_k(nums, order, 14).collect()] == full[:14]
    assert [tuple(r) for r in top_k(nums, order, None).collect()] == full


def test_failed_write_keeps_the_last_result_and_raises(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="recurwork-fail-"), "pairs")

    def broken():
        raise RuntimeError("source unavailable")

    with pytest.raises(RuntimeError):
        files.write_or_keep(spark, broken, schemas.REPEAT_PAIRS, path)
    back = files.load_result(spark, path, schemas.REPEAT_PAIRS)
    assert back.count() == 0 and back.schema == schemas.REPEAT_PAIRS  # none before: an empty one

    schema = spark.range(0).schema
    for n in (7, 3):
        files.write_or_keep(spark, lambda n=n: spark.range(n), schema, path + "2")
    with pytest.raises(RuntimeError):
        files.write_or_keep(spark, broken, schema, path + "2")
    failing = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("late"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="late"):
        files.write_or_keep(spark, lambda: failing, schema, path + "2")
    assert files.load_result(spark, path + "2", schema).count() == 3
