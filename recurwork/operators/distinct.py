"""Distinct counts that can be merged (A2, A17): sets as bitmaps, and sketches for those who opt in.

A distinct count of a month says nothing of the distinct count of a quarter.  The set
behind it does: :func:`distinct_sets` keeps one per key as Spark's bitmaps of 32,768
bits, a row per key and bucket of the value range, and :func:`count_sets` merges them
to any coarser key and counts.  Nothing is approximate: every 64-bit integer has a bit
of its own.  Sums of a row's measures are kept beside its bitmap, since each input row
belongs to one bucket; they are additive, and one table answers for both.

Values that are no integers have no bits; :func:`distinct_sketches` estimates their
number (HyperLogLog, relative error about 1.04 / sqrt(2 ** ``lg_k``)) and merges alike.

NULL is no value, as in COUNT(DISTINCT): a key of NULLs only stays, with the count 0.
An empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The columns of a set: the bucket of the value range, and the bits inside it.
BUCKET, MEMBERS = "set_bucket", "set_members"
SKETCH = "set_sketch"
LG_K = 12


def distinct_sets(df: DataFrame, keys: Sequence[str], value: str, measures: dict[str, Column] | None = None) -> DataFrame:
    """Per key and bucket the set of an integer column, and the sums that ``measures`` names.

    Rows are first reduced to one per key and value, by hashing on both, so that a key
    that holds a third of all rows is spread over its values; only those rows meet in a
    bitmap, of 4 KB each.
    """
    measures = measures or {}
    v = "_set_value"
    each = df.withColumn(v, F.col(value).cast("bigint")).groupBy(*keys, v).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(n) for n, c in measures.items()])
    return each.groupBy(*keys, F.bitmap_bucket_number(v).alias(BUCKET)).agg(
        *[F.sum(n).alias(n) for n in measures],
        F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias(MEMBERS))


def merge_sets(sets: DataFrame, keys: Sequence[str | Column], measures: Sequence[str] = ()) -> DataFrame:
    """The sets of a coarser key, themselves sets: union of the members, sum of the measures."""
    return sets.groupBy(*keys, BUCKET).agg(*[F.sum(n).alias(n) for n in measures], F.bitmap_or_agg(MEMBERS).alias(MEMBERS))


def count_sets(sets: DataFrame, keys: Sequence[str | Column], name: str, measures: Sequence[str] = ()) -> DataFrame:
    """Per key the exact number of distinct values, and the sums.  Without keys one row, also for no sets."""
    merged = merge_sets(sets, keys, measures)
    return merged.groupBy(*merged.columns[:len(keys)]).agg(
        *[F.sum(n).alias(n) for n in measures],
        F.coalesce(F.sum(F.bitmap_count(MEMBERS)), F.lit(0)).cast("bigint").alias(name))


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """Per key a sketch of the distinct values of any integer, text or binary column.

    Sketches combine map-side, so a hot key sends one of 2 ** ``lg_k`` bytes per task.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value), lg_k).alias(SKETCH))


def merge_sketches(sketches: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """The sketches of a coarser key."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg(SKETCH).alias(SKETCH))


def estimate_sketches(sketches: DataFrame, keys: Sequence[str | Column], name: str) -> DataFrame:
    """Per key the estimated number of distinct values."""
    merged = merge_sketches(sketches, keys)
    return merged.select(*merged.columns[:len(keys)], F.hll_sketch_estimate(SKETCH).alias(name))
