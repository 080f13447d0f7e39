"""A gram index for the searches (P18, P19): a search reads the parts of a table that can hold its text.

:func:`write_searchable` writes a table in parts, clustered by chosen columns, and
beside it the postings: which grams of one, two and three characters occur in which
part.  A text that holds ``q`` holds all its grams, so :func:`narrowed` keeps the parts
that hold every gram of three of ``q`` (a shorter ``q`` is a gram itself) and Spark
prunes the others before it opens a file.  The view that searches then verifies each
row exactly, as it does without an index; the index loses no row and decides none.

The postings are sorted by gram, so a search reads the row groups of its few grams.
The list of parts that is broadcast has at most ``parts`` rows, whatever is searched.

Grams are of the lower-cased columns joined by one space, NULL as '', which covers a
search over all columns and over any single one.  An empty search reads the whole
table; an empty table is found empty.  The index is as old as its table: write both anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recurwork.functions.exprs import text_haystack

LONGEST = 3
PART_BYTES = 128 << 20
PART, GRAM = "_part", "_gram"


def parts_for(table_bytes: int, part_bytes: int = PART_BYTES) -> int:
    """Parts of about ``part_bytes`` each."""
    return max(1, -(-table_bytes // part_bytes))


def grams(text: Column) -> Column:
    """The distinct grams of one to ``LONGEST`` characters of a lower-cased text."""
    def of(n: int) -> Column:
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substr(text, i, F.lit(n)))

    return F.array_distinct(F.flatten(F.array(*[of(n) for n in range(1, LONGEST + 1)])))


def grams_of(q: str) -> list[str]:
    """The grams that a row with ``q`` must have."""
    q = q.lower()
    n = min(len(q), LONGEST)
    return sorted({q[i:i + n] for i in range(len(q) - n + 1)}) if q else []


def write_searchable(df: DataFrame, at: str, columns: Sequence[str | Column], parts: int, cluster: Sequence[str]) -> str:
    """Write ``df`` in ``parts`` ranges of the ``cluster`` columns and the postings of its ``columns``; returns ``at``."""
    if {PART, GRAM} & set(df.columns):
        raise ValueError(f"{PART} and {GRAM} are names of the index")
    spark, at = df.sparkSession, at.rstrip("/")
    df.limit(0).write.parquet(f"{at}/schema")
    (df.repartitionByRange(parts, *cluster).withColumn(PART, F.spark_partition_id())
     .write.partitionBy(PART).parquet(f"{at}/rows"))
    rows = _rows(spark, at)  # postings of what was written, so that both agree on the parts
    found = rows.select(PART, F.explode(grams(text_haystack(columns))).alias(GRAM)).distinct()
    found.repartitionByRange(GRAM).sortWithinPartitions(GRAM, PART).write.parquet(f"{at}/postings")
    return at


def _rows(spark: SparkSession, at: str) -> DataFrame:
    schema = spark.read.parquet(f"{at}/schema").schema
    return spark.read.schema(schema.add(PART, T.IntegerType())).parquet(f"{at}/rows")


def parts_with(spark: SparkSession, at: str, q: str) -> DataFrame:
    """The parts that hold every gram of a non-empty ``q``."""
    wanted = grams_of(q)
    postings = spark.read.schema(f"{PART} int, {GRAM} string").parquet(f"{at}/postings").filter(F.col(GRAM).isin(wanted))
    return postings.groupBy(PART).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(wanted)).select(PART)


def narrowed(spark: SparkSession, at: str, q: str) -> DataFrame:
    """The rows of the parts that can hold ``q``: give them to the view that searches for it."""
    at = at.rstrip("/")
    rows = _rows(spark, at)
    if q:
        rows = rows.join(F.broadcast(parts_with(spark, at, q)), PART, "left_semi")
    return rows.drop(PART)
