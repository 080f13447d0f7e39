"""S1–S3: scans of the three inputs with their declared schemas.

Only the columns of the declared schema are selected, so Catalyst prunes the
parquet read to them; filters written later by the operators are pushed into
the scan (``PushedFilters``).  Types are coerced here, once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recurwork import schemas


# Month partition columns ('yyyy-MM') written by :func:`write_by_month`.
MONTH_COLUMNS = {"completion_date": "completion_month", "call_date": "call_month"}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types.

    A month partition column written by :func:`write_by_month` is kept, so the
    lookback filters can prune whole directories.
    """
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            # TIMESTAMP / TIMESTAMP_NTZ / DATE / ISO text all land on a calendar day
            c = F.to_date(c)
        elif df.schema[f.name].dataType != f.dataType:
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    cols += [F.col(m) for m in MONTH_COLUMNS.values() if m in df.columns]
    return df.select(*cols)


def write_by_month(df: DataFrame, path: str, date_col: str) -> None:
    """Write the months of ``date_col`` that ``df`` holds; other months of the table stay as they are.

    Rows are gathered by month first, so a task opens one file a month: small months
    share a task, and AQE deals a month of more than the advisory size to several.
    The files are staged, and the months exchanged when all tasks are done: a write
    that fails leaves the old ones.  A month is replaced whole; one that should become
    empty has to be deleted.  Rows without a date go to the default partition, which
    no lookback reads.

    The month lookbacks of the operators also filter the partition column, so the
    scan opens only the directories of the months in range.
    """
    month = MONTH_COLUMNS[date_col]
    rows = df.withColumn(month, F.date_format(date_col, "yyyy-MM")).hint("rebalance", F.col(month))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)


def since_month_filter(df: DataFrame, date_col: str, start) -> F.Column:
    """``month_col >= yyyy-MM(start)`` when ``df`` carries the month partition column, else TRUE.

    ``start`` is a foldable date expression, so the predicate is a literal
    partition filter (directory pruning); the exact date filter still applies.
    """
    month = MONTH_COLUMNS[date_col]
    if month not in df.columns:
        return F.lit(True)
    return F.col(month) >= F.date_format(start, "yyyy-MM")


def scan_recurring(spark: SparkSession, path: str) -> DataFrame:
    """S1 — recurring-repeat fact R."""
    return conform(spark.read.parquet(path), schemas.RECURRING)


def scan_workorder_dim(spark: SparkSession, path: str) -> DataFrame:
    """S2 — work-order dimension W (not yet de-duplicated; see operators.dimension)."""
    return conform(spark.read.parquet(path), schemas.WORKORDER_DIM)


def scan_workorders(spark: SparkSession, path: str) -> DataFrame:
    """S3 — raw work-order fact S.

    At scale S is written ``partitionBy`` completion month, so the month
    lookback prunes whole directories before any file is opened.
    """
    return conform(spark.read.parquet(path), schemas.WORKORDERS)
