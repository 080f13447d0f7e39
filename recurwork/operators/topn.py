"""Bounded ordered lists per group (STRING_AGG .. ORDER BY .. LIMIT n).

``row_number() <= n`` over the group is planned as a partial
WindowGroupLimit *before* the shuffle, so no map task sends more than ``n``
rows per group and a hot group never reaches one task whole; the list is then
collected from at most ``n`` rows per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_rows(df: DataFrame, group: list, order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """The first ``n`` rows of every group in ``order`` with their 1-based rank."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def ranked_list(df: DataFrame, group: list, order: list[Column], n: int, fields: dict,
                out_col: str) -> DataFrame:
    """One row per group with ``out_col`` = array of structs (rank, fields..) sorted by rank."""
    top = top_n_rows(df, group, order, n, "_rank")
    item = F.struct(F.col("_rank").alias("rank"), *[c.alias(k) for k, c in fields.items()])
    return top.groupBy(*group).agg(F.array_sort(F.collect_list(item)).alias(out_col))


def join_field(arr, field: str, sep: str = ",", max_rank: int | None = None) -> Column:
    """Join one field of a ranked struct array into a string (NULL for an empty array)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    if max_rank is not None:
        a = F.filter(a, lambda x: x["rank"] <= max_rank)
    return F.when(F.size(a) > 0, F.array_join(F.transform(a, lambda x: x[field]), sep))
