"""Connected components of a graph whose edges stay in the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurwork.llm.common import written


def state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).collect()[0])


def components(edges: DataFrame) -> DataFrame:
    """``id, root``: each end of an edge (columns ``a``, ``b``) and the least id it is connected with.

    Alternating large and small stars: every id is led to the least of its
    neighbours until only stars are left, in a number of rounds that grows with the
    logarithm of the graph.  Each round is written before the next reads it.  Null
    ends and loops are left out.
    """
    now = (edges.where(F.col("a") != F.col("b"))
           .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct())
    now = written(now, "components")
    last = None
    while (found := state(now)) != last:
        last = found
        both = now.select(F.col("high").alias("id"), F.col("low").alias("next")).union(now.select("low", "high"))
        least = both.groupBy("id").agg(F.least(F.min("next"), F.first("id")).alias("least"))
        large = both.where("next > id").join(least, "id").select(F.col("next").alias("high"), F.col("least").alias("low")).distinct()
        least = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(least, "high").where("low != least").select(F.col("low").alias("high"), F.col("least").alias("low"))
        now = written(small.union(least).distinct(), "components")
    return now.select(F.col("high").alias("id"), F.col("low").alias("root")).union(now.select("low", "low").distinct())
