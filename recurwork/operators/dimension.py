"""The work-order dimension W, reduced to one row per tracking number.

W is assumed, never guaranteed, to be unique on ``tracking_nbr``; a duplicate
would fan out every join and inflate counts.  The survivor is decided over all
columns of W, before any projection, so every query sees the same one: the row
with the most values, then the smallest values in column order, NULL last.

When W's key is guaranteed (a declared primary key), callers pass
``w_unique=True`` and the de-duplication — a sort of all of W — is skipped.

Plan shape: ``row_number() == 1`` becomes a partial WindowGroupLimit before the
exchange on ``tracking_nbr`` (at most one row per key leaves each map task),
and the joins that follow are on the same key, so they reuse this partitioning
instead of shuffling W again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = "tracking_nbr"


def dedupe_dim(w: DataFrame) -> DataFrame:
    cols = [c for c in w.columns if c != KEY]
    filled = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    order = [filled.desc(), *[F.col(c).asc_nulls_last() for c in cols]]
    rn = F.row_number().over(Window.partitionBy(KEY).orderBy(*order))
    return w.withColumn("_rn", rn).filter(F.col("_rn") == 1).drop("_rn")


def enrich(facts: DataFrame, w: DataFrame, columns: list[str], dedupe: bool = True) -> DataFrame:
    """J1 — left outer join of facts to W on tracking_nbr, W projected to ``columns``.

    No broadcast hint: the planner (and AQE, from runtime sizes) broadcasts W
    only below ``spark.sql.autoBroadcastJoinThreshold``; above it the join is a
    sort-merge join with AQE skew splitting.
    """
    dim = (dedupe_dim(w) if dedupe else w).select(KEY, *columns)
    return facts.join(dim, KEY, "left")
