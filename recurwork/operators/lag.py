"""Skew-safe LAG of a date: the previous row's date within a key, rows ordered by (date, tie).

A plain ``lag() OVER (PARTITION BY key ORDER BY date, tie)`` sends every row
of a key to one task; when one store/problem holds a third of all work orders
that task sorts a third of the data alone, and AQE cannot split a window.

Because only the *date* of the previous row is needed, no row-level window is
required at all:

* a row that is not the first of its (key, day) in ``tie`` order follows a row
  of the same day, so its previous date is its own date;
* the first row of a (key, day) follows the last row of the key's previous
  day, so its previous date is the previous distinct day of the key.

So: one aggregate of (key, day) -> smallest tie value (partial, map-side),
one window over that aggregate (one row per key and day: bounded by the
number of days in the lookback, however hot the key), and one equi-join back
on (key, day).  That join is a plain shuffle join, which AQE's skew handling
splits when one (key, day) is hot; a small day table is broadcast instead.

``tie`` orders the rows of a day; NULL comes first, as in LAG.  Rows that agree
in key, day and tie are one work order: each copy follows the previous day, so
copies are not 0-day repeats of each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def previous_date(df: DataFrame, keys: list[str], date_col: str, tie_col: str,
                  out_col: str = "prev_date") -> DataFrame:
    """Add ``out_col`` = date of the previous row of the same ``keys`` in (date, tie) order.

    ``keys`` and ``date_col`` must be non-null (callers filter them first).
    """
    tie = F.struct(F.col(tie_col).isNotNull().alias("known"), F.col(tie_col).alias("tie"))
    days = df.groupBy(*keys, date_col).agg(F.min(tie).alias("_first"))
    days = days.withColumn("_prev_day", F.lag(date_col).over(Window.partitionBy(*keys).orderBy(date_col)))
    j = df.join(days, keys + [date_col], "inner")
    prev = F.when(F.col(tie_col).eqNullSafe(F.col("_first.tie")), F.col("_prev_day")).otherwise(F.col(date_col))
    return j.withColumn(out_col, prev).drop("_first", "_prev_day")


def previous_date_plain(df: DataFrame, keys: list[str], date_col: str, tie_col: str,
                        out_col: str = "prev_date") -> DataFrame:
    """One-window LAG (the reference's shape); used to cross-check :func:`previous_date`."""
    w = Window.partitionBy(*keys).orderBy(F.col(date_col), F.col(tie_col))
    return df.withColumn(out_col, F.lag(date_col).over(w))
