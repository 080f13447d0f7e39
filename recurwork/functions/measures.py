"""Derived measures (M1–M10) and the rounded percentage of the views.

Fixed values (reference thresholds):
  gap score / training priority : >= 60 high, >= 30 medium, else low
  urgency of one repeat (days)  : <= 30 high, <= 90 medium, else low
  store severity (repeats 90d)  : > 20 high, > 10 medium, else low
  repeat rate per problem (%)   : > 30 high, > 15 medium, else low
  pair severity (30-day repeats): >= 3 high, >= 2 medium, else low
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def js_round(x: Column) -> Column:
    """``Math.round``: halves go up (toward +inf), result as BIGINT."""
    return F.floor(x + F.lit(0.5))


def pct(n, d) -> Column:
    """``pct(n, d)``: ``round((n / d) * 100)``, 0 when ``d`` is 0 or NULL."""
    n, d = _c(n), _c(d)
    return F.when(F.coalesce(d, F.lit(0)) == 0, F.lit(0).cast("bigint")) \
            .otherwise(js_round(F.try_divide(n.cast("double"), d.cast("double")) * F.lit(100)))


def rate_pct(n, d) -> Column:
    """M7 — ``round(100 * n / d)`` (multiply first, as the view does), 0 when d is 0."""
    n, d = _c(n), _c(d)
    return F.when(F.coalesce(d, F.lit(0)) == 0, F.lit(0).cast("bigint")) \
            .otherwise(js_round(F.try_divide((F.lit(100) * n).cast("double"), d.cast("double"))))


def gap_score(r90, total) -> Column:
    """M2 — ``round((r90 / max(total, 1)) * 100)``."""
    return js_round(F.try_divide(_c(r90).cast("double"), F.greatest(_c(total), F.lit(1)).cast("double"))
                    * F.lit(100))


def band_at_least(x, high, medium) -> Column:
    """Three-way band with inclusive thresholds (M3, M4, M8)."""
    x = _c(x)
    return F.when(x >= high, F.lit("high")).when(x >= medium, F.lit("medium")).otherwise(F.lit("low"))


def band_above(x, high, medium) -> Column:
    """Three-way band with strict thresholds (M6, M7)."""
    x = _c(x)
    return F.when(x > high, F.lit("high")).when(x > medium, F.lit("medium")).otherwise(F.lit("low"))


def urgency_band(days) -> Column:
    """M5 — days since the previous visit: <= 30 high, <= 90 medium, else low (missing = 0)."""
    d = F.coalesce(_c(days), F.lit(0))
    return F.when(d <= 30, F.lit("high")).when(d <= 90, F.lit("medium")).otherwise(F.lit("low"))


def pair_severity(r30, two_levels: bool = False) -> Column:
    """M8 — repeat group severity: >= 3 high, >= 2 medium, else low (detail table: >= 3 high, else medium)."""
    r30 = _c(r30)
    if two_levels:
        return F.when(r30 >= 3, F.lit("high")).otherwise(F.lit("medium"))
    return band_at_least(r30, 3, 2)


def code_if_distinct(code, prob) -> Column:
    """M10 — the problem code only when non-empty and different from the type."""
    code, prob = _c(code), _c(prob)
    return F.when((F.coalesce(code, F.lit("")) != "") & (code != F.coalesce(prob, F.lit(""))), code)
