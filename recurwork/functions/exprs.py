"""Predicates, defaults and scalar helpers as built-in Column expressions.

All of these stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (reference semantics):
# problem types that are planned work, not breakdowns; compared upper-cased,
# with NULL folded to '' first so NULL types are excluded as well.
EXCLUDED_PROBLEM_TYPES = ("PM", "SCHEDULED SERVICE", "PREVENTIVE MAINTENANCE", "PEST CONTROL", "NONE", "")
# Trade prefix of facility-maintenance work (case-insensitive).
FM_TRADE_PREFIX = "FM "
# Technician values that mean "no technician".
MISSING_TECH = ("", "None")
# Default shown for an empty organisation level.
UNASSIGNED = "Unassigned"
UNKNOWN = "Unknown"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_lit(as_of) -> Column:
    """The run date as a DATE literal (replaces CURRENT_DATE for repeatable runs)."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def day_lookback(c, as_of, days: int) -> Column:
    """P1 — ``c >= as_of - days``."""
    return _c(c) >= F.date_sub(as_of_lit(as_of), days)


def upper_prefix(c, prefix: str) -> Column:
    """P5 — ``UPPER(c) LIKE 'prefix%'``; NULL is not a match."""
    return F.upper(_c(c)).startswith(prefix.upper())


def not_in_upper(c, values) -> Column:
    """P6 — null-safe, case-insensitive exclusion list (NULL counts as '')."""
    return ~F.upper(F.coalesce(_c(c), F.lit(""))).isin(list(values))


def present_tech(c) -> Column:
    """P3 + P7 — technician known: not NULL, not '' and not the text 'None'."""
    return _c(c).isNotNull() & ~_c(c).isin(list(MISSING_TECH))


def default(c, value) -> Column:
    """P8 — COALESCE to a default."""
    return F.coalesce(_c(c), F.lit(value))


def falsy_default(c, value: str = UNASSIGNED) -> Column:
    """P9 — NULL and '' both become ``value`` (no trimming)."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(value))


def blank_to_null(c) -> Column:
    """P10 — ``NULLIF(TRIM(c), '')``."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def first_non_empty(*cols) -> Column:
    """``a || b`` of the views: the first argument that is neither NULL nor ''."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def optional_equalities(filters: dict | None, columns: dict | None = None) -> Column:
    """P14 — conjunction of ``col == value`` for the non-empty filters only."""
    columns = columns or {}
    terms = [_c(columns.get(k, k)) == F.lit(v) for k, v in (filters or {}).items() if v]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def either_equals(a, b, value) -> Column:
    """P16 — keep when either column equals ``value``; NULLs do not match."""
    return F.coalesce((_c(a) == F.lit(value)) | (_c(b) == F.lit(value)), F.lit(False))


def text_haystack(cols) -> Column:
    """Lower-cased concatenation of columns joined by one space; NULL → ''."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.lower(F.concat_ws(" ", *parts))


def contains_text(cols, q: str) -> Column:
    """P18 — literal (not LIKE) substring search over several columns joined."""
    if not q:
        return F.lit(True)
    return F.instr(text_haystack(cols), q.lower()) > 0


def any_column_contains(cols, q: str) -> Column:
    """P19 — any single column contains ``q`` (case-insensitive, literal)."""
    if not q:
        return F.lit(True)
    terms = [F.instr(F.lower(F.coalesce(_c(c).cast("string"), F.lit(""))), q.lower()) > 0 for c in cols]
    return reduce(lambda a, b: a | b, terms, F.lit(False))


def num(c) -> Column:
    """``num()`` of the views: parse as a number or 0 (NaN → 0)."""
    d = _c(c).cast("string").try_cast("double")
    return F.when(F.isnan(F.coalesce(d, F.lit(0.0))), F.lit(0.0)).otherwise(F.coalesce(d, F.lit(0.0)))


def strip_first(c, prefix: str) -> Column:
    """Remove the first occurrence of ``prefix`` only (JS ``String.replace``)."""
    return F.regexp_replace(_c(c), "(?s)^(.*?)" + _re_escape(prefix), "$1")


def strip_label_prefixes(c, prefixes=("FM - ", "PM - ", "CF - ")) -> Column:
    """Chain of first-occurrence removals, in the given order."""
    out = _c(c)
    for p in prefixes:
        out = strip_first(out, p)
    return out


def shorten(c, n: int, keep: int | None = None, mark: str = "...") -> Column:
    """Label with a mark behind its first ``keep`` (n - 2) characters when longer than ``n``."""
    keep = n - 2 if keep is None else keep
    return F.when(F.length(_c(c)) > n, F.concat(F.substring(_c(c), 1, keep), F.lit(mark))).otherwise(_c(c))


def unassigned_prefix(c) -> Column:
    """Facet normalisation: anything starting with 'Unassigned' reads 'Unassigned'."""
    return F.when(_c(c).startswith(UNASSIGNED), F.lit(UNASSIGNED)).otherwise(_c(c))


def _re_escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?{}[]\|()" else ch)
    return "".join(out)
