"""Top-k, sorting by a user-chosen field, and paging (T1–T6)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top_k(df: DataFrame, order: list, k: int | None) -> DataFrame:
    """T1/T2 — ``ORDER BY .. LIMIT k``; planned as TakeOrderedAndProject (no full sort).

    A task sends its own first ``k`` rows on, so ``k`` is for what a reader looks
    at; for a whole table leave it None.  ``order`` should end with the grouping keys so the cut is deterministic.
    ``k=None`` keeps every row, fully sorted.
    """
    out = df.orderBy(*order)
    return out.limit(k) if k is not None else out


def sort_by_field(df: DataFrame, field: str, descending: bool, allowed: dict,
                  tie_break: list) -> DataFrame:
    """T4 — sort by a field chosen at run time, checked against an allow-list.

    ``allowed`` maps the public field name to a Column (or column name).
    """
    if field not in allowed:
        raise ValueError(f"unknown sort field {field!r}; allowed: {sorted(allowed)}")
    key = _c(allowed[field])
    key = key.desc_nulls_last() if descending else key.asc_nulls_first()
    return df.orderBy(key, *tie_break)


def page(df: DataFrame, page_no: int, size: int) -> DataFrame:
    """T6 — rows ``[page_no * size, (page_no + 1) * size)`` of an already sorted frame.

    Planned as one TakeOrderedAndProject of ``offset + size`` rows, so memory is
    bounded by the page depth, not the table.  For deep pages use
    :func:`cursor_page`.
    """
    if page_no < 0 or size <= 0:
        raise ValueError("page_no must be >= 0 and size > 0")
    return df.offset(page_no * size).limit(size) if page_no else df.limit(size)


@dataclass(frozen=True)
class Key:
    """One key of an order: a column of the sorted frame and its direction.

    NULL stands first in ascending and last in descending order, unless told otherwise.
    """

    name: str
    descending: bool = False
    nulls_first: bool | None = None

    @property
    def null_leads(self) -> bool:
        return not self.descending if self.nulls_first is None else self.nulls_first

    def reversed(self) -> Key:
        return Key(self.name, not self.descending, not self.null_leads)

    def column(self) -> Column:
        c = F.col(self.name)
        if self.descending:
            return c.desc_nulls_first() if self.null_leads else c.desc_nulls_last()
        return c.asc_nulls_first() if self.null_leads else c.asc_nulls_last()

    def follows(self, value) -> Column:
        """Whether a row's key stands behind ``value``."""
        c = F.col(self.name)
        if value is None:
            return c.isNotNull() if self.null_leads else F.lit(False)
        behind = c < F.lit(value) if self.descending else c > F.lit(value)
        return behind if self.null_leads else behind | c.isNull()  # NULL > value is not true


def follows(order: list[Key], after: tuple) -> Column:
    """Whether a row stands behind the row whose keys are ``after``: the first key that differs decides."""
    if len(after) != len(order):
        raise ValueError(f"a cursor of this order has {len(order)} values")
    behind, equal = [], []
    for key, value in zip(order, after):
        behind.append(reduce(and_, equal, key.follows(value)))
        equal.append(F.col(key.name).eqNullSafe(F.lit(value)))
    return reduce(or_, behind)


def cursor(order: list[Key], row) -> tuple:
    """The cursor of a row that a page returned."""
    return tuple(row[key.name] for key in order)


def cursor_page(df: DataFrame, order: list[Key], size: int, after: tuple | None = None, before: tuple | None = None) -> DataFrame:
    """T6 — the ``size`` rows behind the cursor ``after``, or those just before the cursor ``before``, in order.

    The order must be total: its keys tell any two rows apart.  A page costs the same
    however deep it lies: rows up to the cursor are filtered out at the scan or
    below the sort, and a task keeps ``size`` rows.  Directions and places of NULL
    may differ from key to key, and keys of the cursor may be NULL.
    """
    if size <= 0 or (after is not None and before is not None):
        raise ValueError("size must be > 0, and a page lies after a cursor or before one")
    if before is not None:
        back = [key.reversed() for key in order]
        last = df.where(follows(back, before)).orderBy(*[k.column() for k in back]).limit(size)
        return last.orderBy(*[k.column() for k in order])
    if after is not None:
        df = df.where(follows(order, after))
    return df.orderBy(*[k.column() for k in order]).limit(size)


def page_after(df: DataFrame, order_cols: list[str], after: tuple | None, size: int,
               descending: bool = False) -> DataFrame:
    """Key-set paging over columns that all go one way; see :func:`cursor_page`."""
    return cursor_page(df, [Key(c, descending) for c in order_cols], size, after)
