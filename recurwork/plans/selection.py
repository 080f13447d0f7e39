"""Filtered views from an index of the repeat groups (V7, V7c, V8): a selection reads bitmaps, not S.

The groups are numbered in the order of the filter fields and cut into blocks of 64.
A block is one row: per (field, value) that occurs in it a word whose bits say which of
its groups have that value.  A filter is an AND of words, a facet value stands when its
word has a bit left under the other filters, a count is the number of bits left, and a
sum is that number times the value, as a measure is a field like any other.

A block has at most 64 values per field, so a row is bounded whatever the table holds;
nothing is joined or moved until the values of all blocks are merged, which combines
map-side.  Since blocks follow the order of the fields, each tells the least and the
greatest value of every field, and a selection skips the row groups outside.

Write the index with the other results (``plans.refresh`` does) and read it for each
selection.  An empty table of groups gives an empty index.  NULL and '' are no values of
a facet; a NULL field has a word like any value, but matches no filter, as in
:func:`views.filter_groups`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurwork.functions.exprs import unassigned_prefix
from recurwork.plans.views import FACET_FIELDS, _gate

WORD = 64
#: Fields that no one filters by, but that the KPIs count or add.
COUNTED = ("sn", "r30")
_KEY = ("sn", "pcd", "trade", "cat")


def group_index(groups: DataFrame, fields=FACET_FIELDS) -> DataFrame:
    """One row per 64 groups: ``block``, ``members`` (its groups as bits), ``least`` and ``greatest`` per field, ``items``.

    The order is total (fields, then the key of a group), so a partition that is
    computed again numbers its groups as before.
    """
    order = [*fields, *[k for k in _KEY if k not in fields]]
    kept = list(dict.fromkeys([*order, *COUNTED]))
    rows = groups.select(*kept).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    rows = rows.withColumn("block", F.shiftrightunsigned("_id", 6)).withColumn(
        "bits", F.expr("shiftleft(1L, CAST(_id & 63 AS INT))"))
    every = F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value"))
    rows = rows.withColumn("r30", F.coalesce("r30", F.lit(0)))  # every group has this field, so its bits count the groups
    items = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in dict.fromkeys([*fields, *COUNTED])]
    words = rows.select("block", "bits", F.explode(F.array(every, *items)).alias("x")).select("block", "x.*", "bits") \
        .groupBy("block", "field", "value").agg(F.bit_or("bits").alias("bits"))
    ends = [F.struct(*[end(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]).alias(name)
            for end, name in ((F.min, "least"), (F.max, "greatest"))]
    return words.groupBy("block").agg(
        F.max(F.when(F.col("field").isNull(), F.col("bits"))).alias("members"), *ends,
        F.collect_list(F.when(F.col("field").isNotNull(), F.struct("field", "value", "bits"))).alias("items"))


def _chosen(filters: dict | None, fields) -> dict[str, str]:
    return {k: v for k, v in (filters or {}).items() if v and k in fields}


def _word(field: str, value: str) -> Column:
    """The groups of a block with a value."""
    found = F.filter("items", lambda x: (x["field"] == field) & (x["value"] == value))
    return F.coalesce(F.get(found, F.lit(0))["bits"], F.lit(0).cast("bigint"))


def _selected(chosen: dict[str, str]) -> Column:
    """The groups of a block that pass all filters."""
    return reduce(lambda a, b: a.bitwiseAND(b), [_word(k, v) for k, v in chosen.items()], F.col("members"))


def _reached(chosen: dict[str, str]) -> Column:
    """Whether a block can hold a chosen group, by its least and greatest values."""
    terms = [(F.col(f"least.{k}") <= v) & (F.col(f"greatest.{k}") >= v) for k, v in chosen.items()]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def hits(index: DataFrame, filters: dict | None = None, fields=FACET_FIELDS, of=None) -> DataFrame:
    """Per (field, value) that occurs under all filters the number of groups: ``field``, ``value``, ``groups``."""
    chosen = _chosen(filters, fields)
    blocks = index.filter(_reached(chosen)).select("items", _selected(chosen).alias("sel")).filter(F.col("sel") != 0)
    left = F.filter("items", lambda x: (x["bits"].bitwiseAND(F.col("sel")) != 0) & (x["field"].isin(*of) if of else F.lit(True)))
    return blocks.select("sel", F.explode(left).alias("x")).groupBy("x.field", "x.value").agg(
        F.sum(F.bit_count(F.col("x.bits").bitwiseAND(F.col("sel")))).alias("groups"))


def facets_indexed(index: DataFrame, filters: dict | None = None, fields=FACET_FIELDS) -> DataFrame:
    """V8 from the index: equal to :func:`views.facets` of the groups."""
    chosen = _chosen(filters, fields)
    others = {f: _selected({k: v for k, v in chosen.items() if k != f}).alias(f"_{f}") for f in chosen}
    blocks = index.select("items", "members", _selected(chosen).alias("_all"), *others.values())

    def under(x):
        word = F.col("_all")
        for f in chosen:  # a field is not narrowed by its own filter
            word = F.when(x["field"] == f, F.col(f"_{f}")).otherwise(word)
        return x["field"].isin(*fields) & (x["value"] != "") & (x["bits"].bitwiseAND(word) != 0)

    listed = F.transform(F.filter("items", under), lambda x: F.struct(x["field"].alias("field"), unassigned_prefix(x["value"]).alias("value")))
    stays = [F.struct(F.lit(f).alias("field"), F.lit(v).alias("value")) for f, v in chosen.items()]  # a selection stays in its list
    out = blocks.select(F.explode(F.concat(listed, F.array(*stays)) if stays else listed).alias("x")).select("x.*")
    return out.distinct().orderBy("field", "value")


def kpis_indexed(index: DataFrame, filters: dict | None = None, require_org_filter: bool = True, fields=FACET_FIELDS) -> DataFrame:
    """V7 from the index: equal to :func:`views.filtered_kpis` of the groups."""
    n, field = F.col("groups"), F.col("field")
    out = hits(index, filters, fields, of=(*COUNTED, "prob")).agg(
        F.coalesce(F.sum(F.when(field == "r30", n)), F.lit(0)).alias("pairs"),
        F.coalesce(F.sum(F.when(field == "r30", n * F.col("value").cast("bigint"))), F.lit(0)).alias("repeat_incidents"),
        F.count(F.when(field == "sn", F.col("value"))).alias("stores"),
        F.count(F.when(field == "prob", F.col("value"))).alias("problems"))
    return out.filter(F.lit(not _gate(filters, require_org_filter)))


def problems_indexed(index: DataFrame, by_problem: DataFrame, filters: dict | None = None, require_org_filter: bool = True,
                     fields=FACET_FIELDS) -> DataFrame:
    """V7c from the index and the written roll-up: its rows whose problem occurs under the filters (J6)."""
    if _gate(filters, require_org_filter):
        return by_problem.filter(F.lit(False))
    found = hits(index, filters, fields, of=("prob",)).select("value")
    return by_problem.join(found, F.col("problem").eqNullSafe(F.col("value")), "left_semi").orderBy(F.col("repeat_count").desc(), "problem")
