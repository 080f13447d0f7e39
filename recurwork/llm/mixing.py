"""Mixing sources to target weights: budgets down a tree, token prefixes at its leaves.

The tree is domain, language, source.  The token budget of a node is shared among
its children by weight; a child never gets more than its subtree can give
(``max_epochs`` times its tokens), and what it cannot take goes to its siblings by
weight.  As the capacity of a subtree counts all of it, a shortage is made good
among siblings first, and reaches the siblings of an ancestor only when the whole
subtree is short.  Shares are rounded down to whole tokens.

A leaf's documents are taken in epochs, each in its own seeded order: all of them
as often as the budget lasts, then the longest prefix of the next epoch that fits
what is left.  The prefix ends at a bound on the order's key, found from token sums
of key ranges of about ``bucket_rows`` documents each, so a leaf with a third of
all rows is never sorted in one task.

DataFrame expressions only.  Tokens are runs of characters other than space, tab,
line feed and carriage return.  Documents without tokens (null or empty text) are
never taken.  Null lang or source is a value of its own, the empty string.  Rows
that share a doc_id share its key and stand or fall together; a null doc_id counts
as an empty string.  A weight of 0 takes nothing.  Texts of any length are counted
whole; an empty table gives an empty mixture.  Other columns are ignored by
:func:`mixture` and kept by :func:`mixed_documents`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recurwork.llm.common import written

TREE = ("domain", "lang", "source")
LEAF = [f"_mix_{level}" for level in TREE]


@dataclass(frozen=True)
class Weights:
    """Whole weights by value, and that of other values."""

    known: dict[str, int] = field(default_factory=dict)
    other: int = 1

    def of(self, column: str) -> Column:
        out = F.lit(self.other)
        for value, weight in self.known.items():
            out = F.when(F.col(column) == value, weight).otherwise(out)
        return out.cast("long")


def with_leaf(docs: DataFrame, domain: Column) -> DataFrame:
    own = (domain, F.col("lang"), F.col("source"))
    return docs.withColumns({
        **{name: F.coalesce(c.cast("string"), F.lit("")) for name, c in zip(LEAF, own, strict=True)},
        "_mix_tokens": F.coalesce(F.regexp_count("text", F.lit("[^ \t\n\r]+")), F.lit(0)).cast("long")})


def key(seed: int, epoch: Column) -> Column:
    """The place of a document in an epoch's order: 60 bits of a digest."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def shared_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``children`` (room, weight, and the parent's ``total``) with their ``budget``.

    In order of room per weight, a child is full if its room is within its part of
    what the children before it leave; from the first that is not, all get the part
    that one gets.
    """
    exact = "decimal(19,0)"
    order = [F.col("room") / F.col("weight"), F.col(name)]
    siblings = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    up = siblings.orderBy(*order)
    out = (children.where("weight > 0")
           .withColumn("left", F.col("total") - F.coalesce(F.sum("room").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("rest", F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("full", F.col("room").cast(exact) * F.col("rest").cast(exact) <= F.col("weight").cast(exact) * F.col("left").cast(exact))
           .withColumn("at", F.row_number().over(up)))
    first = F.min(F.when(~F.col("full"), F.struct("at", "left", "rest"))).over(siblings)
    part = F.expr(f"(cast(weight as {exact}) * cast(first.left as {exact})) div cast(first.rest as {exact})")
    return (out.withColumn("first", first)
            .withColumn("budget", F.when(F.col("full"), F.col("room")).otherwise(F.least(F.col("room"), F.greatest(part, F.lit(0)))).cast("long"))
            .drop("left", "rest", "full", "at", "first"))


def budgets(leaves: DataFrame, weights: tuple[Weights, Weights, Weights], total: Column) -> DataFrame:
    """``leaves`` (leaf columns, ``n``, ``tokens``, ``room``) with their ``budget``."""
    out = None
    for depth, level in enumerate(LEAF):
        path, parent = LEAF[:depth + 1], LEAF[:depth]
        children = leaves.groupBy(*path).agg(F.sum("room").alias("room")).withColumn("weight", weights[depth].of(level))
        if out is None:
            children = children.crossJoin(leaves.agg(total.alias("total")))  # one row
        else:
            children = children.join(out.select(*parent, F.col("budget").alias("total")), parent)
        out = shared_out(children, parent, level)
    return leaves.join(out.select(*LEAF, "budget"), LEAF)


def plan(docs: DataFrame, weights: tuple[Weights, Weights, Weights], total: Column, max_epochs: int, seed: int,
         bucket_rows: int = 10_000) -> DataFrame:
    """Per leaf: its ``budget``, ``epochs`` taken whole, and the ``bound`` of the key within the next.

    ``docs`` has the leaf columns and tokens (:func:`with_leaf`); ``total`` is an
    aggregate over leaves (columns n, tokens, room) that gives the whole budget.
    """
    docs = docs.where("_mix_tokens > 0")
    leaves = written(docs.groupBy(*LEAF).agg(F.count("*").alias("n"), F.sum("_mix_tokens").alias("tokens"))
                     .withColumn("room", F.col("tokens") * max_epochs), "mix-leaves")
    given = written(budgets(leaves, weights, total).withColumn("epochs", F.expr("budget div tokens"))
                    .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")), "mix-budgets")
    # Token sums of key ranges, then of keys inside them.
    keyed = docs.join(given.select(*LEAF, "n", "epochs", "rest"), LEAF).select(*LEAF, "rest", "n", "_mix_tokens", key(seed, F.col("epochs")).alias("key"))
    keyed = keyed.withColumn("bucket", F.expr(f"((key div {1 << 28}) * greatest(1, least(n div {bucket_rows}, {1 << 30}))) div {1 << 32}"))
    at = Window.partitionBy(*LEAF).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = (keyed.groupBy(*LEAF, "bucket").agg(F.sum("_mix_tokens").alias("own"))
            .select(*LEAF, "bucket", F.coalesce(F.sum("own").over(at), F.lit(0)).alias("before")))
    within = Window.partitionBy(*LEAF, "bucket").orderBy("key")  # rows of one key count together
    bounds = (keyed.join(sums, [*LEAF, "bucket"]).withColumn("until", F.col("before") + F.sum("_mix_tokens").over(within))
              .where("until <= rest").groupBy(*LEAF).agg(F.max("key").alias("bound")))
    return given.join(bounds, LEAF, "left").select(*LEAF, "n", "tokens", "budget", "epochs", F.coalesce("bound", F.lit(-1)).alias("bound"))


def times(seed: int) -> Column:
    """How often a document is taken, from its leaf's plan."""
    more = (key(seed, F.col("epochs")) <= F.col("bound")).cast("long")
    return F.when(F.col("_mix_tokens") > 0, F.coalesce(F.col("epochs") + more, F.lit(0))).otherwise(0).cast("long")


def mixture(docs: DataFrame, domain: Column, weights: tuple[Weights, Weights, Weights], total: Column, max_epochs: int, seed: int) -> DataFrame:
    """``doc_id, domain, lang, source, n_tokens, leaf_budget, times`` for every document."""
    counted = written(with_leaf(docs.select("doc_id", "text", "lang", "source"), domain).select("doc_id", *LEAF, "_mix_tokens"), "mix-counted")
    leaves = written(plan(counted, weights, total, max_epochs, seed), "mix-plan")
    return (counted.join(leaves, LEAF, "left")
            .select("doc_id", *[F.col(c).alias(level) for c, level in zip(LEAF, TREE, strict=True)], F.col("_mix_tokens").alias("n_tokens"),
                    F.coalesce("budget", F.lit(0)).alias("leaf_budget"), times(seed).alias("times")))


def mixed_documents(docs: DataFrame, domain: Column, weights: tuple[Weights, Weights, Weights], total: Column, max_epochs: int, seed: int) -> DataFrame:
    """The documents of the mixture with their columns, each as often as it is taken.

    Texts meet the plan, a row per leaf, where they are read: Spark broadcasts it
    while it is small, and splits common leaves in a shuffle join beyond that.
    """
    # The document is one value on the way, so none of its columns can clash with the plan's.
    own = with_leaf(docs.select(F.struct("*").alias("_mix_doc"), "doc_id", "text", "lang", "source"), domain)
    counted = written(own.select("doc_id", *LEAF, "_mix_tokens"), "mix-counted")
    leaves = written(plan(counted, weights, total, max_epochs, seed).select(*LEAF, "epochs", "bound"), "mix-plan")
    taken = own.join(leaves, LEAF).withColumn("_mix_times", times(seed)).where("_mix_times > 0")
    return taken.withColumn("_mix_one", F.explode(F.sequence(F.lit(1).cast("long"), "_mix_times"))).select("_mix_doc.*")
