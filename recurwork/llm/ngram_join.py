"""Similarity join of documents on word shingles: banded MinHash LSH, then exact verification.

A document is the set of its runs of ``WORDS`` words (words end at white space; a
shorter text is one run).  Documents of equal sets are one node with a number of
copies, so copies never meet each other.  Each node has a prefix of MinHash values in
each of ``trees`` bands, all of one length: the longest at which two sets at the
similarity bound share a prefix in some band with probability ``recall``
(:func:`matched_depth`; 6 values in 32 bands for 0.8 and 0.9999; pairs above the bound
are found more surely).  This takes the place of an LSH forest, whose tries would
shorten prefixes node by node: links are counted exactly, so every pair at the bound
has to meet, and a prefix kept longer at a crowded node would part some.

Nodes that share a prefix are led to the least of them, which makes clusters; any
two nodes that share a prefix are in one cluster.  All pairs of a cluster are
verified exactly inside tasks: a cluster is cut into blocks of bounded size, and a
task gets two of them.  It returns a row per node with links, its number of linked
documents and the least node it is connected with, so what leaves a task does not
grow with the number of pairs.

Null and empty texts, and those of white space, have no words and no links; each
is a class of its own.  Rows that repeat a doc_id are documents of their own.  A
class is named by its least doc_id, null only if it has no other.  Other columns
are ignored by :func:`join_similar` and kept by :func:`one_of_each`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurwork.llm.common import code_points, map_rows, mix64, slices, written
from recurwork.llm.components import components

WORDS = 5
#: Similarity bound as a fraction, so that verification is exact.
NUMERATOR, DENOMINATOR = 4, 5
#: Nodes and shingles of a block.
BLOCK_NODES, BLOCK_SHINGLES = 1024, 1 << 21
STEP = np.uint64(0x9E3779B97F4A7C15)


def matched_depth(trees: int, recall: float, deepest: int = 16) -> int:
    """The longest prefix whose matches reach the recall at the similarity bound."""
    depth = deepest
    while depth > 1 and 1 - (1 - (NUMERATOR / DENOMINATOR) ** depth) ** trees < recall:
        depth -= 1
    return depth


def space_table() -> np.ndarray:
    out = np.zeros(0x110000, bool)
    out[[i for i in range(0x3001) if chr(i).isspace()]] = True
    return out


def shingles_of(text: str, spaces: np.ndarray) -> np.ndarray:
    """The sorted set of hashed shingles of a text."""
    points = code_points(text)
    inside = ~spaces[points]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    points, inside, starts, ends = points[starts[0]:], inside[starts[0]:], starts - starts[0], ends - starts[0]
    place = np.arange(len(points)) - np.repeat(starts, np.diff(starts, append=len(points)))
    letters = np.where(inside, mix64(points.astype(np.uint64) + STEP * (place.astype(np.uint64) + np.uint64(1))), np.uint64(0))
    words = mix64(np.add.reduceat(letters, starts) + (ends - starts).astype(np.uint64))
    n = min(WORDS, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        out = out * STEP + words[j:j + len(out)]
    return np.unique(mix64(out + np.uint64(n)))


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    sums = [np.add.reduce(mix64(shingles ^ np.uint64(seed))) for seed in (0x51ED270B, 0xA24BAED4)]
    return np.array(sums, ">u8").tobytes()


def trie_nodes(shingles: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Per trie: a hash of the prefix of the set's label."""
    rng = np.random.default_rng(5)
    n = trees * depth
    factors, masks = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    folded = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(folded), 2048):
        part = (folded[at:at + 2048] ^ masks[:, None]) * factors[:, None]
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        np.minimum(least, part.min(axis=1), out=least)
    label = least.reshape(trees, depth).astype(np.uint64)
    out = np.arange(1, trees + 1, dtype=np.uint64) * STEP
    for j in range(depth):
        out = mix64(out ^ label[:, j])
    return out.view(np.int64)


def signatures(docs: DataFrame, trees: int, depth: int) -> DataFrame:
    """``id, told, doc_id, key, size, tries`` per document with words."""

    def run(columns: list[list]) -> list[list]:
        spaces = space_table()
        out: list[list] = [columns[0], columns[1], [], [], []]
        for text in columns[2]:
            own = shingles_of(text or "", spaces)
            out[2].append(set_key(own) if len(own) else None)
            out[3].append(len(own))
            out[4].append(trie_nodes(own, trees, depth) if len(own) else None)
        return out

    arrow = pa.schema([("doc_id", pa.int64()), ("told", pa.int64()), ("key", pa.binary()), ("size", pa.int64()), ("tries", pa.list_(pa.int64()))])
    return map_rows(docs.select("doc_id", told(), "text"), run, "doc_id long, told long, key binary, size long, tries array<long>", arrow)


def told() -> Column:
    return F.xxhash64("text").alias("told")


VERIFIED = "key binary, hub binary, links long"
VERIFIED_ARROW = pa.schema([("key", pa.binary()), ("hub", pa.binary()), ("links", pa.int64())])
DENSE = 16


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the numbers of common shingles of every two sets (above the diagonal)."""
    n = len(sets)
    values, owners = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    counts = np.diff(starts, append=len(values))
    out = np.zeros((n, n), np.float32)
    many = starts[counts > DENSE], counts[counts > DENSE]
    for at in range(0, len(many[0]), 4096):  # shingles of many sets: a matrix product
        own_starts, own = many[0][at:at + 4096], many[1][at:at + 4096]
        rows = np.repeat(np.arange(len(own)), own)
        picks = np.repeat(own_starts - np.r_[0, np.cumsum(own)[:-1]], own) + np.arange(own.sum())
        grid = np.zeros((len(own), n), np.float32)
        grid[rows, owners[picks]] = 1
        out += grid.T @ grid
    for size in range(2, DENSE + 1):  # shingles of few: their pairs
        own = starts[counts == size]
        for at in range(0, len(own), 1 << 16):
            part = own[at:at + (1 << 16)]
            for a in range(size):
                for b in range(a + 1, size):
                    np.add.at(out, (owners[part + a], owners[part + b]), np.float32(1))
    return out


def verify(keys: list[bytes], copies: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> tuple[list, list, list]:
    """Nodes with links between a left and a right one: the node, the least it is connected with, its linked documents."""
    sizes = np.array([len(s) for s in sets], np.float64)
    common = shared(sets)
    common = np.maximum(common, common.T)
    linked = (NUMERATOR + DENOMINATOR) * common.astype(np.float64) >= NUMERATOR * (sizes[:, None] + sizes[None, :])
    linked &= (left[:, None] & right[None, :]) | (right[:, None] & left[None, :])
    np.fill_diagonal(linked, False)
    links = linked @ copies
    rank = np.argsort(np.argsort(np.array(keys, object)))
    while True:
        least = np.minimum(rank, np.where(linked, rank[None, :], len(keys)).min(axis=1))
        if (least == rank).all():
            break
        rank = least
    ordered = sorted(keys)
    has = np.flatnonzero(links)
    return [keys[i] for i in has], [ordered[rank[i]] for i in has], links[has].tolist()


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with one (cluster, i, j): verified together."""
    held, rows, spaces = None, [], space_table()

    def done() -> Iterator[pa.RecordBatch]:
        if len(rows) > 1:
            sets = [np.frombuffer(r[3], np.uint64) for r in rows]
            block = np.array([r[2] for r in rows])
            out = verify([r[0] for r in rows], np.array([r[1] for r in rows], np.int64), sets, block == held[1], block == held[2])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, VERIFIED_ARROW, strict=True)], schema=VERIFIED_ARROW)

    for batch in batches:
        for cluster, i, j, key, copies, block, own in zip(*(batch.column(k) for k in range(7)), strict=True):
            group = (cluster.as_py(), i.as_py(), j.as_py())
            if group != held:
                yield from done()
                held, rows = group, []
            if not rows or rows[-1][0] != key.as_py():  # a repeated row
                rows.append((key.as_py(), copies.as_py(), block.as_py(), own.as_py()))
    yield from done()


def shingled(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (columns key, text and others to carry) whose text has that key, with its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces = space_table()
        for batch in batches:
            for part in slices(batch):
                own = [shingles_of(t or "", spaces) for t in part.column("text").to_pylist()]
                right = [len(s) > 0 and set_key(s) == k for s, k in zip(own, part.column("key").to_pylist(), strict=True)]
                at = part.schema.get_field_index("text")
                part = part.set_column(at, "own", pa.array([s.tobytes() for s in own], pa.binary()))
                yield part.filter(pa.array(right, pa.bool_()))

    fields = ", ".join("own binary" if f.name == "text" else f"{f.name} {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, fields)


NO_ID = (1 << 63) - 1


def classes(docs: DataFrame, trees: int = 32, recall: float = 0.9999) -> tuple[DataFrame, DataFrame]:
    """Signatures of all documents, and ``key, class_id, rep, links`` of every node; ``rep`` is (id, hash of the text) of one of its documents."""
    signed = written(signatures(docs, trees, matched_depth(trees, recall)), "ngram-signed")
    nodes = written(signed.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "told")).alias("rep"),
        F.max("size").alias("size"), F.first("tries").alias("tries")), "ngram-nodes")

    # Nodes of one prefix, led to the least of them.
    placed = nodes.select("key", F.explode("tries").alias("prefix"))
    shared_prefix = placed.groupBy("prefix").agg(F.min("key").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    edges = placed.join(shared_prefix, "prefix").select(F.col("key").alias("a"), F.col("hub").alias("b")).distinct()
    clusters = components(edges).withColumnsRenamed({"id": "key", "root": "cluster"})

    # Blocks of each cluster, and every two of them.
    member = clusters.join(nodes.select("key", "copies", "rep", "size"), "key")
    sizes = clusters.join(nodes.select("key", "size"), "key").groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    member = written(member.join(sizes, "cluster").withColumn("block", F.pmod(F.hash("key"), F.col("blocks"))), "ngram-members")
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), told(), "text")
    wanted = member.select("cluster", "key", "copies", "block", "blocks", F.col("rep.id").alias("id"), F.col("rep.told").alias("told"))
    # Always a shuffle join: the members grow with the corpus, so the plan is the same at every size.
    sets = shingled(wanted.hint("merge").join(texts, ["id", "told"]).select("cluster", "key", "copies", "block", "blocks", "text"))
    paired = (sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "key", "copies", "block", "own"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = written(paired.repartition(parts, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "key")
                    .mapInArrow(verified, VERIFIED), "ngram-links")

    # Classes: components of the links.
    linked = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("key").alias("a"), F.col("hub").alias("b"))).withColumnRenamed("id", "key")
    own = nodes.select("key", "first", "copies", "rep").join(roots, "key", "left").join(linked, "key", "left").withColumn("root", F.coalesce("root", "key"))
    names = own.groupBy("root").agg(F.min("first").alias("class_id"), F.min("rep").alias("kept"))
    return signed, own.join(names, "root").select("key", "class_id", "kept", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))


def join_similar(docs: DataFrame, trees: int = 32, recall: float = 0.9999) -> DataFrame:
    """``doc_id, class_id, n_links`` per document: its class, and how many other documents are at the bound or above."""
    signed, known = classes(docs, trees, recall)
    told_of = signed.where("key is not null").join(known, "key").select("doc_id", "class_id", F.col("links").cast("long").alias("n_links"))
    wordless = signed.where("key is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return told_of.unionByName(wordless)


def one_of_each(docs: DataFrame, trees: int = 32, recall: float = 0.9999) -> DataFrame:
    """``docs`` with one document of each class, that of the least doc_id (a null one is last), and all documents without words.

    The texts meet the decisions by doc_id and hash of the text; of rows that
    repeat both, one stays.
    """
    signed, known = classes(docs, trees, recall)
    signed = signed.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_ng_id"), F.col("told").alias("_ng_told"), "key")
    best = (signed.where("key is not null").join(known.select("key", "kept"), "key")
            .where((F.col("_ng_id") == F.col("kept.id")) & (F.col("_ng_told") == F.col("kept.told")))
            .groupBy("_ng_id", "_ng_told").agg(F.count("*").alias("n")))
    best = written(best, "ngram-kept")
    wordless = signed.where("key is null").select("_ng_id", "_ng_told").distinct()
    once = written(best.where("n = 1").drop("n").unionByName(wordless), "ngram-once")
    repeated = written(best.where("n > 1").drop("n"), "ngram-repeated")
    # The document is one value on the way, so none of its columns can clash with these.
    own = docs.select(F.struct("*").alias("_ng_doc"), F.coalesce("doc_id", F.lit(NO_ID)).alias("_ng_id"), F.xxhash64("text").alias("_ng_told"))
    on = ["_ng_id", "_ng_told"]
    return (own.join(once.hint("merge"), on, "left_semi").unionByName(own.join(repeated, on, "left_semi").dropDuplicates(on))
            .select("_ng_doc.*"))
