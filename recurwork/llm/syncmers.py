"""Document fingerprints from closed syncmers.

Of all substrings of ``K`` code points those are anchors whose least substring of
``S`` code points (by hash) is their first or their last.  The choice looks at
nothing outside the substring, so an edit moves no anchor that it does not touch,
and two anchors are never more than ``K - S`` apart.  A fingerprint is the list
of all anchors of the whole text: per anchor four bytes of its hash and two of
its distance from the previous one, in base64.  A shorter text that is not empty
has one anchor, itself; an empty or null one has none.

:func:`likeness` matches anchors by position: twice the length of the longest
common run of anchors in order (equal ends first, then the longest increasing
chain of equal hashes between) over the number of anchors; 1 for equal
fingerprints, 0 for an empty and a non-empty one.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurwork.llm.common import code_points, mix64, sha256_hex, slices

#: K is a multiple of S; K - S fits in the two bytes of a distance.
K, S = 32, 8
#: Code points that are hashed at a time.
RUN = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)

ANCHOR = np.dtype([("hash", ">u4"), ("gap", ">u2")])


def hashed(points: np.ndarray) -> np.ndarray:
    """Hash of the S code points from each position on."""
    n = len(points) - S + 1
    codes = mix64(points.astype(np.uint64) + np.uint64(1))
    out = codes[:n].copy()
    for j in range(1, S):
        out *= BASE
        out += codes[j:j + n]
    return mix64(out)


def anchors_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors in K code points or more."""
    small = hashed(points)
    window, least = 1, small
    while window * 2 <= K - S + 1:
        least = np.minimum(least[:-window], least[window:])
        window *= 2
    rest = K - S + 1 - window
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    n = len(least)
    at = np.flatnonzero((least == small[:n]) | (least == small[K - S:K - S + n]))
    big = small[at]
    for j in range(S, K, S):
        big = big * BASE + small[at + j]
    return at, mix64(big) >> np.uint64(32)


def packed(at: np.ndarray, big: np.ndarray) -> str:
    out = np.empty(len(at), ANCHOR)
    out["hash"], out["gap"] = big, np.diff(at, prepend=0)
    return base64.b64encode(out.tobytes()).decode()


def fingerprints(texts: list[str]) -> list[str]:
    """Fingerprints of many texts; they are hashed together, in runs of bounded length."""
    out = [""] * len(texts)
    parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
    group: list[tuple[int, int, np.ndarray]] = []  # text, offset in it, code points
    held = 0

    def flush() -> None:
        nonlocal group, held
        if group:
            joined = np.concatenate([p for _, _, p in group])
            starts = np.cumsum([0] + [len(p) for _, _, p in group])
            at, big = anchors_of(joined)
            cuts = np.searchsorted(at, starts)
            for g, (i, offset, p) in enumerate(group):
                own = slice(cuts[g], np.searchsorted(at, starts[g] + len(p) - K, side="right"))  # none that reaches into the next
                parts[i].append((at[own] - starts[g] + offset, big[own]))
        group, held = [], 0

    for i, text in enumerate(texts):
        if not text:
            continue
        if len(text) < K:
            out[i] = packed(np.zeros(1, np.int64), np.frombuffer(bytes.fromhex(sha256_hex(text.encode("utf-8", "surrogatepass"))[:8]), ">u4"))
            continue
        for offset in range(0, len(text) - K + 1, RUN):
            points = code_points(text[offset:offset + RUN + K - 1])
            group.append((i, offset, points))
            held += len(points)
            if held >= RUN:
                flush()
    flush()
    for i, found in parts.items():
        out[i] = packed(np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found]))
    return out


def longest_chain(left: list[int], right: list[int]) -> int:
    """Length of the longest chain, in order on both sides; the n-th occurrence of a hash matches the n-th."""
    places: dict[int, list[int]] = defaultdict(list)
    for i, x in enumerate(left):
        places[x].append(i)
    used: dict[int, int] = defaultdict(int)
    ends: list[int] = []
    for x in right:
        own = places.get(x)
        if own and used[x] < len(own):
            i = own[used[x]]
            used[x] += 1
            at = bisect_left(ends, i)
            ends[at:at + 1] = [i]
    return len(ends)


def hashes(fingerprint: str) -> list[int]:
    return np.frombuffer(base64.b64decode(fingerprint), ANCHOR)["hash"].tolist()


def likeness(left: list[int], right: list[int]) -> float:
    if left == right:
        return 1.0
    n, short = len(left) + len(right), min(len(left), len(right))
    head = next((i for i in range(short) if left[i] != right[i]), short)
    tail = next((i for i in range(short - head) if left[-1 - i] != right[-1 - i]), short - head)
    left, right = left[head:len(left) - tail], right[head:len(right) - tail]
    return 2.0 * (head + tail + (0 if set(left).isdisjoint(right) else longest_chain(left, right))) / n


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_following(docs: DataFrame) -> DataFrame:
    """``doc_id, text, part, last``: whole texts in parts of descending doc_id, where
    each part ends with a copy (``last``) of the first row of the next part, so
    that every row but that copy stands before the row that follows it.  The part
    after the last is the first.  Equal doc_ids are ordered by text; null comes last.

    One shuffle of the texts.  The bounds of the parts are quantiles of doc_id;
    the driver holds one doc_id per part.
    """
    spark = docs.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select("doc_id", "text")
    bounds = sorted(set(docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n)))
    if bounds:
        rank = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol="key", outputCol="rank", handleInvalid="keep")
        docs = rank.transform(docs.withColumn("key", F.col("doc_id").cast("double")))
        part = F.when(F.col("key").isNull(), n + 1).otherwise(n - F.col("rank")).cast("int")
    else:
        part = F.lit(0)
    docs = docs.select("doc_id", "text", part.alias("part"))
    heads = docs.groupBy("part").agg(F.max(F.struct("doc_id")).alias("head")).orderBy("part").collect()
    before = [(h["head"]["doc_id"], h["part"], heads[i - 1]["part"]) for i, h in enumerate(heads)]
    firsts = spark.createDataFrame(before, "head long, own int, to int")
    copies = (docs.join(F.broadcast(firsts), (F.col("part") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("head")))
              .groupBy("to", "doc_id").agg(F.min(F.struct(F.col("text").isNotNull().alias("told"), "text")).alias("least"))
              .select("doc_id", "least.text", F.col("to").alias("part"), F.lit(True).alias("last")))
    return (docs.withColumn("last", F.lit(False)).union(copies)
            .repartition(n // 4, "part").sortWithinPartitions("part", "last", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text")))


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                   ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def compare(rows: list[tuple[int | None, str, bool]]) -> list[list]:
    """Results for each row that is not a copy, from it and the row behind it; the last row is only looked at."""
    texts = [t for _, t, _ in rows]
    at = [i for i in range(len(rows) - 1) if not rows[i][2]]
    changed = [edited(texts[i], texts[i + 1]) for i in at]
    own, other = fingerprints(texts), fingerprints(changed)
    lists = [hashes(f) for f in own]
    return [[rows[i][0] for i in at], [len(texts[i]) for i in at], [sha256_hex(c.encode("utf-8", "surrogatepass")) for c in changed],
            [own[i] for i in at], other, [likeness(lists[i], hashes(o)) for i, o in zip(at, other, strict=True)],
            [likeness(lists[i], lists[i + 1]) for i in at]]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Every text's fingerprint, that of its edited text, and how near it is to that and to the next document.

    The edited text has its last floor(n / 2) code points replaced by the first
    as many of the next document by descending doc_id.  Null text counts as
    empty; repeated rows follow each other; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str, bool]] = []
        for batch in batches:
            for part in slices(batch):
                held += [(i, t or "", c) for i, t, c in zip(*(part.column(k).to_pylist() for k in ("doc_id", "text", "last")), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(compare(held), ARROW, strict=True)], schema=ARROW)
                held = held[-1:]

    return with_following(docs).mapInArrow(run, SCHEMA)
