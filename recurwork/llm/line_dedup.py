"""Lines that many documents hold, dropped by probing a sharded minimal perfect hash.

A line's key is the line without white space at its ends, A-Z in lower case; keys of
``min_chars`` code points or more are hashed to 128 bits.  The distinct hashes are
dealt to shards by their first bits, and each shard is indexed by a minimal perfect
hash (:class:`PerfectHash`): levels of bit vectors in which a hash takes the first
level where no other wants its place, numbered by the marks before it.  The number
leads to compact arrays: 64 bits of fingerprint, the count of documents, the largest
doc_id.

Documents do not join their lines with anything.  They are read in parts of bounded
size, each of which asks every shard once for its distinct hashes, packed in one
value (:func:`parts_of`, :func:`questions`), and gets back the ones to drop with the
doc_id that keeps them (:func:`answers`).  A line that stands in a third of all
documents is one question a part, and no shard grows with it.  Only documents that
lose a line are then met by key.

Documents are rows: each row that holds a key counts once, also if doc_ids repeat.
Rows of the largest doc_id keep their lines, all of them if the id repeats; null
doc_id is smaller than any, and keeps a line only if all its holders are null.  Null
and empty text is one empty line.  Very long texts are parts of their own.  An empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurwork.llm.common import map_rows, mix64, slices, written

#: The white space that a key has not at its ends.
WHITE = " \t\n\v\f\r"
#: A distinct line of a part: 128 bits of its key's hash, the rows that hold it, their largest doc_id if any is known.
LINE = np.dtype([("hi", "<u8"), ("lo", "<u8"), ("n", "<u4"), ("owner", "<i8"), ("known", "?")])
#: Where it stands: its place among the part's lines, the line of the text, the document.
HELD = np.dtype([("key", "<u4"), ("line", "<u4"), ("doc_id", "<i8"), ("known", "?"), ("doc", "<i8")])
#: What a shard asks and knows of a line.
HASH = np.dtype([("hi", "<u8"), ("lo", "<u8")])
ENTRY = np.dtype([("fingerprint", "<u8"), ("n", "<u4"), ("owner", "<i8"), ("known", "?")])
#: A line to drop: its place among the part's lines, and the doc_id that keeps it.
ANSWER = np.dtype([("key", "<u4"), ("owner", "<i8"), ("known", "?")])


@dataclass(frozen=True)
class Limits:
    """What counts as a repeated line, and about how many hashes a shard holds."""

    min_chars: int = 40
    min_docs: int = 5
    shard_keys: int = 1 << 13


# ── a minimal perfect hash ──────────────────────────────────────────────────


def places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mix64(hashes["hi"] ^ mix64(hashes["lo"] + seed)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Numbers n distinct hashes from 0 to n - 1, in about four bits a hash."""

    def __init__(self, sizes: list[int], bits: bytes):
        self.sizes, self.bits = sizes, bits
        marks = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), bitorder="little")
        self.marks = marks
        self.before = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))

    @staticmethod
    def of(hashes: np.ndarray, room: float = 2.0) -> PerfectHash:
        """``hashes`` must be distinct; each level places those that meet no other."""
        left, sizes, levels = hashes, [], []
        while len(left):
            size = -(-int(len(left) * room + 1) // 8) * 8
            at = places(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little").tobytes())
            left = left[~alone[at]]
        return PerfectHash(sizes, b"".join(levels))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash; of one that was not indexed some number, or -1."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        left, start = np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes):
            at = start + places(hashes[left], level, size)
            found = self.marks[at] == 1
            out[left[found]] = self.before[at[found]]
            left, start = left[~found], start + size
        return out


# ── documents in parts ──────────────────────────────────────────────────────


def line_key(line: str, min_chars: int) -> bytes | None:
    key = line.strip(WHITE)
    return key.encode("utf-8", "surrogatepass").lower() if len(key) >= min_chars else None


def part_of(ids: list[int | None], texts: list[str | None], docs: list[int], min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct lines of some documents, sorted by hash, and where they stand."""
    number: dict[bytes, int] = {}
    counts: list[int] = []
    owners: list[int | None] = []
    held = []
    for doc_id, text, doc in zip(ids, texts, docs, strict=True):
        own = set()
        for i, line in enumerate((text or "").split("\n")):
            key = line_key(line, min_chars)
            if key is None:
                continue
            at = number.setdefault(blake2b(key, digest_size=16).digest(), len(number))
            if at == len(counts):
                counts.append(0)
                owners.append(None)
            if at not in own:
                own.add(at)
                counts[at] += 1
                if doc_id is not None and (owners[at] is None or owners[at] < doc_id):
                    owners[at] = doc_id
            held.append((at, i, doc_id or 0, doc_id is not None, doc))
    hashes = np.frombuffer(b"".join(number), dtype=HASH)
    order = np.lexsort((hashes["lo"], hashes["hi"]))
    lines = np.empty(len(order), dtype=LINE)
    lines["hi"], lines["lo"] = hashes["hi"][order], hashes["lo"][order]
    lines["n"] = np.array(counts, dtype=np.uint32)[order]
    lines["owner"] = np.array([o or 0 for o in owners], dtype=np.int64)[order]
    lines["known"] = np.array([o is not None for o in owners], dtype=bool)[order]
    rows = np.array(held, dtype=HELD)
    rank = np.empty(len(order), dtype=np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    rows["key"] = rank[rows["key"]]
    return lines, rows


def parts_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """``part, lines, held`` for each bounded run of documents that holds any line long enough."""
    schema = pa.schema([("part", pa.string()), ("lines", pa.binary()), ("held", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                lines, held = part_of(*(c.to_pylist() for c in piece.columns), min_chars)
                if len(lines):
                    row = {"part": uuid.uuid4().hex, "lines": lines.tobytes(), "held": held.tobytes()}
                    yield pa.RecordBatch.from_pylist([row], schema=schema)

    return docs.select("doc_id", "text", "doc").mapInArrow(run, "part string, lines binary, held binary")


def counted(parts: DataFrame) -> DataFrame:
    """``hi, lo, n, owner``: every distinct line, the rows that hold it, their largest doc_id; counted in the parts first."""

    def run(columns: list[list]) -> list[list]:
        lines = np.concatenate([np.frombuffer(b, dtype=LINE) for b in columns[0]])
        owner = [o if k else None for o, k in zip(lines["owner"].tolist(), lines["known"].tolist(), strict=True)]
        return [lines["hi"].view(np.int64).tolist(), lines["lo"].view(np.int64).tolist(), lines["n"].tolist(), owner]

    arrow = pa.schema([(c, pa.int64()) for c in ("hi", "lo", "n", "owner")])
    found = map_rows(parts.select("lines"), run, "hi long, lo long, n long, owner long", arrow)
    return found.groupBy("hi", "lo").agg(F.sum("n").alias("n"), F.max("owner").alias("owner"))


# ── shards ──────────────────────────────────────────────────────────────────


def shard_bits(n_lines: int, shard_keys: int) -> int:
    """Shards are dealt by so many first bits of a hash."""
    return max(1, min(32, (-(-n_lines // shard_keys) - 1).bit_length()))


def shards_of(index: DataFrame, bits: int) -> DataFrame:
    """Per shard its perfect hash and the arrays that it numbers."""

    schema = pa.schema([("shard", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("entries", pa.binary())])

    def build(rows: pa.Table) -> pa.Table:
        hashes = np.empty(rows.num_rows, dtype=HASH)
        hashes["hi"], hashes["lo"] = (rows[c].to_numpy().view(np.uint64) for c in ("hi", "lo"))
        perfect = PerfectHash.of(hashes)
        at = perfect.numbers(hashes)
        array = np.empty(len(at), dtype=ENTRY)
        array["fingerprint"][at] = hashes["lo"]
        array["n"][at] = np.minimum(rows["n"].to_numpy(), np.iinfo(np.uint32).max)
        array["owner"][at] = rows["owner"].fill_null(0).to_numpy()
        array["known"][at] = rows["owner"].is_valid().to_numpy()
        return pa.table([rows["shard"][:1], [perfect.sizes], [perfect.bits], [array.tobytes()]], schema=schema)

    dealt = index.withColumn("shard", F.shiftrightunsigned("hi", 64 - bits))
    return dealt.groupBy("shard").applyInArrow(build, "shard long, sizes array<long>, bits binary, entries binary")


def questions(parts: DataFrame, bits: int) -> DataFrame:
    """Per part and shard: the hashes that the part asks for, and the place of the first among its lines."""
    schema = pa.schema([("shard", pa.int64()), ("part", pa.string()), ("first", pa.int64()), ("lines", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines = np.frombuffer(blob, dtype=LINE)[["hi", "lo"]].astype(HASH)
                shard = (lines["hi"] >> np.uint64(64 - bits)).astype(np.int64)
                asked, first = np.unique(shard, return_index=True)
                cuts = [*first.tolist(), len(lines)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked), pa.array([part] * len(asked)), pa.array(first),
                     pa.array([lines[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], type=pa.binary())], schema=schema)

    return parts.select("part", "lines").mapInArrow(run, "shard long, part string, first long, lines binary")


def answers(asked: DataFrame, shards: DataFrame, min_docs: int) -> DataFrame:
    """``part, answers``: the lines of a part that ``min_docs`` documents or more hold."""

    schema = pa.schema([("part", pa.string()), ("answers", pa.binary())])

    def probe(asked: pa.Table, shard: pa.Table) -> pa.Table:
        parts, replies = [], []
        if shard.num_rows:
            _, sizes, bits, entries = (c.to_pylist()[0] for c in shard.columns)
            perfect, entries = PerfectHash(sizes, bits), np.frombuffer(entries, dtype=ENTRY)
            for part, first, blob in zip(*(asked[c].to_pylist() for c in ("part", "first", "lines")), strict=True):
                hashes = np.frombuffer(blob, dtype=HASH)
                at = perfect.numbers(hashes)
                entry = entries[np.maximum(at, 0)]
                hit = np.flatnonzero((at >= 0) & (entry["fingerprint"] == hashes["lo"]) & (entry["n"] >= min_docs))
                if len(hit):
                    found = np.empty(len(hit), dtype=ANSWER)
                    found["key"], found["owner"], found["known"] = first + hit, entry["owner"][hit], entry["known"][hit]
                    parts.append(part)
                    replies.append(found.tobytes())
        return pa.table([parts, replies], schema=schema)

    return asked.groupBy("shard").cogroup(shards.groupBy("shard")).applyInArrow(probe, "part string, answers binary")


def dropped_lines(parts: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id, doc, lines``: the lines that each document loses, by their numbers."""

    def run(columns: list[list]) -> list[list]:
        out: dict[tuple, list[int]] = {}
        for blob, replies in zip(*columns, strict=True):
            held = np.frombuffer(blob, dtype=HELD)
            lines = np.concatenate([np.frombuffer(r, dtype=ANSWER) for r in replies])
            lines = lines[np.argsort(lines["key"])]
            at = np.minimum(np.searchsorted(lines["key"], held["key"]), len(lines) - 1)
            line = lines[at]
            keeps = (line["known"] == held["known"]) & (~held["known"] | (line["owner"] == held["doc_id"]))
            lost = held[(line["key"] == held["key"]) & ~keeps]
            for i, known, doc, number in zip(*(lost[c].tolist() for c in ("doc_id", "known", "doc", "line")), strict=True):
                out.setdefault((i if known else None, doc), []).append(number)
        return [[i for i, _ in out], [d for _, d in out], [sorted(set(n)) for n in out.values()]]

    arrow = pa.schema([("doc_id", pa.int64()), ("doc", pa.int64()), ("lines", pa.list_(pa.int64()))])
    replies = found.groupBy("part").agg(F.collect_list("answers").alias("answers"))
    lost = map_rows(parts.select("part", "held").join(replies, "part").select("held", "answers"), run, "doc_id long, doc long, lines array<long>", arrow)
    return lost.groupBy("doc_id", "doc").agg(F.max("lines").alias("lines"))  # rows equal in both lose the same lines


SCHEMA = "doc_id long, n_lines long, n_dropped long, text string"
ARROW = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())])


def kept(text: str | None, lost: list[int] | None) -> tuple[int, int, str]:
    lines = (text or "").split("\n")
    if not lost:
        return len(lines), 0, text or ""
    gone = set(lost)
    return len(lines), len(gone), "\n".join([line for i, line in enumerate(lines) if i not in gone])


def dedup_lines(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Every document without its repeated lines: ``doc_id, n_lines, n_dropped, text``."""
    docs = docs.select("doc_id", "text").withColumn("doc", F.xxhash64("text"))
    parts = written(parts_of(docs, limits.min_chars), "line-parts")
    index = written(counted(parts), "line-index")
    bits = shard_bits(index.count(), limits.shard_keys)
    shards = written(shards_of(index, bits), "line-shards")
    lost = written(dropped_lines(parts, answers(questions(parts, bits), shards, limits.min_docs)), "line-drops")
    lost = lost.select(F.col("doc_id").alias("lost_id"), F.col("doc").alias("lost_doc"), "lines")
    met = docs.join(lost, F.col("doc_id").eqNullSafe(F.col("lost_id")) & (F.col("doc") == F.col("lost_doc")), "left")

    def run(columns: list[list]) -> list[list]:
        found = [kept(t, n) for t, n in zip(columns[1], columns[2], strict=True)]
        return [columns[0], *map(list, zip(*found))]

    return map_rows(met.select("doc_id", "text", "lines"), run, SCHEMA, ARROW)


def digests(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
