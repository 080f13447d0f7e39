"""Spelling variants: words at edit distance one, grouped under the frequent form.

Candidates come from a trie of frequency vectors.  A word's vector counts its letters
group by group (``GROUPS``); one inserted, deleted or replaced letter adds at most one
to one count and takes at most one from another.  The words are arranged by their
counts, group after group, and a depth-first search walks that trie with all words
that still have budget: a surplus of one and a deficit of one (:func:`search`).  Words
that reach a leaf with its words are compared letter by letter (:func:`one_edit`).

Over the cluster the trie is cut at a depth at which no subtree holds more than
``subtree_words`` words, as far as vectors tell them apart.  Each subtree is a group
of its own words and of those that reach it within the budget.  A pair is met once:
words of one subtree by their order, others in the subtree that has one more of the
first count that differs (or one less, if both differ there in nothing else).

Null text has no words.  A null doc_id reads as '' in the counting.  Repeated rows
count as often as they stand.  Texts and words may be of any length; a single text is
held whole by one task.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurwork.llm.common import slices, written

#: Letter groups, one count each; other code points count with the last.
GROUPS = ("e", "n", "t", "a", "i", "r", "o", "s", "h", "l", "u", "d", "cm", "gpwé", "bfvyèêç", "jkqxz")
#: Counts are cut here: what is near stays near.
MOST = 120
#: Distinct words that a task adds up before it passes them on, words of a leaf, pairs compared at a time.
HELD_WORDS, LEAF_WORDS, PAIRS = 1 << 18, 32, 1 << 20
#: Words up to this length are compared as rows of a matrix.
WIDE = 48


# ── words ───────────────────────────────────────────────────────────────────


def counts_of(doc_id: int | None, text: str, letters: re.Pattern, min_chars: int, every: int) -> Iterator[tuple[str, int]]:
    """The words of a text with their counts; of one run in ``every`` a letter is dropped, the same in the whole text."""
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
    seed = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(letters.findall(text)).items():
        h = crc32(run.encode(), seed)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < min_chars:
                continue
        yield run, n


def count_words(docs: DataFrame, min_chars: int = 6, min_count: int = 5, every: int = 199) -> DataFrame:
    """``word, n``: lower-cased runs of letters, those that stand ``min_count`` times or more; added up in the tasks first."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    pattern = "[a-zÀ-ÿ]{%d,}" % min_chars  # a longer run is matched whole

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, held = re.compile(pattern), Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), type=pa.string()), pa.array(list(held.values()), type=pa.int64())], schema=schema)
            held.clear()
            return out

        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for word, n in counts_of(doc_id, text or "", letters, min_chars, every):
                        held[word] += n
                    if len(held) >= HELD_WORDS:
                        yield rows()
        if held:
            yield rows()

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ── frequency vectors ───────────────────────────────────────────────────────


def group_of() -> np.ndarray:
    out = np.full(257, len(GROUPS) - 1, dtype=np.int64)
    for g, letters in enumerate(GROUPS):
        out[[ord(c) for c in letters]] = g
    return out


def vectors(words: list[str]) -> np.ndarray:
    """A row of counts per word."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    cell = owner * len(GROUPS) + group_of()[np.minimum(points, 256)]
    counts = np.bincount(cell, minlength=len(words) * len(GROUPS))
    return np.minimum(counts, MOST).astype(np.int8).reshape(len(words), len(GROUPS))


def with_vectors(words: DataFrame) -> DataFrame:
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("vector", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = vectors(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([v.tobytes() for v in rows], type=pa.binary())], schema=schema)

    return words.select("word", "n").mapInArrow(run, "word string, n long, vector binary")


def depth_for(words: DataFrame, subtree_words: int) -> int:
    """The least depth at which no subtree of the trie holds more words; the driver sees a number per depth."""
    depths = words.select("vector", F.explode(F.sequence(F.lit(0), F.lit(len(GROUPS)))).alias("depth"))
    sizes = depths.groupBy("depth", F.expr("substring(vector, 1, depth)").alias("path")).count()
    for row in sizes.groupBy("depth").agg(F.max("count").alias("most")).orderBy("depth").collect():
        if row.most <= subtree_words:
            return row.depth
    return len(GROUPS)


def steps(depth: int) -> list[tuple[np.ndarray, int, int]]:
    """Ways to another subtree within the budget: what is added to a path, surplus and deficit that it costs.

    Of a way and its reverse only the one whose first step is up: the other word of a pair goes the other way.
    """
    out = [(np.zeros(depth, dtype=np.int8), 0, 0)]
    for up in range(depth):
        for down in [None, *range(depth)]:
            if down == up or (down is not None and down < up):
                continue
            way = np.zeros(depth, dtype=np.int8)
            way[up] = 1
            if down is not None:
                way[down] = -1
            out.append((way, 1, int(down is not None)))
    return out


def dealt(words: DataFrame, depth: int) -> DataFrame:
    """``path, word, n, vector, surplus, deficit``: each word in its own subtree (no cost) and in those it reaches."""
    schema = pa.schema([("path", pa.binary()), ("word", pa.string()), ("n", pa.int64()), ("vector", pa.binary()), ("surplus", pa.int8()), ("deficit", pa.int8())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways = steps(depth)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            counts = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.int8).reshape(batch.num_rows, len(GROUPS))[:, :depth]
            for way, surplus, deficit in ways:
                path = counts + way
                at = np.flatnonzero(((path >= 0) & (path <= MOST)).all(axis=1))
                rows = batch.take(pa.array(at))
                cost = [pa.array(np.full(len(at), c, dtype=np.int8)) for c in (surplus, deficit)]
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in path[at]], type=pa.binary()), *rows.columns, *cost], schema=schema)

    return words.select("word", "n", "vector").mapInArrow(
        run, "path binary, word string, n long, vector binary, surplus byte, deficit byte")


# ── search and comparison ───────────────────────────────────────────────────


def search(words: np.ndarray, others: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of ``others``, row of ``words``) that differ by a surplus and a deficit of one at most.

    ``words`` are the sorted vectors of one subtree that starts at ``depth``; ``surplus`` and ``deficit`` tell
    what the others have spent on the way to it.
    """
    columns, wanted = np.ascontiguousarray(words.T), np.ascontiguousarray(others.T)
    levels = words.shape[1]
    todo = [(0, len(words), depth, np.arange(len(others)), surplus, deficit)]
    while todo:  # depth first: the last branch found is the next to be walked
        low, high, level, q, s, d = todo.pop()
        if level == levels or high - low <= LEAF_WORDS:
            block = max(1, PAIRS // (high - low))
            for start in range(0, len(q), block):
                part = slice(start, start + block)
                left, right = np.repeat(q[part], high - low), np.tile(np.arange(low, high), len(q[part]))
                ls, ld = np.repeat(s[part], high - low), np.repeat(d[part], high - low)
                for rest in range(level, levels):
                    step = columns[rest][right] - wanted[rest][left]
                    ls, ld = ls + (step == 1), ld + (step == -1)
                    ok = np.flatnonzero((step <= 1) & (step >= -1) & (ls <= 1) & (ld <= 1))
                    left, right, ls, ld = left[ok], right[ok], ls[ok], ld[ok]
                if len(left):
                    yield left, right
            continue
        counts, starts = np.unique(columns[level][low:high], return_index=True)
        for count, a, b in zip(counts, low + starts, [*(low + starts[1:]), high]):
            step = count - wanted[level][q]
            ts, td = s + (step == 1), d + (step == -1)
            ok = np.flatnonzero((step <= 1) & (step >= -1) & (ts <= 1) & (td <= 1))
            if len(ok):
                todo.append((a, b, level + 1, q[ok], ts[ok], td[ok]))


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at:] == b[at + 1:] if len(a) < len(b) else a[at + 1:] == b[at + 1:]


class Spelled:
    """Words as rows of code points, from the left and from the right; long ones as they are."""

    def __init__(self, words: list[str]):
        self.words = words
        self.length = np.array([len(w) for w in words])
        wide = min(WIDE, int(self.length.max(initial=1)))
        self.left = np.zeros((len(words), wide), dtype=np.uint32)
        short = np.flatnonzero(self.length <= wide)
        points = np.frombuffer("".join(words[i] for i in short).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        n = self.length[short]
        within = np.arange(len(points)) - np.repeat(np.cumsum(n) - n, n)
        self.left[np.repeat(short, n), within] = points + 1
        self.right = np.zeros_like(self.left)
        self.right[np.repeat(short, n), within + wide - np.repeat(n, n)] = points + 1
        self.wide = wide

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of pairs of rows whose lengths differ by one at most, those at edit distance one."""
        la, lb = self.length[a], self.length[b]
        long = (la > self.wide) | (lb > self.wide)
        out = np.zeros(len(a), dtype=bool)
        x, y = a[~long], b[~long]
        least = np.minimum(la, lb)[~long]
        head = np.minimum(common(self.left[x] == self.left[y]), least)
        tail = np.minimum(common((self.right[x] == self.right[y])[:, ::-1]), least)
        # Equal lengths: all but one letter agrees; else all of the shorter word.
        need = least - (la == lb)[~long]
        out[~long] = (head + tail >= need) & ((head < least) | (la != lb)[~long])
        out[long] = [one_edit(self.words[i], self.words[j]) for i, j in zip(a[long], b[long], strict=True)]
        return out


def common(equal: np.ndarray) -> np.ndarray:
    """Columns before the first that is not equal."""
    return np.where(equal.all(axis=1), equal.shape[1], equal.argmin(axis=1))


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def near_in_subtree(group: pa.Table, depth: int) -> pa.Table:
    """``word, n_near, best_n, best``: per word of a group its near words there, and the one of largest n (the least of equal ones)."""
    words, n = group["word"].to_pylist(), group["n"].to_numpy()
    rows = np.frombuffer(b"".join(group["vector"].to_pylist()), dtype=np.int8).reshape(len(words), len(GROUPS))
    surplus, deficit = group["surplus"].to_numpy(), group["deficit"].to_numpy()
    own = np.flatnonzero((surplus == 0) & (deficit == 0))
    if not len(own):
        return NEAR.empty_table()
    own = own[np.lexsort(rows[own].T[::-1])]
    spelled = Spelled(words)
    best_first = np.array(sorted(range(len(words)), key=lambda i: (-n[i], words[i])), dtype=np.int64)
    place = np.empty(len(words), dtype=np.int64)
    place[best_first] = np.arange(len(words))
    counts, best = np.zeros(len(words), dtype=np.int64), np.full(len(words), len(words), dtype=np.int64)
    for left, right in search(rows[own], rows, surplus, deficit, depth):
        a, b = left, own[right]
        once = (surplus[a] > 0) | (place[a] < place[b])
        a, b = a[once], b[once]
        ok = spelled.near(a, b)
        for x, y in ((a[ok], b[ok]), (b[ok], a[ok])):
            counts += np.bincount(x, minlength=len(words))
            np.minimum.at(best, x, place[y])
    found = np.flatnonzero(counts)
    top = best_first[best[found]]
    return pa.table([[words[i] for i in found], counts[found], n[top], [words[i] for i in top]], schema=NEAR)


def near_words(words: DataFrame, subtree_words: int = 1 << 15) -> DataFrame:
    """``word, n_near, best_n, best`` for the words of a table (``word, n``; distinct) that have any near word."""
    held = written(with_vectors(words), "spelling-vectors")
    depth = depth_for(held, subtree_words)

    def run(group: pa.Table) -> pa.Table:
        return near_in_subtree(group, depth)

    found = dealt(held, depth).groupBy("path").applyInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("order"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select(
        "word", "n_near", (-F.col("top.order")).alias("best_n"), F.col("top.word").alias("best"))


# ── forms and roots ─────────────────────────────────────────────────────────


def with_roots(forms: DataFrame) -> DataFrame:
    """Adds ``root``: from each word along ``form`` to the last.

    Each round doubles the steps taken and is written; n grows at least by the ratio
    with every step, so the rounds are few.
    """
    at = written(forms.where("form IS NOT NULL").select("word", F.col("form").alias("to")), "spelling-steps")
    while True:
        onward = at.select(F.col("word").alias("to"), F.col("to").alias("next"))
        further = written(at.join(onward, "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "spelling-steps")
        if further.where("moved").isEmpty():
            return forms.join(at.withColumnRenamed("to", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))
        at = further.drop("moved")


def group_variants(words: DataFrame, ratio: int = 5, subtree_words: int = 1 << 15) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a table of distinct words and their counts.

    A word's form is its near word of largest n (of equal ones the least), if that n is
    at least ``ratio`` times the word's own.
    """
    words = written(words, "spelling-words")
    joined = words.join(near_words(words, subtree_words), "word", "left")
    has = F.col("best_n") >= F.col("n") * ratio
    forms = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                  F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "spelling-forms")
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")
