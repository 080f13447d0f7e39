"""Fill-in-middle: a text's lines are dealt to prefix, middle and suffix.

The cuts stand after a number of whole units (lines, each with its line end), so
they are found by rank and select over a bit vector of unit ends.  The UTF-8 bytes
of many texts, laid end to end, are viewed as 64-bit words; in each word the bytes
that end a unit get their top bit by plain arithmetic (:func:`equal_bytes`), and
``bitwise_count`` and a running sum give the ends before each word.  A cut after k
units is then a search in that sum for the word and a select inside the word
(:func:`select_in_word`).  Lengths in code points come the same way, from the bytes
that start a code point.

Null text counts as empty and an empty text is ``plain``, as is one that holds a
sentinel.  A null doc_id reads as '' in the dealing, so equal doc_ids are dealt
alike.  A text longer than a batch's bound is a batch of its own.  Repeated rows
give repeated results, an empty table gives none, and other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurwork.llm.common import map_rows

ONES, TOPS, LOWS = (np.uint64(int.from_bytes(bytes([b]) * 8)) for b in (0x01, 0x80, 0x7F))
NEWLINE = 0x0A


@dataclass(frozen=True)
class Rules:
    """How texts are dealt: ``percent`` of them are transformed, ``percent_spm`` of these suffix first."""

    seed: int = 7
    percent: int = 100
    percent_spm: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def sentinels(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def words_of(data: bytes) -> np.ndarray:
    """The bytes as little-endian words, the last filled up with zeros."""
    return np.frombuffer(data + bytes(-len(data) % 8), dtype="<u8")


def equal_bytes(words: np.ndarray, byte: int) -> np.ndarray:
    """The top bit of every byte that equals ``byte``; no carry leaves a byte."""
    x = words ^ (ONES * np.uint64(byte))
    return ~(((x & LOWS) + LOWS) | x) & TOPS


def code_point_starts(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is not a continuation byte (10xxxxxx)."""
    return ~(words & ~(words << np.uint64(1))) & TOPS


def select_in_word(marks: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Index of the byte that holds the r-th mark (from 1) of each word."""
    upto = (marks >> np.uint64(7)) * ONES  # byte i: the marks in bytes 0 to i
    enough = ((upto | TOPS) - r.astype(np.uint64) * ONES) & TOPS
    return 8 - np.bitwise_count(enough).astype(np.int64)


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """The marks in the bytes before each position."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        inside = np.append(self.marks, np.uint64(0))[word] & ((np.uint64(1) << (byte * np.uint64(8))) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The position of the k-th mark (from 1)."""
        word = np.searchsorted(self.before, k, side="left") - 1
        return word * 8 + select_in_word(self.marks[word], k - self.before[word])


def dealt(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers that follow from the seed and the doc_id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4]) for i in (0, 4, 8, 12)]


def transform(ids: list[int | None], texts: list[str | None], rules: Rules) -> list[list]:
    """Per text: number of lines, form, code points of prefix and middle (None if plain), output."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(d) for d in data], dtype=np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    words = words_of(b"".join(data))
    lines, points = Marks(equal_bytes(words, NEWLINE)), Marks(code_point_starts(words))

    first, closed = lines.rank(starts), lines.rank(ends)
    unfinished = np.array([bool(d) and d[-1] != NEWLINE for d in data], dtype=np.int64)
    n = closed - first + unfinished
    h = np.array([dealt(i, rules.seed) for i in ids], dtype=np.int64)
    low, high = np.sort(h[:, :2] % (n + 1)[:, None], axis=1).T

    def cut(after: np.ndarray) -> np.ndarray:
        """The byte behind so many units: a marked one, or the end of the text."""
        out = np.where(after == 0, starts, ends)
        marked = (after > 0) & (after <= closed - first)
        out[marked] = lines.select((first + after)[marked]) + 1
        return out

    one, two = cut(low), cut(high)
    base, at_one, at_two = points.rank(starts), points.rank(one), points.rank(two)
    p, s, m = (x.encode() for x in rules.sentinels)
    held = re.compile(b"|".join(map(re.escape, (p, s, m))))
    forms, prefix_chars, middle_chars, output = [], [], [], []
    for i, text in enumerate(data):
        if not text or h[i, 2] % 100 >= rules.percent or held.search(text):
            form, out = "plain", text
        else:
            a, b = int(one[i] - starts[i]), int(two[i] - starts[i])
            if h[i, 3] % 100 < rules.percent_spm:
                form, out = "spm", b"".join((s, text[b:], p, text[:a], m, text[a:b]))
            else:
                form, out = "psm", b"".join((p, text[:a], s, text[b:], m, text[a:b]))
        plain = form == "plain"
        forms.append(form)
        prefix_chars.append(None if plain else int(at_one[i] - base[i]))
        middle_chars.append(None if plain else int(at_two[i] - at_one[i]))
        output.append(out.decode("utf-8", "surrogatepass"))
    return [n.tolist(), forms, prefix_chars, middle_chars, output]


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                   ("middle_chars", pa.int64()), ("output", pa.string())])


def fill_in_middle(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Every text in its form: ``doc_id, n, form, prefix_chars, middle_chars, output``.  No shuffle."""

    def run(columns: list[list]) -> list[list]:
        return [columns[0], *transform(columns[0], columns[1], rules)]

    return map_rows(docs.select("doc_id", "text"), run, SCHEMA, ARROW)


def restored(output: Column, form: Column, rules: Rules = Rules()) -> Column:
    """The text again, from output and form: a transformed text holds each sentinel once."""
    parts = F.split(output, "|".join("\\Q" + x + "\\E" for x in rules.sentinels), -1)
    a, b, c = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(a, c, b)).when(form == "spm", F.concat(b, c, a)).otherwise(output)


def digests(transformed: DataFrame, rules: Rules = Rules()) -> DataFrame:
    text = restored(F.col("output"), F.col("form"), rules)
    return transformed.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                              F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                              F.sha2(text.cast("binary"), 256).alias("restored_sha256"))
