"""Language identification: sparse multinomial logistic regression on TF-IDF of
character n-grams, trained with follow-the-regularised-leader and elastic-net
penalties, calibrated by a temperature.

Text is put in lower case; what is no letter becomes a space, and spaces in a row
one.  N-grams of 1 to ``ORDERS`` characters are hashed to ``BUCKETS``; a document
is the vector of its n-gram counts times the inverse document frequencies, of
length one.  The frequencies are counted over all learnable documents.  The
classifier is fitted on at most ``sample_rows`` of them, about as many per
language, chosen by a hash of doc_id (the bound is a parameter; what reaches the
driver is at most BUCKETS numbers per sampled row); a fifth of the sample is kept
back to fit the temperature.

Learnable are documents that are not held out, with a lang and at least one
letter.  A text without letters, empty or null, is ``und`` with score 0, and so is
every text if nothing can be learned.  Ties of the score go to the language that
sorts first.  A null doc_id counts as an empty string in the hold-out rule;
repeated rows are predicted as they come; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recurwork.llm.common import code_points, map_rows, mix64, slices

BUCKETS, ORDERS = 1 << 15, 3
#: Code points that are taken at a time.
RUN = 1 << 18
BASE = np.uint32(0x9E3779B1)
SHIFT = np.uint32(32 - 15)
UNKNOWN = "und"

# The hold-out rule.
FOLDS, HELD_OUT = 4, 2


def tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, and a hash of its lower case (of the space, if it is none)."""
    letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    lower = np.fromiter((ord(chr(i).lower()[0]) for i in range(0x110000)), np.uint64, 0x110000)
    return letters, (mix64(np.where(letters, lower, np.uint64(32))) >> np.uint64(32)).astype(np.uint32)


def grams(text: str, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """Counts of the hashed n-grams of a text, and its letters."""
    letters, hashes = tables
    counts, n_letters = np.zeros(BUCKETS, np.int64), 0
    for at in range(0, len(text), RUN):
        points = code_points(text[at:at + RUN + ORDERS - 1])
        own = letters[points]
        n_letters += int(np.count_nonzero(own[:RUN]))
        stays = own.copy()
        stays[0] = True
        stays[1:] |= own[:-1]
        starts = int(np.count_nonzero(stays[:RUN]))
        codes = hashes[points[stays]]
        rolled = np.zeros(len(codes), np.uint32)
        for n in range(1, ORDERS + 1):
            if len(codes) < n:
                break
            rolled = rolled[:len(codes) - n + 1] * BASE + codes[n - 1:]
            counts += np.bincount(((rolled[:starts] ^ (rolled[:starts] >> np.uint32(15))) * BASE) >> SHIFT, minlength=BUCKETS)
    return counts, n_letters


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = counts * idf
    n = np.sqrt(x @ x)
    return x / n if n else x


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == HELD_OUT


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # BUCKETS x langs
    bias: np.ndarray
    temperature: float

    def predict(self, counts: np.ndarray) -> tuple[str, float]:
        p = softmax((vector(counts, self.idf) @ self.weights + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], n_langs: int, epochs: int = 4, alpha: float = 2.0, beta: float = 0.1,
        l1: float = 2e-3, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over (buckets, values, language); the last coordinate is the bias, which is not penalised."""
    z, n = np.zeros((BUCKETS + 1, n_langs)), np.zeros((BUCKETS + 1, n_langs))

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return -np.sign(zs) * np.maximum(np.abs(zs) - l1, 0) / ((beta + np.sqrt(ns)) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, lang = rows[i]
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)[:, None]
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            w[-1] = -zs[-1] / ((beta + np.sqrt(ns[-1])) / alpha)
            p = softmax((x * w).sum(axis=0))
            p[lang] -= 1
            g = x * p
            grown = ns + g * g
            z[at] = zs + g - (np.sqrt(grown) - np.sqrt(ns)) / alpha * w
            n[at] = grown
    w = weights(z, n)
    return w[:-1], -z[-1] / ((beta + np.sqrt(n[-1])) / alpha)


def best_temperature(logits: np.ndarray, langs: np.ndarray) -> float:
    """The temperature of least cross-entropy, by golden section over its logarithm."""
    if not len(langs):
        return 1.0

    def loss(t: float) -> float:
        return float(-np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(langs)), langs], 1e-300)).mean())

    a, b, r = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def learn(spark: SparkSession, docs: DataFrame, sample_rows: int = 3000) -> Model | None:
    """A model from the learnable documents; None if there are none."""
    shared = spark.sparkContext.broadcast(tables())
    known = docs.where(~held_out() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, langs = np.zeros(BUCKETS, np.int64), {}
        for batch in batches:
            for part in slices(batch):
                for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    counts, n_letters = grams(text or "", shared.value)
                    if n_letters:
                        seen += counts > 0
                        langs[lang] = langs.get(lang, 0) + 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None] * len(at) + list(langs), pa.string()), pa.array([*at.tolist(), *[None] * len(langs)], pa.int32()),
             pa.array([*seen[at].tolist(), *langs.values()], pa.int64())], names=["lang", "bucket", "n"])

    # At most BUCKETS rows and one per language.
    found = known.select("text", "lang").mapInArrow(frequencies, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    by_lang = {r.lang: r.n for r in found if r.lang is not None}
    if not by_lang:
        return None
    langs = sorted(by_lang)
    idf = np.full(BUCKETS, np.log(1 + sum(by_lang.values())) + 1)
    for r in found:
        if r.bucket is not None:
            idf[r.bucket] = np.log((1 + sum(by_lang.values())) / (1 + r.n)) + 1

    share = max(1, sample_rows // len(langs))
    within = F.lit(False)
    for lang in langs:
        bound = min(1.0, share / by_lang[lang])
        within |= (F.col("lang") == lang) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(bound * (1 << 40)))

    def sampled(columns: list[list]) -> list[list]:
        out: list[list] = [[], [], [], []]
        for doc_id, text, lang in zip(*columns, strict=True):
            counts, n_letters = grams(text or "", shared.value)
            if n_letters:
                at = np.flatnonzero(counts)
                for column, value in zip(out, (doc_id, lang, at.astype("<i4").tobytes(), vector(counts, idf)[at].astype("<f4").tobytes()), strict=True):
                    column.append(value)
        return out

    arrow = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("at", pa.binary()), ("x", pa.binary())])
    rows = map_rows(known.where(within), sampled, "doc_id long, lang string, at binary, x binary", arrow).limit(2 * sample_rows).collect()
    rows = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id, r.lang, bytes(r.at)))
    vectors = [(np.frombuffer(r.at, "<i4"), np.frombuffer(r.x, "<f4").astype(float), langs.index(r.lang)) for r in rows]
    kept = [v for i, v in enumerate(vectors) if i % 5 == 0]
    weights, bias = fit([v for i, v in enumerate(vectors) if i % 5], len(langs))
    logits = np.array([x @ weights[at] + bias for at, x, _ in kept]).reshape(-1, len(langs))
    return Model(langs, idf, weights, bias, best_temperature(logits, np.array([lang for *_, lang in kept], dtype=int)))


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predictor(spark: SparkSession, model: Model | None):
    """A function from a text to its language and score, for use in tasks; the model is broadcast (BUCKETS numbers per language, and two tables of the code points)."""
    shared = spark.sparkContext.broadcast((tables(), model))

    def predict(text: str | None) -> tuple[str, float]:
        known, own = shared.value
        counts, n_letters = grams(text or "", known)
        return own.predict(counts) if own is not None and n_letters else (UNKNOWN, 0.0)

    return predict


def identify(spark: SparkSession, docs: DataFrame, sample_rows: int = 3000) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per document."""
    predict = predictor(spark, learn(spark, docs, sample_rows))

    def run(columns: list[list]) -> list[list]:
        found = [predict(t) for t in columns[2]]
        return [columns[0], columns[1], [f[0] for f in found], [f[1] for f in found]]

    return map_rows(docs.select("doc_id", held_out().alias("held_out"), "text"), run, SCHEMA, ARROW)


def least_score(n_langs: int, gain: float) -> float:
    """The score that lies ``gain`` of the way from chance, one in ``n_langs``, to certainty."""
    return 1 - (1 - gain) * (1 - 1 / max(1, n_langs))


def keep_identified(spark: SparkSession, docs: DataFrame, gain: float = 1 / 3, sample_rows: int = 3000) -> DataFrame:
    """``docs`` without the rows whose language cannot be told: no letters, or a score under ``least_score``."""
    model = learn(spark, docs, sample_rows)
    least = least_score(len(model.langs) if model else 1, gain)
    predict = predictor(spark, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [predict(t) for t in part.column("text").to_pylist()]
                yield part.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
