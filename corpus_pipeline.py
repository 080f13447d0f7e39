"""A training corpus from ``documents``: language, near copies, secrets, mix, tokens.

``STAGES`` are applied in order; each reads all that its predecessor has written.

1. ``language``: rows without letters go, and those whose calibrated score is less than a
   third of the way from chance to certainty (under 0.5 for four languages).
2. ``near_copies``: of each class of documents linked at a similarity of 0.8 or
   more on five-word shingles, the one of the least doc_id stays.
3. ``secrets``: every span found is replaced by ``[SECRET]`` and n_chars recounted;
   no row goes.
4. ``mix``: documents are taken by the target weights up to nine tenths of the
   tokens, none more than once.
5. ``tokens``: counts and digests of the token ids; the result of the pipeline.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from recurwork.llm import bpe, langid, mixing, ngram_join, secrets
from recurwork.llm.common import table, written
from recurwork.llm.queries import MIX_SEED, VOCABULARY, WEIGHTS, domain_of_source, share_of_all

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(spark, docs, gain=1 / 3)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, domain_of_source(), WEIGHTS, share_of_all(90), max_epochs=1, seed=MIX_SEED)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(spark, docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN,
                                max_pieces=1 << 16, max_states=1 << 16)  # executors still hold the memory of the joins before


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("secrets", without_secrets),
    ("mix", mix),
    ("tokens", tokens),
]

#: No SQL: the first stage learns a model.  tests/llm holds language, near copies, secrets and tokens
#: against plain versions; mix by its range of words, its operator by its SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
