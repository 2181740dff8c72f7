"""Corpus pipeline over ``documents``: each stage works on all rows its predecessor kept.

Rows without an id pass the dedup stages unchanged and are mixed like others; null and empty texts have no language and go
in the first stage. Repeated rows are dropped by exact dedup, which keeps the largest id of equal texts; an id with several
texts is several documents. Columns beyond those of ``documents`` are carried along. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from winnow.llm import exact_dedup, language, ngram_join
from winnow.llm.bpe import encode_digests
from winnow.llm.mixing import Mix, mixed
from winnow.llm.storage import bounded_batches, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Both levels' closest duels must be near a draw to fall below this.
LEAST_LANGUAGE_SCORE = 0.27
# Near-duplicates: shingles of five words, similarity of at least 0.8.
NEAR = {"k": 5, "num": 4, "den": 5}
# Whole texts that executor and Python worker hold at once.
BATCH_ROWS = 500
# Nine tenths of the tokens; one pass, so that no document comes back after dedup.
MIX = Mix(
    levels=(("domain", "concat('domain', pmod(try_cast(regexp_extract(source, '([0-9]+)$', 1) as int), 4))"), ("language", "lang"), ("origin", "source")),
    weights={"domain": {"domain0": 3, "domain1": 2, "domain2": 2, "domain3": 2}, "language": {"en": 6, "de": 2, "fr": 2, "es": 1}},
    budget_num=9, budget_den=10, max_epochs=1, seed=23,
)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language."""
    bounded_batches(spark, BATCH_ROWS)
    model = language.fit(docs, ~language.held_out())
    return language.accepted(docs, model, LEAST_LANGUAGE_SCORE)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near-duplicate links connect."""
    return ngram_join.keep_one(docs, **NEAR)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target weights of their domains, languages and sources."""
    return mixed(docs, MIX, tie="md5(text)")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes."""
    bounded_batches(spark, BATCH_ROWS)
    return encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

# Language ID, connected components and byte-level BPE are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's rows are written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
