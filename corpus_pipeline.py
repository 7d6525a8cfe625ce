"""The corpus pipeline: stages over ``documents``, each written as Parquet and
read again as the next one's input.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last keep the columns of ``documents``.

Defined results: a null text counts as empty; rows with a null id and repeated
rows are judged as rows of their own and stay or go by their text, but near
duplicates go by id, so rows of a dropped id go together and a row without an
id stays; texts of any length are read whole; other columns pass through to the
last stage, which returns its own; empty documents give an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblens.llm import bpe, decontam, langid, minhash, quality
from weblens.llm.common import read_table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, learned from ``labels``, rejects."""
    return quality.accepted(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a clear language, so those without a letter."""
    return langid.identified(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies
    (five-word shingles, similarity 0.8)."""
    found = minhash.near_duplicates(docs, words=5, percent=80)
    return docs.join(found.where(~F.col("kept")).select("doc_id").distinct(), "doc_id", "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which an item of ``benchmark`` occurs; empty texts stay."""
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (none for an empty text), and the digest of
    what they decode to."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.decode(bpe.encode(docs, path), path).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_filter", quality_filter),
    ("language_filter", language_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: SQL cannot express trained classifiers or BPE; tests/llm holds the stages
#: against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
