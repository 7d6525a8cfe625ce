"""One query per operator of this package, over its whole table, with the
parameters it would run with in production. Each derives its digest columns
from the operator's own output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (ann, bpe, collocations, decontam, html_extract, langid, minhash, mixing, oracle,
               prefix_trie, quality, sharding, token_counts, url_filter)
from .common import read_table, remove_on_exit


def op1_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode(read_table(spark, sf_dir, "documents"), path)
    return bpe.decode(encoded, path).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op2_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(read_table(spark, sf_dir, "documents"),
                            read_table(spark, sf_dir, "benchmark"))


def op4_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = scratch_path(spark, "token-count-cache")
    remove_on_exit(spark, cache)
    counts = token_counts.count(read_table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_50k.json"), cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op9_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), k=10, every=100)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=2)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    def rebuild(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
        heads = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(6))
        return prefix_trie.with_shared_heads(turns, convs, heads, F.col("conv_id") - F.col("conv_id") % 100, 5)
    return prefix_trie.conversation_trie(read_table(spark, sf_dir, "conversations"), rebuild).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_bpe_roundtrip, op2_balanced_shards, op3_benchmark_leaks, op4_url_verdicts,
        op5_token_counts, op6_main_text, op7_language, op8_quality, op9_nearest_vectors, op10_near_duplicates,
        op11_prefix_trie, op12_source_mix, op13_collocations)
}

#: DuckDB SQL of those that SQL can express; the others have brute-force tests.
ORACLE_SQL: dict[str, str] = {"op11_prefix_trie": oracle.PREFIX_TRIE, "op13_collocations": oracle.COLLOCATIONS}
