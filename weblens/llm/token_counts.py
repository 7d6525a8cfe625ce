"""Token counts through a digest cache.

A cache table holds (content_digest, tokenizer_digest, n_tokens), where the
content digest is the SHA-256 of the normalised content (null becomes the
empty text; nothing else may change, as a byte-level tokenizer sees every
character) and the tokenizer digest that of the tokenizer's JSON. ``count``

1. joins the documents' digests to the cache by an anti-join,
2. keeps one text per missing digest (reduced in the map tasks, so that copies
   are not shuffled), encodes these, and appends their counts to the cache,
3. joins every document to the cache.

A task encodes each distinct word once and adds up. Copies, however many,
meet only in a partial aggregate and in a join that AQE can split.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows
each keep a row; other columns are ignored; an empty table gives an empty one.
The cache may be shared by tokenizers and by corpora. Two jobs that append the
same misses at once leave equal rows, of which a reader takes one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, path_exists
from .pieces import WordTokenizer, read_spec

CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens long"
#: Distinct words whose counts a worker process remembers between its tasks.
REMEMBERED_WORDS = 1_000_000
_known: dict[str, dict[str, int]] = {}


def read_cache(spark, path: str, tokenizer_digest: str) -> DataFrame:
    """(content_digest, n_tokens) of one tokenizer; a digest has one row."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "content_digest binary, n_tokens long")
    return (spark.read.schema(CACHE_SCHEMA).parquet(path)
            .where(F.col("tokenizer_digest") == tokenizer_digest)
            .groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens")))


def _count_tokens(spec):
    def run(batches):
        tok = WordTokenizer.load(spec.value)
        known = _known.setdefault(tok.digest, {})
        for batch in batches:
            counts = []
            for text in batch.column("text").to_pylist():
                words = tok.split(text)
                # looked up one by one: a set less a dict's keys walks all the keys
                if new := [w for w in set(words) if w not in known]:
                    known.update(zip(new, map(len, tok.encode(new))))
                counts.append(sum(map(known.__getitem__, words)))
                if len(known) > REMEMBERED_WORDS:
                    known.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column("content_digest"), pa.array(counts, pa.int64())],
                ["content_digest", "n_tokens"])
    return run


def count(docs: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per row; encodes what ``cache_path`` lacks
    and appends it there."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("content_digest"))
    raw = read_spec(tokenizer_path)
    tokenizer_digest = WordTokenizer.load(raw).digest
    spec = spark.sparkContext.broadcast(raw)
    misses = (base.join(read_cache(spark, cache_path, tokenizer_digest), "content_digest",
                        "left_anti")
              .groupBy("content_digest").agg(F.first("text").alias("text")))
    (map_arrow(misses, _count_tokens(spec), "content_digest binary, n_tokens long")
     .select("content_digest", F.lit(tokenizer_digest).alias("tokenizer_digest"), "n_tokens")
     .write.mode("append").parquet(cache_path))
    return (base.select("doc_id", "n_bytes", "content_digest")
            .join(read_cache(spark, cache_path, tokenizer_digest), "content_digest")
            .select("doc_id", "n_bytes", "n_tokens"))
