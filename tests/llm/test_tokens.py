"""BPE and token counts against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weblens.llm import bpe, token_counts
from weblens.llm.pieces import WordTokenizer, read_spec
from weblens.session import scratch_path

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_words_encode_like_whole_texts(path):
    rng = random.Random(5)
    pool = "aB é'sté²½ \n\t<|endoftext|>\x1c\xa0́İΣ日٣😀$%"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    words, whole = WordTokenizer.load(read_spec(path)), Tokenizer.from_file(path)
    for t in texts:
        ids = [i for w in words.encode(words.split(t)) for i in w]
        assert ids == whole.encode(t, add_special_tokens=False).ids, t


def _check_bpe(spark, docs, hot_words):
    lib = Tokenizer.from_file(WORD)
    want = sorted((str(r["doc_id"]), tuple(e := lib.encode(r["text"] or "", add_special_tokens=False).ids),
                   lib.decode(e, skip_special_tokens=False)) for r in docs.collect())
    out = bpe.decode(bpe.encode(docs, WORD, hot_words=hot_words), WORD).collect()
    assert sorted((str(r["doc_id"]), tuple(np.frombuffer(r["ids"], "<u4")), r["decoded"])
                  for r in out) == want


@pytest.mark.parametrize("hot_words", [0, 5, bpe.HOT_WORDS])
def test_bpe_round_trip(spark, odd_docs, hot_words):
    _check_bpe(spark, odd_docs, hot_words)


def test_bpe_on_table_and_empty(spark, no_docs):
    _check_bpe(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), 200)
    assert bpe.encode(no_docs, WORD).count() == 0


def test_token_counts_and_cache(spark, odd_docs, no_docs):
    lib, cache = Tokenizer.from_file(BYTE), scratch_path(spark, "counts")
    want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()),
                   len(lib.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd_docs.collect())
    for _ in range(2):  # the second run finds every digest in the cache
        got = token_counts.count(odd_docs, BYTE, cache).collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
        stored = spark.read.parquet(cache)
        assert stored.count() == stored.select("content_digest").distinct().count()
        assert stored.count() == odd_docs.fillna("", ["text"]).select("text").distinct().count()
    assert token_counts.count(no_docs, BYTE, cache).count() == 0


def test_rows_without_ids_whose_short_hashes_collide(spark):
    words = spark.range(200_000).select(F.concat(F.lit("qz"), F.md5(F.col("id").cast("string"))).alias("text"))
    twins = (words.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("t"))
             .where(F.size("t") > 1).first()["t"])
    docs = spark.createDataFrame([(None, t) for t in twins], "doc_id long, text string")
    _check_bpe(spark, docs, 0)


def test_words_of_letters_are_not_split():
    import pyarrow as pa

    class Tok:
        def pieces_of_lines(self, lines):
            self.lines = lines
            return [p for p in re.split(r"([a-z]+|\W)", lines) if p]

    import re
    tok = Tok()
    pieces, size = bpe._split_joined(tok, pa.array(["ab", "c,", "é", "", "d.e", "f"]))
    assert tok.lines == "c,\n\nd.e"
    assert pieces.to_pylist() == ["ab", "c", ",", "é", "d", ".", "e", "f"] and size.tolist() == [1, 2, 1, 0, 3, 1]


def test_bpe_limits_what_workers_hold(spark):
    docs = spark.range(0, 3000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text")
    bpe.encode(docs, WORD)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])
    # 15 MB of texts in one task, in 3,000 rows, were one batch
    assert max(r["n"] for r in docs.mapInArrow(sizes, "n long").collect()) < 2 * bpe.BATCH_BYTES
    # the tokenizer that only cuts texts has no vocabulary
    assert WordTokenizer(read_spec(WORD))._whole.get_vocab_size() == 0


def test_bpe_keeps_the_sessions_own_batch_limit(spark):
    before = spark.conf.get(bpe.BATCH_CONF, None)
    try:
        spark.conf.set(bpe.BATCH_CONF, "1000000")
        bpe.encode(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), WORD)
        assert spark.conf.get(bpe.BATCH_CONF) == "1000000"
    finally:
        spark.conf.unset(bpe.BATCH_CONF) if before is None else spark.conf.set(bpe.BATCH_CONF, before)


def test_bpe_tasks_read_their_tables_without_a_copy():
    """The frequent words and the vocabulary were Python objects of every worker."""
    import tracemalloc

    class Broadcast:
        value = bpe._packed(pa.table({"word": [f"w{i}" for i in range(1 << 17)],
                                      "ids": pa.array([b"\1\0\0\0"] * (1 << 17), pa.binary())}))

    class Vocabulary:
        value = bpe._packed(bpe._pieces_by_id(read_spec(WORD)))
    tracemalloc.start()
    words, pool = bpe._column(Broadcast, "word"), bpe._ids_of_code(bpe._column(Broadcast, "ids"))[0]
    codes = bpe._code_of_word(words, pa.array(["w0", "none", "w131071"]))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([np.array([5, 9], "<u4").tobytes()])], ["doc_id", "ids"])
    assert next(bpe._decode(Vocabulary)([batch])).num_rows == 1
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert codes.tolist() == [1, 0, 1 << 17] and len(pool) == 1 << 17 and (pool == 1).all()
    assert most < 6_000_000  # numpy's starts and sizes; the words as a dict's keys take more
