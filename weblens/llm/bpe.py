"""BPE encoding and decoding through a table of distinct words.

``encode``: texts are split into words by Spark tasks, each distinct word is
encoded once (the word table, written to the shared folder), and the ids come
back to the words' positions:

* The most frequent words, ``HOT_WORDS`` of at most ``HOT_WORD_BYTES`` bytes
  each, go to every task as one broadcast table, so that no frequent word is
  a join key. Its size has that bound, whatever the corpus.
* Every other word joins the word table by a shuffle on the word, and returns
  to its document by a shuffle on the document, one row per occurrence. These
  ids are written to the shared folder, a row a document, and joined with the
  codes of the frequent words.

``decode`` looks each id up in the id-to-piece table (a map-side join: the
table is the fixed vocabulary) and joins a document's pieces as the tokenizer
without a decoder does, by one space.

Defined results: a null or empty text has no ids and decodes to the empty
text; rows with equal or null ``doc_id`` each keep their own row; other
columns of the input are ignored, whatever their names; an empty table gives
an empty table. Ids outside the vocabulary are skipped in decoding, as by the
library. Whole texts are used, whatever their length.

``encode`` and ``decode`` limit the session's Arrow batches to ``BATCH_BYTES``
where the session sets no limit of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, written
from .pieces import WordTokenizer, read_spec

HOT_WORDS = 1 << 18
HOT_WORD_BYTES = 48
#: Characters of texts that a task splits at once (one document at least).
SLICE_CHARS = 1_250_000
#: Words that are put together, and tokens that are decoded, at once (one
#: document at least).
SLICE_TOKENS = 250_000
#: Bytes of a batch between the JVM and a Python worker (one document at least).
#: Both hold it whole, and Spark's own limit is 10,000 rows, however long.
BATCH_BYTES = 2_500_000
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

_ID = np.dtype("<u4")
#: A document's row: its id, which may be null or not its own, and 128 bits of its text.
KEYS = ["doc_id", "key_a", "key_b"]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("key_a"), F.xxhash64(F.lit(1), text).alias("key_b"))


def _small_batches(spark: SparkSession) -> None:
    """Batches of ``BATCH_BYTES`` in this session, unless it has a limit of its
    own. It stays set: the caller runs the plans that are returned."""
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, BATCH_BYTES)


def _slices(batches):
    """The rows of a task in slices of about ``SLICE_CHARS`` characters."""
    for batch in batches:
        chars = pc.utf8_length(batch.column("text")).to_numpy(zero_copy_only=False)
        part = np.cumsum(chars) // SLICE_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


class _Occurrences:
    """The pieces of some texts: the distinct ``pieces``, ``at`` the index
    there of every occurrence in the order of the texts, and ``ends`` the
    number of occurrences up to the end of each text."""

    def __init__(self, tok, texts: list[str]):
        fast = [tok.lowered(t) for t in texts]
        slow = [tok.split(t) for t, f in zip(texts, fast) if f is None]
        lists = pc.ascii_split_whitespace(pa.array([f for f in fast if f is not None], pa.string()))
        if slow:
            is_slow = np.array([f is None for f in fast])
            order = np.empty(len(texts), np.int64)
            order[~is_slow] = np.arange(len(lists))
            order[is_slow] = np.arange(len(lists), len(texts))
            lists = pa.concat_arrays([lists, pa.array(slow, pa.list_(pa.string()))]).take(pa.array(order))
        words = lists.flatten().dictionary_encode()
        pieces, size = (_split_each if slow else _split_joined)(tok, words.dictionary)
        pieces = pieces.dictionary_encode()
        self.pieces = pieces.dictionary
        start = np.cumsum(size) - size
        word_of = words.indices.to_numpy()
        sizes = size[word_of]
        before = np.cumsum(sizes) - sizes
        piece_at = np.repeat(start[word_of] - before, sizes) + np.arange(sizes.sum())
        self.at = pieces.indices.to_numpy()[piece_at]
        text_ends = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        self.ends = np.concatenate([[0], np.cumsum(sizes)])[text_ends]


def _split_each(tok, words):
    """(pieces of the words one after another, how many each word has)."""
    found = [tok.pieces(w) if w else [] for w in words.to_pylist()]
    return (pa.array([p for ps in found for p in ps], pa.string()),
            np.fromiter(map(len, found), np.int64, len(found)))


def _split_joined(tok, words):
    """The same for words of fast texts: a word of letters is one piece, the
    others are split by one pass over all of them."""
    is_one = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
    others = words.filter(pa.array(~is_one))
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(others)], pa.int32()), others), "\n")
    flat = pa.array(tok.pieces_of_lines(lines[0].as_py()), pa.string())
    is_end = pc.equal(flat, "\n")
    ends = np.flatnonzero(is_end.to_numpy(zero_copy_only=False))
    # words are one more than line ends; each line end is an element itself
    bounds = np.concatenate([[-1], ends, [len(flat)]])
    size = np.ones(len(words), np.int64)
    size[~is_one] = (np.diff(bounds) - 1)[:len(others)]
    # the words of letters and the pieces of the others, as the words follow
    of_one = np.repeat(is_one, size)
    source = np.empty(len(of_one), np.int64)
    source[of_one] = np.flatnonzero(is_one)
    source[~of_one] = len(words) + np.flatnonzero(~is_end.to_numpy(zero_copy_only=False))
    return pa.concat_arrays([words, flat]).take(pa.array(source)), size


def _count_words(spec):
    def run(batches):
        tok = WordTokenizer.load(spec.value)
        for batch in _slices(batches):
            seen = _Occurrences(tok, batch.column("text").to_pylist())
            n = np.bincount(seen.at, minlength=len(seen.pieces)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([seen.pieces, pa.array(n)], ["word", "n"])
    return run


def _encode_words(spec):
    def run(batches):
        tok = WordTokenizer.load(spec.value)
        for batch in batches:
            ids = [np.asarray(i, _ID).tobytes() for i in
                   tok.encode(batch.column("word").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(ids, pa.binary())],
                ["word", "n", "ids"])
    return run


def word_table(texts: DataFrame, spec) -> DataFrame:
    """(word, n, ids): each distinct word of ``texts``, its count over the
    whole corpus and its ids as little-endian unsigned 32-bit integers."""
    counts = (map_arrow(texts.select("text"), _count_words(spec), "word string, n long")
              .groupBy("word").agg(F.sum("n").alias("n")))
    return written(map_arrow(counts, _encode_words(spec), "word string, n long, ids binary"),
                   "bpe-words", let_go=True)


def _hot_limit(words: DataFrame, most: int) -> int:
    """The smallest count at which at most ``most`` words are as frequent.
    Counts from 1024 on are binned by powers of two, so few rows return."""
    binned = F.when(F.col("n") < 1024, F.col("n")).otherwise(
        F.pow(F.lit(2.0), F.floor(F.log2(F.col("n").cast("double")))).cast("long"))
    rows = (words.where(F.octet_length("word") <= HOT_WORD_BYTES)
            .groupBy(binned.alias("bin")).agg(F.count(F.lit(1)).alias("words")).collect())
    limit, total = 1 << 62, 0
    for r in sorted(rows, key=lambda r: -r["bin"]):
        total += r["words"]
        if total > most:
            break
        limit = r["bin"]
    return limit


def _packed(table: pa.Table) -> bytes:
    """A small table for a broadcast, which workers read without a copy."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _column(packed, name: str) -> pa.Array:
    """A column of a broadcast table, as it lies there."""
    column = pa.ipc.open_stream(packed.value).read_all().column(name)
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def _code_of_word(words: pa.Array, pieces: pa.Array) -> np.ndarray:
    """Codes from 1; code 0 stands for a word outside the table."""
    return (pc.fill_null(pc.index_in(pieces, value_set=words), -1).to_numpy() + 1).astype(_ID)


def _ids_of_code(ids: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids one after another, where those of each code start, how many)."""
    size = np.concatenate([[0], pc.binary_length(ids).to_numpy().astype(np.int64) // 4])
    pool = np.zeros(0, _ID)
    if len(ids):
        first, n = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset], int(size.sum())
        pool = np.frombuffer(ids.buffers()[2], _ID, n, int(first)) if n else pool
    return pool, np.cumsum(size) - size, size


def _codes(tok, words: pa.Array, texts: list[str]):
    """(occurrences, code of each occurrence; 0 outside the hot table)."""
    seen = _Occurrences(tok, texts)
    return seen, _code_of_word(words, seen.pieces)[seen.at]


def _hot_codes(hot, spec):
    """(doc_id, key_a, key_b, codes): per document the code of each position, the
    byte planes one after another and compressed."""
    def run(batches):
        tok, words_of = WordTokenizer.load(spec.value), _column(hot, "word")
        tok.drop_encoder()
        pack = zstandard.ZstdCompressor(level=3, write_content_size=True)
        for batch in _slices(batches):
            seen, codes = _codes(tok, words_of, batch.column("text").to_pylist())
            out = []
            for a, b in zip([0, *seen.ends.tolist()], seen.ends.tolist()):
                planes = codes[a:b].view(np.uint8).reshape(-1, 4)[:, :3].T
                out.append(pack.compress(planes.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in KEYS), pa.array(out, pa.binary())], [*KEYS, "codes"])
    return run


def _rare_words(hot, spec):
    """(doc_id, key_a, key_b, nth, word): the words outside the hot table, each
    with its place among those of its document."""
    def run(batches):
        tok, words_of = WordTokenizer.load(spec.value), _column(hot, "word")
        tok.drop_encoder()
        for batch in _slices(batches):
            seen, codes = _codes(tok, words_of, batch.column("text").to_pylist())
            rare = np.flatnonzero(codes == 0)
            text = np.searchsorted(seen.ends, rare, side="right")
            nth = np.arange(len(rare)) - np.searchsorted(text, text)
            words = seen.pieces.take(pa.array(seen.at[rare]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(text)) for c in KEYS),
                 pa.array(nth.astype(np.int32)), words], [*KEYS, "nth", "word"])
    return run


def _assemble(hot):
    def together(table, batch: pa.RecordBatch, codes: list[np.ndarray]) -> pa.RecordBatch:
        pool, start, size = table
        of_doc = np.cumsum([len(c) for c in codes])
        codes = np.concatenate(codes).astype(np.int64)
        rare = batch.column("rare")
        values = rare.flatten()
        doc = np.repeat(np.arange(len(rare)), np.diff(rare.offsets.to_numpy()))
        order = np.lexsort((values.field("nth").to_numpy(), doc))  # as their places follow
        ids = values.field("ids").take(pa.array(order)).to_pylist()
        rare_size = np.fromiter((len(i) // 4 for i in ids), np.int64, len(ids))
        places = np.flatnonzero(codes == 0)
        n, at = size[codes], start[codes]
        n[places] = rare_size
        at[places] = len(pool) + np.cumsum(rare_size) - rare_size
        all_ids = np.concatenate([pool, np.frombuffer(b"".join(ids), _ID)])
        ends = np.cumsum(n)
        source = np.repeat(at - (ends - n), n)
        source += np.arange(len(source))
        tokens = all_ids[source]
        cuts = np.concatenate([[0], ends])[of_doc].tolist()
        out = [tokens[a:b].tobytes() for a, b in zip([0, *cuts], cuts)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "ids"])

    def run(batches):
        unpack, table = zstandard.ZstdDecompressor(), _ids_of_code(_column(hot, "ids"))
        for batch in batches:
            start, held, size = 0, [], 0
            for i, packed in enumerate(batch.column("codes").to_pylist()):
                planes = np.frombuffer(unpack.decompress(packed), np.uint8).reshape(3, -1).astype(_ID)
                held.append(planes[0] | planes[1] << 8 | planes[2] << 16)
                size += len(held[-1])
                if size > SLICE_TOKENS:
                    yield together(table, batch.slice(start, i + 1 - start), held)
                    start, held, size = i + 1, [], 0
            if held:
                yield together(table, batch.slice(start), held)
    return run


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           hot_words: int = HOT_WORDS) -> DataFrame:
    """(doc_id, ids binary) per row of ``docs``: the ids of the whole text as
    little-endian unsigned 32-bit integers, as the tokenizers library gives
    them with ``add_special_tokens=False``."""
    spark = docs.sparkSession
    _small_batches(spark)
    texts = _texts(docs, id_col, text_col)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    spec = spark.sparkContext.broadcast(read_spec(tokenizer_path))
    words = word_table(texts, spec)
    is_hot = ((F.octet_length("word") <= HOT_WORD_BYTES)
              & (F.col("n") >= _hot_limit(words, hot_words)))
    # at most hot_words rows of at most HOT_WORD_BYTES bytes: a proven bound
    table = words.where(is_hot).orderBy(F.desc("n"), "word").select("word", "ids").toArrow()
    hot = spark.sparkContext.broadcast(_packed(table))

    schema = f"doc_id {id_type}, key_a long, key_b long"
    rare = map_arrow(texts, _rare_words(hot, spec), f"{schema}, nth int, word string")
    found = (rare.join(words.where(~is_hot).select("word", "ids"), "word")
             .groupBy(*KEYS).agg(F.collect_set(F.struct("nth", "ids")).alias("rare")))
    # written before the codes are made, so the occurrences' two shuffles and
    # the codes' are not on disk together
    found = written(found, "bpe-rare", let_go=True)
    codes = map_arrow(texts, _hot_codes(hot, spec), f"{schema}, codes binary")
    both = codes.alias("c").join(
        found.alias("r"), F.col("c.doc_id").eqNullSafe(F.col("r.doc_id"))
        & (F.col("c.key_a") == F.col("r.key_a")) & (F.col("c.key_b") == F.col("r.key_b")), "left")
    return map_arrow(both.select("c.doc_id", "codes", "rare"), _assemble(hot),
                     f"doc_id {id_type}, ids binary")


def _pieces_by_id(spec: str) -> pa.Table:
    """The id-to-piece table: a row an id, null where the vocabulary has none."""
    vocab = WordTokenizer.load(spec).id_to_piece()
    pieces = [vocab.get(i) for i in range(max(vocab, default=-1) + 1)]
    return pa.table({"piece": pa.array(pieces, pa.string())})


def _decode(table):
    def run(batches):
        pieces = _column(table, "piece")
        size = len(pieces)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            part = [np.frombuffer(i or b"", _ID) for i in ids]
            part = [i[i < size] if len(i) and i.max() >= size else i for i in part]
            start = 0
            while start < len(part):  # in slices, so that no string array passes 2 GB
                end, tokens = start + 1, len(part[start])
                while end < len(part) and tokens + len(part[end]) <= SLICE_TOKENS:
                    tokens += len(part[end])
                    end += 1
                rows = part[start:end]
                ends = pa.array(np.cumsum([0, *map(len, rows)]), pa.int32())
                flat = pieces.take(pa.array(np.concatenate(rows).astype(np.int64)))
                texts = pc.binary_join(pa.ListArray.from_arrays(ends, flat), " ")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[start:end], batch.column("ids")[start:end], texts],
                    ["doc_id", "ids", "decoded"])
                start = end
    return run


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """Adds ``decoded``: the pieces of the ids, special tokens included, as
    the library's ``decode(ids, skip_special_tokens=False)`` joins them for a
    tokenizer whose JSON has no decoder."""
    _small_batches(encoded.sparkSession)
    table = encoded.sparkSession.sparkContext.broadcast(_packed(_pieces_by_id(read_spec(tokenizer_path))))
    id_type = encoded.schema["doc_id"].dataType.simpleString()
    return map_arrow(encoded.select("doc_id", "ids"), _decode(table),
                     f"doc_id {id_type}, ids binary, decoded string")
