"""Phrase collocations by vertically partitioned, depth-truncated suffix trees.

Every position of a text is a suffix, cut at the end of its piece and after
``DEPTH`` words. Building one tree of all of them in one place needs as much memory as
the corpus, so the tree is cut by prefixes:

1. words are counted; those below the least count can be in no candidate;
2. phrases of two and three, then four and five frequent words are counted by
   hash buckets; a bucket below the least count holds no candidate. Prefixes
   of two words in the other buckets are counted exactly. Those that reach the
   least count are the units: they are dealt by a hash over as many groups as the memory budget asks
   for; a unit whose subtree alone is above the budget is extended by a word, and
   its extensions are units (again up to ``DEPTH``);
3. each task cuts its texts into suffixes once more and sends those of a unit to its group,
   equal ones added up before. A suffix ends before the first phrase whose bucket is
   below the least count, as no candidate goes on there;
4. a group reads its suffixes in order, which is the depth-first order of its
   subtrees: leaves carry their totals, an inner node's count is the sum of the leaves
   below, and the path of open nodes is all that is held. No group needs another.

Scores are joins of the candidates' parts with the counts, in 128-bit decimals;
ranks come from a range-partitioned sort.

Scale: what tasks know of the frequent words and phrases are bit filters of at
most ``MOST_BITS`` bits each (false positives cost rows, not results), and the
extended units, at most all suffixes / budget. Tables of a task are emptied at a fixed size, texts are
read in slices, so neither a long text nor a hot word needs more memory.

Defined results: a null or empty text has no words; a null lang counts as ``und``;
repeated rows count again; a text of any length counts whole; equal scores and
counts go by the phrase; ids and other columns are not read; an empty table, or one without a
frequent pair, gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, numbered, shuffle_partitions, written

DEPTH = 5
LEAST, TOP = 100, 2000
#: Suffixes that a group may hold.
MEMORY = 1 << 20
#: Bytes of text that are cut into words at once; entries of a task's tables.
SLICE, ENTRIES = 1 << 21, 1 << 19
#: Bits of the filters: eight for each entry, between these bounds.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27

#: Inside the tables the words of a phrase are joined by tabs, which no word
#: holds. Control characters below the tab, which would sort before it, are
#: written as capital letters, which no lower-cased word holds either.
SEP, STOP = b"\t", b"."
_LOW, _HIGH = bytes(range(9)), b"ABCDEFGHI"
_SPLIT = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t" + _LOW, b"\n" * 10 + b" " + _HIGH)
_MORE = re.compile(rb"(?: *[^ \n]+){0,%d}" % (DEPTH - 1))
_EDGE = re.compile(rb"[ \n]")


def _token_slices(texts: Iterator[str]) -> Iterator[tuple[list[bytes], int]]:
    """Words of the texts, with ``STOP`` after each piece, and how many of them
    belong to the slice; the others are the following words of its last piece."""
    def cut(blob: bytes) -> Iterator[tuple[list[bytes], int]]:
        blob, start = blob.lower().translate(_SPLIT), 0
        while start < len(blob):
            end = start + SLICE
            edge = _EDGE.search(blob, end) if end < len(blob) else None
            end = edge.start() if edge else len(blob)
            words = blob[start:end].replace(b"\n", b" . ").split()
            own = len(words)
            words += _MORE.match(blob, end).group().split()
            yield words, own
            start = end

    held, size = [], 0
    for t in texts:
        data = t.encode()
        if size + len(data) > SLICE and held:
            yield from cut(b"\n".join(held))
            held, size = [], 0
        held.append(data)
        size += len(data) + 1
    if held:
        yield from cut(b"\n".join(held))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], int]]:
    """(lang, words, own) of every slice; languages of a batch one by one."""
    for b in batches:
        by_lang: dict[str, list[int]] = {}
        for i, lang in enumerate(b.column("lang").to_pylist()):
            by_lang.setdefault(lang, []).append(i)
        texts = b.column("text")
        for lang, at in by_lang.items():
            for words, own in _token_slices(texts[i].as_py() for i in at):
                yield lang, words, own


def _batch(langs: list[str], phrases: list[bytes], counts, extra=None) -> pa.RecordBatch:
    arrays = [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()),
              pa.array(counts, pa.int64())]
    names = ["lang", "phrase", "f"]
    if extra is not None:
        arrays.append(pa.array(extra, pa.int8()))
        names.append("unit")
    return pa.RecordBatch.from_arrays(arrays, names)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def emptied() -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            c.pop(STOP, None)
            if c:
                yield _batch([lang] * len(c), list(c), list(c.values()))
        counts.clear()

    for lang, words, own in _slices(batches):
        counts.setdefault(lang, Counter()).update(words[:own])
        if sum(map(len, counts.values())) > ENTRIES:
            yield from emptied()
    yield from emptied()


def _power(wanted: int, least: int, most: int) -> int:
    """The power of two of ``wanted`` or more, within two others."""
    return min(max(1 << max(0, wanted - 1).bit_length(), least), most)


class Filter:
    """A set of (lang, phrase) as one bit for each checksum."""

    def __init__(self, bits: int, members: bytes):
        self.bits, self.members = bits, np.frombuffer(members, np.uint8)

    @staticmethod
    def key(bits: int) -> Column:
        return F.pmod(F.crc32(F.concat("lang", F.lit("\n"), "phrase").cast("binary")), F.lit(bits))

    @classmethod
    def of(cls, phrases: DataFrame, bits_for: int) -> Filter:
        """The filter of a table with ``bits_for`` rows; at most ``MOST_BITS`` / 8
        bytes come to the driver, in pieces of 4 KB."""
        bits = _power(8 * bits_for, LEAST_BITS, MOST_BITS)
        place = cls.key(bits) + 1  # bitmaps count from 1
        pieces = (phrases.groupBy(F.bitmap_bucket_number(place).alias("number"))
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("piece")).collect())
        members = bytearray(bits // 8)
        for number, piece in pieces:
            members[(number - 1) * 4096:number * 4096] = piece
        return cls(bits, bytes(members))

    def holds(self, lang: bytes, phrases: list[bytes]) -> np.ndarray:
        start = zlib.crc32(lang + b"\n")
        keys = np.fromiter((zlib.crc32(p, start) for p in phrases), np.int64, len(phrases)) % self.bits
        return (self.members[keys >> 3] >> (keys & 7).astype(np.uint8)) & 1 == 1


class _Ids:
    """Numbers of the frequent words of a language, 0 for any other word, and a
    64-bit hash of each."""

    def __init__(self, words: Filter, lang: str):
        self.words, self.lang = words, lang.encode()
        self.of: dict[bytes, int] = {STOP: 0}
        self.names: list[bytes] = [b""]
        self.hashes = np.zeros(1, np.uint64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.of]
        if new:
            known = len(self.names)
            for w, ok in zip(new, self.words.holds(self.lang, new).tolist()):
                self.of[w] = len(self.names) if ok else 0
                if ok:
                    self.names.append(w)
            more = [int.from_bytes(hashlib.blake2b(w, digest_size=8, key=self.lang[:64]).digest(), "little")
                    for w in self.names[known:]]
            self.hashes = np.concatenate([self.hashes, np.array(more, np.uint64)])
        return np.fromiter(map(self.of.__getitem__, words), np.int64, len(words))

    def phrase(self, ids) -> bytes:
        return SEP.join(self.names[i] for i in ids)


class Grams:
    """The phrases of k words that may reach the least count, as one bit for each
    bucket of a hash; ``members[k]`` are the bits of length k."""

    def __init__(self, buckets: int, members: dict[int, np.ndarray]):
        self.buckets, self.members = buckets, members

    def keys(self, ids: np.ndarray, hashes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """The buckets of the k words from each of the places ``at`` on."""
        key = np.full(len(at), k, np.uint64)
        for i in range(k):
            key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[ids[at + i]]
            key ^= key >> np.uint64(29)
        return (key * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.int64) & (self.buckets - 1)

    def places(self, ids: np.ndarray, hashes: np.ndarray, upto: int) -> dict[int, np.ndarray]:
        """For each k the places where a phrase of k words may reach the least
        count: both its parts of k - 1 words do, and its bucket if that is known."""
        good = ids > 0
        out = {1: np.flatnonzero(good)}
        for k in range(2, upto + 1):
            good[:-1] &= good[1:]
            good[-1:] = False
            at = np.flatnonzero(good)
            if k in self.members:
                key = self.keys(ids, hashes, at, k)
                ok = (self.members[k][key >> 3] >> (key & 7).astype(np.uint8)) & 1 == 1
                good[at[~ok]] = False
                at = at[ok]
            out[k] = at
        return out


#: Buckets of a row; a row holds offsets and counts of those in use.
_BLOCK = 1 << 16


class _Buckets:
    """Counts of buckets by length, emptied at ``ENTRIES``."""

    def __init__(self, least: int):
        self.least = least
        self.parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size = 0

    def add(self, k: int, keys: np.ndarray) -> None:
        part = np.unique(keys, return_counts=True)
        self.parts.setdefault(k, []).append(part)
        self.size += len(part[0])

    def emptied(self) -> Iterator[tuple[int, int, bytes]]:
        for k, parts in self.parts.items():
            keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([p[1] for p in parts]))
            n = np.minimum(n, self.least).astype(np.uint32 if self.least > 255 else np.uint8)
            cuts = np.flatnonzero(np.diff(keys >> 16)) + 1
            for off, c in zip(np.split(keys, cuts), np.split(n, cuts)):
                if len(off):
                    yield k, int(off[0] >> 16), (off & (_BLOCK - 1)).astype(np.uint16).tobytes() + c.tobytes()
        self.parts, self.size = {}, 0


def _bucket_bits(least: int):
    """(k, block, bits): the buckets of each block whose counts reach ``least``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 6 if least > 255 else 3
        here, counts = None, None

        def row() -> pa.RecordBatch:
            bits = np.packbits(counts >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([here[0]], pa.int32()), pa.array([here[1]], pa.int32()),
                                               pa.array([bits], pa.binary())], ["k", "block", "data"])

        for b in batches:
            for k, block, data in zip(*(b.column(c).to_pylist() for c in ("k", "block", "data"))):
                if (k, block) != here:
                    if here:
                        yield row()
                    here, counts = (k, block), np.zeros(_BLOCK, np.int64)
                n = len(data) // width
                counts[np.frombuffer(data, np.uint16, n)] += np.frombuffer(
                    data, np.uint32 if width == 6 else np.uint8, n, 2 * n)
        if here:
            yield row()
    return run


def _distinct(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows and their summed counts."""
    key = rows[:, 0]
    for c in range(1, rows.shape[1]):
        key = np.unique(key, return_inverse=True)[1].astype(np.int64) * (int(rows[:, c].max(initial=0)) + 1) + rows[:, c]
    _, first, where = np.unique(key, return_index=True, return_inverse=True)
    return rows[first], np.bincount(where, weights=counts).astype(np.int64)


class _Table:
    """Counts of rows of numbers by language, emptied at ``ENTRIES`` rows."""

    def __init__(self, words: Filter):
        self.words = words
        self.ids: dict[str, _Ids] = {}
        self.rows: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size = self.least = 0

    def of(self, lang: str) -> _Ids:
        if lang not in self.ids:
            self.ids[lang] = _Ids(self.words, lang)
        return self.ids[lang]

    def add(self, lang: str, rows: np.ndarray) -> None:
        if len(rows):
            self.rows.setdefault(lang, []).append(_distinct(rows, np.ones(len(rows))))
            self.size += len(self.rows[lang][-1][0])

    def merged(self, lang: str) -> tuple[np.ndarray, np.ndarray]:
        parts = self.rows[lang]
        if len(parts) == 1:
            return parts[0]
        return _distinct(np.concatenate([r for r, _ in parts]), np.concatenate([n for _, n in parts]))

    def full(self) -> bool:
        """Whether it holds too much even when equal rows are added up."""
        if self.size > ENTRIES + self.least:
            self.rows = {lang: [self.merged(lang)] for lang in self.rows}
            self.size = self.least = sum(len(r) for p in self.rows.values() for r, _ in p)
        return self.size > ENTRIES or sum(len(i.of) for i in self.ids.values()) > ENTRIES

    def clear(self) -> None:
        self.rows, self.ids, self.size, self.least = {}, {}, 0, 0


_FOUND = "lang string, k int, block int, data binary"


def _found(rows: list[tuple[str | None, int, int, bytes]]) -> pa.RecordBatch:
    langs, ks, blocks, data = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(ks, pa.int32()),
                                       pa.array(blocks, pa.int32()), pa.array(data, pa.binary())],
                                      ["lang", "k", "block", "data"])


def _merged_counts(least: int):
    """(lang, phrase, f) of the phrases that reach ``least`` from the packed rows
    of a part, which come one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, counts = None, Counter()

        def part() -> Iterator[pa.RecordBatch]:
            kept = [(here[0], p.decode(), f) for p, f in counts.items() if f >= least]
            if kept:
                yield _node_batch(kept)

        for b in batches:
            for lang, block, data in zip(*(b.column(c).to_pylist() for c in ("lang", "block", "data"))):
                if (lang, block) != here:
                    if here:
                        yield from part()
                    here, counts = (lang, block), Counter()
                for line in data.split(b"\n"):
                    phrase, _, f = line.rpartition(SEP)
                    counts[phrase] += int(f)
        if here:
            yield from part()
    return run


def _survey(words: Filter, grams: Grams, lengths: tuple[int, ...], least: int, depth: int = 0,
            known: frozenset | None = None, parts: int = 1):
    """Bucket counts of the phrases of ``lengths`` words whose shorter parts may
    reach the least count, and counts of phrases of ``depth`` words (k = 0), packed
    by a hash into ``parts``; with ``known``, of those only that go on from one
    of these (lang, prefix)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, buckets = _Table(words), _Buckets(least)

        def rows_of_table() -> Iterator[pa.RecordBatch]:
            for lang in list(table.rows):
                ids, (rows, n) = table.of(lang), table.merged(lang)
                packed: dict[int, list[bytes]] = {}
                for r, c in zip(rows.tolist(), n.tolist()):
                    phrase = ids.phrase(r)
                    if known is None or (lang, phrase.rpartition(SEP)[0]) in known:
                        packed.setdefault(zlib.crc32(phrase) % parts, []).append(b"%s\t%d" % (phrase, c))
                yield _found([(lang, 0, part, b"\n".join(lines)) for part, lines in packed.items()])
            table.clear()

        def rows_of_buckets() -> Iterator[pa.RecordBatch]:
            yield _found([(None, *x) for x in buckets.emptied()])

        for lang, tokens, own in _slices(batches):
            names = table.of(lang)
            ids = names.numbers(tokens)
            places = grams.places(ids, names.hashes, max(depth, *lengths, 2))
            for k in lengths:
                at = places[k]
                buckets.add(k, grams.keys(ids, names.hashes, at[at < own], k))
            if depth:
                at = places[depth]
                at = at[at < own]
                table.add(lang, np.stack([ids[at + i] for i in range(depth)], axis=1))
            if table.full():
                yield from rows_of_table()
            if buckets.size > ENTRIES:
                yield from rows_of_buckets()
        yield from rows_of_table()
        yield from rows_of_buckets()
    return run


def _suffixes(words: Filter, grams: Grams, hot: list[frozenset]):
    """(lang, phrase, f, unit): suffixes of three words and more with the number of
    words of their unit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Table(words)

        def emptied() -> Iterator[pa.RecordBatch]:
            for lang in list(table.rows):
                ids, (rows, n) = table.of(lang), table.merged(lang)
                phrases = [ids.phrase([i for i in r if i]) for r in rows.tolist()]
                units = []
                for p in phrases:
                    parts, unit = p.split(SEP), 2
                    while (unit < len(parts) and unit - 2 < len(hot)
                           and (lang, SEP.join(parts[:unit])) in hot[unit - 2]):
                        unit += 1
                    units.append(unit)
                yield _batch([lang] * len(phrases), phrases, n, units)
            table.clear()

        for lang, tokens, own in _slices(batches):
            names = table.of(lang)
            ids = names.numbers(tokens)
            places = grams.places(ids, names.hashes, DEPTH)
            reach = np.zeros(len(ids), np.int64)
            for k in range(3, DEPTH + 1):
                reach[places[k]] = k
            at = np.flatnonzero(reach[:own])
            padded = np.concatenate([ids, np.zeros(DEPTH, np.int64)])
            rows = np.stack([np.where(reach[at] > i, padded[at + i], 0) for i in range(DEPTH)], axis=1)
            table.add(lang, rows)
            if table.full():
                yield from emptied()
        yield from emptied()
    return run


def _subtree_counts(least: int, extended: frozenset):
    """Counts of the nodes of subtrees from their leaves in depth-first order;
    those of units are known, also of the ``extended`` ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, path, totals = None, [], []  # the open nodes, from the unit's first word on
        out: list[tuple[str, str, int]] = []

        def close(depth: int) -> None:
            while len(path) > depth:
                f = totals.pop()
                if f >= least and len(path) > 2 and (lang, phrase := "\t".join(path)) not in extended:
                    out.append((lang, phrase, f))
                path.pop()
                if totals:
                    totals[-1] += f

        for b in batches:
            for here, phrase, f in zip(b.column("lang").to_pylist(), b.column("phrase").to_pylist(),
                                       b.column("f").to_pylist()):
                words = phrase.split("\t")
                same = 0
                if here == lang:
                    for a, w in zip(path, words):
                        if a != w:
                            break
                        same += 1
                close(same)
                lang = here
                for w in words[same:]:
                    path.append(w)
                    totals.append(0)
                totals[-1] += f
            if out:
                yield _node_batch(out)
                out.clear()
        close(0)
        if out:
            yield _node_batch(out)
    return run


def _node_batch(rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
    langs, phrases, fs = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.string()),
                                       pa.array(fs, pa.int64())], ["lang", "phrase", "f"])


_COUNTS = "lang string, phrase string, f long"


def _first_words(n: int) -> Column:
    return F.substring_index("phrase", "\t", n)


def phrase_counts(docs: DataFrame, least: int = LEAST, memory: int = MEMORY) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of up to ``DEPTH`` words with ``f`` of at least
    ``least``, words joined by tabs, and (lang, n) with all words' number."""
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    counted = map_arrow(texts, _count_words, _COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    words = written(counted, "colloc-words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= least)
    of_words = Filter.of(frequent, frequent.count())
    n, n_words = shuffle_partitions(spark), totals.agg(F.sum("n")).first()[0] or 0
    grams = Grams(_power(n_words // 8, LEAST_BITS // 16, MOST_BITS), {})

    def survey(lengths: tuple[int, ...], depth: int = 0, known: frozenset | None = None) -> DataFrame | None:
        """Adds the bits of ``lengths`` to ``grams``, returns the counts of ``depth`` words."""
        # a part holds some ten thousand of the phrases that may reach the least count
        candidates = int(np.bitwise_count(grams.members[2]).sum()) if depth else 0
        parts = max(n, candidates >> 14)
        found = written(map_arrow(texts, _survey(of_words, grams, lengths, least, depth, known, parts), _FOUND),
                        "colloc-survey")
        blocks = (found.where("k > 0").select("k", "block", "data")
                  .repartition(n, "k", "block").sortWithinPartitions("k", "block"))
        for k in lengths:
            grams.members[k] = np.zeros(grams.buckets // 8, np.uint8)
        for k, block, data in map_arrow(blocks, _bucket_bits(least), "k int, block int, data binary").collect():
            bits = np.frombuffer(data, np.uint8)[:grams.buckets // 8]
            grams.members[k][block * _BLOCK // 8:][:len(bits)] = bits
        if not depth:
            return None
        exact = (found.where("k = 0").select("lang", "block", "data")
                 .repartition(n, "lang", "block").sortWithinPartitions("lang", "block"))
        return written(map_arrow(exact, _merged_counts(least), _COUNTS), "colloc-prefixes")

    survey((2, 3))
    pairs = units = survey((4, 5), 2)
    n_suffixes = units.agg(F.sum("f")).first()[0] or 0
    hot: list[frozenset] = []  # units above the budget: at most all suffixes / budget
    known: list[DataFrame] = [pairs]
    for depth in range(3, DEPTH + 1):
        over = frozenset((r["lang"], r["phrase"].encode())
                         for r in units.where(F.col("f") > memory).collect())
        if not over:
            break
        hot.append(over)
        if depth < DEPTH:
            units = survey((), depth, over)
            known.append(units.where(F.col("f") > memory))
    groups = max(n, -(-n_suffixes // memory))
    leaves = map_arrow(texts, _suffixes(of_words, grams, hot), _COUNTS + ", unit byte")
    unit = F.expr("substring_index(phrase, '\t', unit)")
    dealt = leaves.select(F.pmod(F.xxhash64("lang", unit), F.lit(groups)).alias("group"), "lang", "phrase", "f")
    in_order = dealt.repartition(n, "group").sortWithinPartitions("group", "lang", "phrase")
    extended = frozenset((lang, p.decode()) for over in hot for lang, p in over)
    nodes = map_arrow(in_order.select("lang", "phrase", "f"), _subtree_counts(least, extended), _COUNTS)
    # pairs, and longer units whose subtree is in several groups, were counted before
    for table in known:
        nodes = nodes.union(table.select("lang", "phrase", "f"))
    return written(nodes.union(frequent.select("lang", "phrase", "f")), "colloc-counts"), totals


def _shown(phrase: Column) -> Column:
    """The phrase as in the text, words joined by blanks."""
    low = "".join(map(chr, _LOW[1:]))
    shown = F.translate(phrase, _HIGH[1:].decode() + "\t", low + " ")
    return F.replace(shown, F.lit(_HIGH[:1].decode()), F.lit("\x00"))


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all phrases of two words and more, by the
    cut with the lowest score."""
    size = F.size(F.split("phrase", "\t"))
    cuts = (counts.where(F.instr("phrase", "\t") > 0).withColumn("m", size)
            .select("lang", "phrase", F.col("f").alias("a"), "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
            .withColumn("first", F.expr("substring_index(phrase, '\t', k)"))
            .withColumn("rest", F.expr("substring_index(phrase, '\t', k - m)")))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    parts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    wide = {c: f"CAST({c} AS DECIMAL(38,0))" for c in "anlr"}
    score = F.expr(f"(1000 * {wide['a']} * {wide['n']}) div ({wide['l']} * {wide['r']})")
    low = parts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut"))
    return low.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, memory: int = MEMORY) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases that
    no longer one covers."""
    counts, totals = phrase_counts(docs, least, memory)
    found = scored(counts, totals)
    # what a longer phrase covers, the one with a word more covers as well
    edges = F.array(F.expr("substring_index(phrase, '\t', size(split(phrase, '\t')) - 1)"),
                    F.expr("substring(phrase, instr(phrase, '\t') + 1)"))
    longer = (counts.where(F.size(F.split("phrase", "\t")) > 2)
              .select("lang", F.explode(edges).alias("phrase"), "f")
              .groupBy("lang", "phrase").agg(F.max("f").alias("within")))
    kept = found.join(longer, ["lang", "phrase"], "left").where("within IS NULL OR within < a")
    kept = kept.select("lang", _shown(F.col("phrase")).alias("phrase"), "a", "l", "r", "n", "score",
                       (-F.col("score")).alias("by_score"), (-F.col("a")).alias("by_a"))
    placed = numbered(kept, "colloc-ranks", "lang", "by_score", "by_a", "phrase")
    starts = placed.groupBy("lang").agg(F.min("nth").alias("start"))
    return (placed.join(starts, "lang").withColumn("rank", F.col("nth") - F.col("start") + 1)
            .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
