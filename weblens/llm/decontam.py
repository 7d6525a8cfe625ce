"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are lower-cased and every white-space run becomes one
space. An item of m characters may occur with an edit distance of up to
k = floor(m * ``rate``). It is split into k + 1 pieces of near equal length:
k edits leave one piece at least untouched, so an occurrence within the budget
holds an exact copy of a piece, at most k places from where it belongs. One
automaton finds the exact pieces of all items in a text, and the region around
a hit is verified by Myers' bit-parallel distance.

The items are the stated query set: they are taken in blocks of about
``BLOCK_BYTES`` by the hash of their id, and each block's automaton goes to
every task, so what is broadcast has that bound however large the benchmark.
Documents stay where they are read.

Defined results: one row for each document and item, with the least distance
and the first place among these; null and empty texts match nothing; items that
are null or empty after normalisation match nothing; an item of fewer than
``MIN_CHARS`` characters has budget 0 and must stand between word ends; rows
that repeat are reported once for each; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

RATE = 0.05
MIN_CHARS = 20
BLOCK_BYTES = 4_000_000


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(item: str, rate: float = RATE) -> int:
    return int(len(item) * rate) if len(item) >= MIN_CHARS else 0


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces as (offset, piece)."""
    cuts = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def myers(masks: dict[str, int], m: int, text: str) -> Iterator[int]:
    """After each character of ``text``, the least edit distance between the
    pattern and some substring that ends there (Myers 1999, with one machine
    word of any length). ``masks``: places of each character in the pattern."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, distance = full, 0, m
    for c in text:
        eq = masks.get(c, 0)
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp = vn | ~(d0 | vp) & full
        hn = d0 & vp
        if hp & top:
            distance += 1
        elif hn & top:
            distance -= 1
        hp = hp << 1 & full
        vp = (hn << 1 | ~(d0 | hp)) & full
        vn = hp & d0
        yield distance


class _Matcher:
    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = []
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            item = normalise(text)
            if not item:
                continue
            k, masks = budget(item, rate), {}
            for i, c in enumerate(item):
                masks[c] = masks.get(c, 0) | 1 << i
            for offset, piece in pieces(item, k):
                by_piece.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, item, k, masks))
        self.automaton = ahocorasick.Automaton()
        for piece, places in by_piece.items():
            self.automaton.add_word(piece, (len(piece), places))
        if by_piece:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, end, budget) of each item in a normalised text."""
        if not self.items or not text:
            return []
        regions: dict[int, list[list[int]]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for n, offset in places:
                _, item, k, _ = self.items[n]
                start = end + 1 - size - offset
                a, b = max(0, start - k), min(len(text), start + len(item) + k)
                found = regions.setdefault(n, [])
                if found and a <= found[-1][1]:  # regions of an item that meet are one
                    found[-1][0] = min(found[-1][0], a)
                    found[-1][1] = max(found[-1][1], b)
                else:
                    found.append([a, b])
        out = []
        for n, found in regions.items():
            item_id, item, k, masks = self.items[n]
            best = None
            for a, b in found:
                best = min(filter(None, (best, self._verify(text, a, b, item, k, masks))), default=None)
            if best:
                out.append((item_id, *best, k))
        return out

    @staticmethod
    def _verify(text, a, b, item, k, masks) -> tuple[int, int] | None:
        """(distance, end) of the best occurrence within text[a:b]."""
        if k == 0:
            at = text.find(item, a, b)
            while at >= 0:
                end = at + len(item)
                if len(item) >= MIN_CHARS or ((at == 0 or text[at - 1] == " ")
                                              and (end == len(text) or text[end] == " ")):
                    return 0, end
                at = text.find(item, at + 1, b)
            return None
        best = min((d, i) for i, d in enumerate(myers(masks, len(item), text[a:b]), a + 1))
        return best if best[0] <= k else None


_matchers: dict[str, _Matcher] = {}


def _matcher(block, rate) -> _Matcher:
    """The automaton of a block, built once per worker process."""
    key = block.value["key"]
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = _Matcher(block.value["items"], rate)
    return _matchers[key]


def _search(block, rate):
    def run(batches):
        matcher = _matcher(block, rate)
        for batch in batches:
            at, hits = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = matcher.find(normalise(text))
                at.extend([i] * len(found))
                hits.extend(found)
            columns = list(zip(*hits)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int32())),
                 *(pa.array(c, pa.int64()) for c in columns)],
                ["doc_id", "item_id", "distance", "end", "budget"])
    return run


def _blocks(benchmark: DataFrame, item_col: str, block_bytes: int) -> list:
    """The items as broadcast blocks of about ``block_bytes``."""
    sc = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.col("text").cast("string").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    parts = (items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()
             for i in range(n))
    return [sc.broadcast({"key": uuid.uuid4().hex, "items": [tuple(r) for r in rows]})
            for rows in parts]


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id",
            text_col: str = "text", item_col: str = "item_id",
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, distance, end, budget): items that occur in documents;
    ``end`` counts characters of the normalised text."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = (f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, item_id long, "
              "distance long, end long, budget long")
    found = [map_arrow(texts, _search(block, rate), schema)
             for block in _blocks(benchmark, item_col, block_bytes)]
    return reduce(DataFrame.union, found)


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text",
          item_col: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item occurs."""
    def keep(block):
        def run(batches):
            matcher = _matcher(block, rate)
            for batch in batches:
                hit = [bool(matcher.find(normalise(t))) for t in batch.column(text_col).to_pylist()]
                yield batch.filter(pa.array([not h for h in hit], pa.bool_()))
        return run
    for block in _blocks(benchmark, item_col, block_bytes):
        docs = map_arrow(docs, keep(block), docs.schema)
    return docs
