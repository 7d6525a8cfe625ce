"""Near duplicates, components and shards against brute force."""

import random
import re
import zlib
from collections import defaultdict

import pytest

from weblens.llm import minhash, sharding
from weblens.llm.components import components

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, n):
    """doc_id -> smallest id reachable."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if both and 100 * both >= 80 * (len(a) + len(b) - both):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return {i: find(i) for i in root}


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_on_odd_rows(spark, odd_docs, no_docs, words):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = minhash.near_duplicates(odd_docs, words).collect()
    assert len(got) == len(rows)
    want = brute(rows, words)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    sizes = {i: len(shingles(t, words)) for i, t in rows}
    assert all(r["n_shingles"] == sizes[r["doc_id"]] for r in got)
    assert minhash.near_duplicates(no_docs, words).count() == 0


def test_cloud_of_copies_around_the_limit(spark):
    """Edited copies whose similarities lie on both sides of 0.8, so that most
    links are found by the later rounds."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(2, 14)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((1000 - i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 2).collect()}
    assert got == brute(rows, 2)


def test_signature_estimates_similarity():
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2 ** 63, 1000).astype("uint64")
    a, b = x[:900], x[100:]
    same = (minhash.signature(a, 512) == minhash.signature(b, 512)).mean()
    assert abs(same - 0.8) < 0.08


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 8), (8, 7), (7, 3), (6, 6), (None, 1)]
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {tuple(r) for r in got} == {(i, 1) for i in (1, 2, 3, 7, 8, 9)} | {(4, 4), (5, 4)}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def _check_shards(rows, got, shards):
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
    sizes = [len(by_shard[s]) for s in range(shards)]
    assert set(by_shard) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == want


def test_shards(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    for shards in (1, 4, 30):
        _check_shards(rows, sharding.shard_documents(odd_docs, shards).collect(), shards)
    assert sharding.shard_documents(no_docs).count() == 0


def test_shards_keep_copies_together(spark):
    rows = [(i, f"text {i % 40}" if i < 200 else f"own {i}") for i in range(1000)]
    rows += [(2000 + i, "a third of all") for i in range(500)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    _check_shards(rows, got, 8)
    text, shards = dict(rows), defaultdict(set)
    for r in got:
        shards[text[r["doc_id"]]].add(r["shard"])
    groups = [s for t, s in shards.items() if t.startswith("text")]
    assert sum(len(s) for s in groups) < 40 * 3  # 5 copies by hash fall into 3.9 shards
    assert len(shards["a third of all"]) >= 3


def test_near_duplicates_on_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, 2).collect()}
    assert got == brute(rows, 2)


def _cut(rows, got):
    """Shards of each text that more than one row has."""
    text, shards, n = dict(rows), defaultdict(set), defaultdict(int)
    for r in got:
        shards[text[r["doc_id"]]].add(r["shard"])
        n[text[r["doc_id"]]] += 1
    return {t: len(s) for t, s in shards.items() if n[t] > 1 and len(s) > 1}


def _shard(spark, rows):
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    _check_shards(rows, got, 8)
    return _cut(rows, got)


def test_linked_third_ends_in_one_shard_each(spark):
    """A third of all rows in pairs, fours, fives and larger groups: no link is cut."""
    texts = [f"g{size}-{g}" for size, groups in ((2, 100), (4, 50), (5, 40), (50, 4)) for g in range(groups)
             for _ in range(size)]
    texts += [f"own {i}" for i in range(1600)]
    assert _shard(spark, list(enumerate(texts))) == {}


def test_all_rows_linked_keep_most_links(spark):
    texts = [f"g{i // 5}" for i in range(2000)]
    assert len(_shard(spark, list(enumerate(texts)))) <= 24  # at the borders of shards
    # a group of a third of all rows leaves room for the others
    texts = ["a third of all"] * 800 + [f"g{i // 2}" for i in range(800)] + [f"own {i}" for i in range(800)]
    cut = _shard(spark, list(enumerate(texts)))
    assert cut.pop("a third of all") <= 5 and not cut


def test_admitted_moves_respect_room():
    wanted = {(0, 1): 10, (1, 0): 4, (2, 1): 7}
    may = sharding._admitted(wanted, {0: 100, 1: 100, 2: 50}, {0: 100, 1: 102, 2: 100})
    assert all(1 <= may[e] <= n for e, n in wanted.items())
    assert 100 - may[1, 0] + may[0, 1] + may[2, 1] <= 102 and 100 + may[1, 0] - may[0, 1] <= 100
    # full shards may swap
    assert sharding._admitted({(0, 1): 50, (1, 0): 50}, {0: 100, 1: 100}, {0: 100, 1: 100}) == {(0, 1): 50, (1, 0): 50}


def test_written_table_lets_go_of_its_plan(spark):
    """Shuffle files of a written table lay beside the next ones when Python let go of the plan late."""
    import gc
    import threading
    import time

    from weblens.llm.common import until_gone, written

    held = [spark.range(10)]
    plan = spark._jvm.java.lang.ref.WeakReference(held[0]._jdf)
    late = threading.Timer(2.5, held.clear)  # later than the second that was waited before
    late.start()
    began = time.monotonic()
    assert until_gone(spark, plan) and plan.refersTo(None) and time.monotonic() - began >= 2.5
    late.join()
    gc.collect()
    assert written(spark.range(10).groupBy("id").count(), "let-go", let_go=True).count() == 10
