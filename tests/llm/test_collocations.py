"""Phrase counts and scores against a plain count of every phrase."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_fixtures import no_docs, odd_docs  # noqa: F401
from weblens.llm import collocations as c

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    return f, n


def plain(rows, least, top):
    f, n = plain_counts(rows)
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    inside = {}
    for (lang, p), a in found.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                key = lang, p[i:i + k]
                inside[key] = max(inside.get(key, 0), a)
    by_lang = {}
    for (lang, p), a in found.items():
        if inside.get((lang, p), 0) >= a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out = []
    for lang, found in by_lang.items():
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def make(spark, rows):
    return spark.createDataFrame([(i, *r, 1, "x") for i, r in enumerate(rows)],
                                 "doc_id long, lang string, text string, f int, phrase string")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    words = ["The", "of", "und", "é", "a\x01", "a", "\x00b", "x\x1f", "日本", "New", "York", "city", "I"]
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "\x0b", "\x85", "\xa0", "!?"]
    out = []
    for _ in range(150):
        text = "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(40)))
        out.append((rng.choice(["en", "de", None, ""]), text))
    out += [("en", None), ("en", ""), ("en", " . , "), (None, "new york city is new york city. " * 40)]
    out += [("en", "new york city hall park side")] * 30 + [("xx", "Only once")]
    out.append(("long", "la la di " * 9000 + "w" * 70000))
    return out


def collected(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("memory,size", [(1 << 20, 1 << 21), (40, 64)])
def test_equals_plain_counts(spark, rows, monkeypatch, memory, size):
    monkeypatch.setattr(c, "SLICE", size)
    docs = make(spark, rows)
    counts, totals = c.phrase_counts(docs, 5, memory)
    f, n = plain_counts(rows)
    assert {r["lang"]: r["n"] for r in totals.collect()} == {k: v for k, v in n.items() if v}
    assert counts.count() == sum(1 for v in f.values() if v >= 5)
    assert collected(c.collocations(docs, 5, 20, memory)) == plain(rows, 5, 20)


def test_tables_emptied_often(spark, rows, monkeypatch):
    monkeypatch.setattr(c, "ENTRIES", 10)
    assert collected(c.collocations(make(spark, rows), 5, 1000)) == plain(rows, 5, 1000)


def test_products_beyond_64_bits(spark):
    counts = spark.createDataFrame([("en", "a\tb", 3 * 10**12), ("en", "a", 4 * 10**12), ("en", "b", 5 * 10**12)],
                                   "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 7 * 10**14 + 1)], "lang string, n long")
    got = c.scored(counts, totals).collect()
    assert [r["score"] for r in got] == [1000 * 3 * 10**12 * (7 * 10**14 + 1) // (4 * 10**12 * 5 * 10**12)]


def test_no_rows(spark, no_docs):
    assert c.collocations(no_docs).collect() == []
    assert c.collocations(make(spark, [("en", None), (None, "a b c")])).collect() == []


def test_filter_has_all_members(spark):
    rows = [("en", f"w{i}\tv{i % 7}") for i in range(5000)]
    table = spark.createDataFrame(rows, "lang string, phrase string")
    found = c.Filter.of(table, len(rows))
    assert found.holds(b"en", [p.encode() for _, p in rows]).all()
    assert found.holds(b"en", [f"u{i}".encode() for i in range(5000)]).mean() < 0.05
