"""The prefix trie against a plain walk over all prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from weblens.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, node string, prior int, level int"


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def ordered(rows):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in by.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(int(c / 100) * 100, [])[:h] + own[h:]
    return out


def nodes(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in members:
        children.setdefault(p, 0)
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (children[p] == 0)
            saved[p[:d]] = saved.get(p[:d], 0) + ((len(m) - 1) * len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p],
                    leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    shared = [("user", "hello"), ("assistant", "hi 😀"), (None, None), ("user", "")]
    for c in range(40):
        n = rng.choice([1, 2, 3, 5, 8, 9, 16, 17, 31])
        start = rng.randrange(len(shared) + 1)
        for i in range(n):
            role, text = shared[i] if i < start else (rng.choice(["user", "a"]), rng.choice("xyz") * rng.choice([1, 1, 2]))
            out.append((c * 7, i, role, text))
        if c % 5 == 0:  # a copy under another id
            out += [(c * 7 + 3, t, r, x) for k, t, r, x in out if k == c * 7]
    long = [(1000, i, "user", str(i % 3)) for i in range(70)]
    out += long + [(1001, i, "user", str(i % 3)) for i in range(69)] + [(1002, i, "user", str(i % 3)) for i in range(70)]
    out += [(None, 0, "user", "no id"), (2000, None, "b", "second"), (2000, None, "a", "first"), (2000, 0, "c", "third"),
            (2001, 4, "r", "tie"), (2001, 4, "r", "tie"), (-5, 0, "user", "hello"), (2002, 0, "user", "w" * 50000)]
    return out


@pytest.mark.parametrize("width", [2, 3, 8])
def test_trie_equals_all_prefixes(spark, rows, width):
    got = prefix_trie.conversation_trie(make(spark, rows), width=width)
    assert result(got) == nodes(ordered(rows))


def test_rebuilt_conversations(spark, rows, tmp_path):
    extra = [(c, i, "user", f"t{i}") for c in (100, 105, 163, 3001, 3002) for i in range(1 + c % 4)]
    path = str(tmp_path)
    make(spark, rows + extra).write.parquet(f"{path}/conversations.parquet")
    got = queries.op11_prefix_trie(spark, path)
    expected = nodes(rebuilt(ordered(rows + extra)))
    assert result(got) == expected
    assert any(not t for t in rebuilt(ordered(rows + extra)).values())  # a turnless one is among them


def test_no_conversations(spark):
    assert result(prefix_trie.conversation_trie(make(spark, []))) == []
    assert result(prefix_trie.conversation_trie(make(spark, [(None, 1, "a", "b")]))) == []


def test_long_id_lists_are_cut_in_pieces(spark, monkeypatch):
    convs = [(c, 0, "user", "same") for c in range(30000)]
    turns, known = prefix_trie.ordered_turns(make(spark, convs))
    rows, last = prefix_trie.blocks(turns, known)
    pieces = prefix_trie.ends(rows)
    assert last == 0 and pieces.count() > 1
    assert pieces.agg(F.max(F.length("ids"))).first()[0] <= prefix_trie.PIECE + 20
    digest = hashlib.sha256(",".join(map(str, range(30000))).encode()).hexdigest()
    assert [r["sha256"] for r in prefix_trie.end_digests(pieces).collect()] == [digest]


def test_turn_texts_name_the_turns(spark, rows):
    table = make(spark, rows)
    turns, _ = prefix_trie.ordered_turns(table)
    texts = prefix_trie.turn_texts(table)
    got = turns.join(texts, "turn_id").where("conv_id = 2000").orderBy("pos").select("text").collect()
    assert [r[0] for r in got] == ["first", "second", "third"]
