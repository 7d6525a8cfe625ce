"""The prefix trie of conversations by ROLLUP over turn-id columns.

A turn's id is a 128-bit digest of its role and text. Conversations are cut into
blocks of ``WIDTH`` turns, one row a block with the ids in positional columns
``c1 .. c8`` (null past the end) and ``prior``, the node that the block before it
ends in. ``GROUP BY block, prior, ROLLUP(c1, ..., c8)`` then aggregates all
prefixes of all blocks at once, and ``grouping_id()`` tells a group's depth in its
block. A block's last column holds the digest of everything up to there, which
is the next block's ``prior``.

That digest needs no walk along a conversation: block digests are combined
over 1, 2, 4, ... blocks back (prefix doubling), so a conversation of n blocks takes
log2(n) joins on unique keys, and one of a single block none. Sums over
subtrees are a second ROLLUP over the nodes; what lies in later blocks is added
to a block's last nodes first, again by doubling over the blocks of a chain.

Scale: a turn's place comes from a range-partitioned sort and the first place of
its conversation, so a conversation may hold any share of all rows. The
aggregations reduce map-side, so a common first turn is no hot spot. Ids of the
conversations that end in a node are gathered as texts of bounded size.

Defined results: rows without a conv_id belong to no conversation; a null role or
text counts as empty; a null turn comes first; turns of equal number go by the
first ``HEAD`` characters of role and text, then by digest, and repeated rows
are turns of their own; texts of any length only reach their digest and length;
other columns are ignored; no conversations give no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, numbered, shuffle_partitions, written

#: Turn columns of a block.
WIDTH = 8
#: Characters of role and text that order turns of equal number.
HEAD = 100
#: Bytes of a piece of an id list.
PIECE = 1 << 16

ROOT = b""


def digest(*parts: Column) -> Column:
    """The first 128 bits of the SHA-256 of the joined binary columns."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def turn_id(role: Column, text: Column) -> Column:
    return digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def turn_texts(conversations: DataFrame) -> DataFrame:
    """(turn_id, role, text) of every different turn, to read nodes by."""
    return conversations.select(turn_id(_text("role"), _text("text")).alias("turn_id"),
                                _text("role").alias("role"), _text("text").alias("text")
                                ).dropDuplicates(["turn_id"])


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos from 0, turn_id, n_chars, turns) and conversations
    (conv_id, turns)."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("place"),
        F.substring(_text("role"), 1, HEAD).alias("role"),
        F.substring(_text("text"), 1, HEAD).alias("head"),
        turn_id(_text("role"), _text("text")).alias("turn_id"),
        F.char_length(_text("text")).cast("long").alias("n_chars"),
        F.monotonically_increasing_id().alias("row"))
    nth = numbered(rows, "trie-turns", "conv_id", "place", "role", "head", "turn_id", "row")
    starts = nth.groupBy("conv_id").agg(F.min("nth").alias("start"), F.count(F.lit(1)).alias("turns"))
    turns = nth.join(starts, "conv_id").select(
        "conv_id", (F.col("nth") - F.col("start")).alias("pos"), "turn_id", "n_chars", "turns")
    return turns, starts.select("conv_id", "turns")


def with_shared_heads(turns: DataFrame, convs: DataFrame, heads: Column, base: Column,
                      longest: int) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations where each takes the first ``heads`` (``longest`` at
    most) turns of conversation ``base`` in place of as many of its own."""
    plan = convs.select("conv_id", "turns", heads.cast("long").alias("h"), base.alias("base"))
    known = convs.select(F.col("conv_id").alias("base"), F.col("turns").alias("there"))
    plan = plan.join(known, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("kept"), "turns")
    plan = plan.withColumn("turns", F.col("kept") + F.greatest(F.col("turns") - F.col("h"), F.lit(0)))
    own = (turns.drop("turns").join(plan, "conv_id").where("pos >= h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("kept")).alias("pos"),
                   "turn_id", "n_chars", "turns"))
    shared = turns.where(F.col("pos") < longest).select(
        F.col("conv_id").alias("base"), "pos", "turn_id", "n_chars")
    taken = (plan.where("kept > 0").join(shared, "base").where("pos < h")
             .select("conv_id", "pos", "turn_id", "n_chars", "turns"))
    return own.union(taken), plan.select("conv_id", "turns")


def _columns(width: int) -> list[str]:
    return [f"c{i}" for i in range(1, width + 1)]


def _node(width: int, level: Column) -> Column:
    """The node at ``level`` of a block's row; the root and the nodes at the end
    of a block have names of their own."""
    out = F.col(f"c{width}")
    for n in range(width - 1, 0, -1):
        cells = [F.col(c) for c in _columns(n)]
        out = F.when(level == n, digest(F.col("block").cast("string").cast("binary"), F.col("prior"), *cells)
                     ).otherwise(out)
    return F.when(level == 0, F.col("prior")).otherwise(out)


def blocks(turns: DataFrame, convs: DataFrame, width: int = WIDTH) -> tuple[DataFrame, int]:
    """(conv_id, block, size, turns, prior, c1.., n1..) and the highest block."""
    cell = F.struct((F.col("pos") % width).alias("at"), "turn_id", "n_chars")
    cut = turns.groupBy("conv_id", F.floor(F.col("pos") / width).alias("block")).agg(
        F.array_sort(F.collect_list(cell)).alias("cells"), F.max("turns").alias("turns"))
    cut = written(cut.select(
        "conv_id", "block", "turns", F.size("cells").alias("size"),
        *[F.get("cells", F.lit(i))["turn_id"].alias(f"c{i + 1}") for i in range(width)],
        *[F.get("cells", F.lit(i))["n_chars"].alias(f"n{i + 1}") for i in range(width)],
        digest(F.array_join(F.transform("cells", lambda c: F.hex(c["turn_id"])), "").cast("binary"))
        .alias("ends_in")), "trie-cut")
    last = cut.agg(F.max("block")).first()[0] or 0
    chains = cut.where(F.col("turns") > width).select("conv_id", "block", "ends_in")
    step = 1
    while step <= last:
        back = chains.select("conv_id", (F.col("block") + step).alias("block"), F.col("ends_in").alias("back"))
        chains = written(chains.join(back, ["conv_id", "block"], "left").select(
            "conv_id", "block", F.when(F.col("back").isNotNull(), digest(F.col("back"), F.col("ends_in")))
            .otherwise(F.col("ends_in")).alias("ends_in")), "trie-chains")
        step *= 2
    whole = cut.where(F.col("turns") <= width).withColumn("prior", F.lit(ROOT))
    prior = chains.select("conv_id", (F.col("block") + 1).alias("block"), F.col("ends_in").alias("prior"))
    parts = (cut.where(F.col("turns") > width).drop("ends_in").join(chains, ["conv_id", "block"])
             .join(prior, ["conv_id", "block"], "left")
             .withColumn("prior", F.coalesce("prior", F.lit(ROOT))))
    empty = convs.where("turns = 0").select("conv_id", F.lit(0).cast("long").alias("block"), "turns",
                                            F.lit(0).alias("size"), F.lit(ROOT).alias("prior"))
    rows = whole.unionByName(parts).unionByName(empty, allowMissingColumns=True)
    # the last column names all that leads to it
    full = F.when(F.col("size") == width, F.col("ends_in")).alias(f"c{width}")
    return written(rows.select("conv_id", "block", "size", "turns", "prior", *_columns(width - 1), full,
                               *[f"n{i}" for i in range(1, width + 1)]), "trie-blocks"), last


def _rollup(table: DataFrame, width: int, measures: str) -> DataFrame:
    """All prefixes of the blocks of ``table`` with ``measures`` and ``level``;
    groups of what lies past a row's end are dropped."""
    names = ", ".join(_columns(width))
    rolled = table.sparkSession.sql(
        f"SELECT block, prior, {names}, {width} - bit_count(grouping_id()) AS level, {measures} "
        f"FROM {{table}} GROUP BY block, prior, ROLLUP({names})", table=table)
    here = F.get(F.array(*_columns(width)), F.col("level") - 1)
    return rolled.where(here.isNotNull() | ((F.col("level") == 0) & (F.col("block") == 0)))


def _later_blocks(nodes: DataFrame, rows: DataFrame, last: int) -> DataFrame:
    """(node, children, leaves, saved) of what lies in the blocks after the nodes
    that end one: ``children`` next to them, the rest over the whole subtree."""
    below = nodes.where("block > 0").groupBy("prior").agg(
        F.max("block").alias("block"), F.min("conv_id").alias("member"),
        F.sum((F.col("level") == 1).cast("long")).alias("children"),
        F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))
    below = written(below.select(F.col("prior").alias("node"), "block", "member", "children", "leaves", "saved"),
                    "trie-later")
    above = rows.where("block > 0").select(F.col("conv_id").alias("member"), F.col("block").alias("up"), "prior")
    step = 1
    while step < last:
        # the node ``step`` blocks up, by the member that names this one
        ups = (below.withColumn("up", F.col("block") - step).where("up > 0")
               .join(above, ["member", "up"]).groupBy(F.col("prior").alias("node"))
               .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
        below = written(below.join(ups, "node", "left").select(
            "node", "block", "member", "children",
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "trie-later")
        step *= 2
    return below.select("node", "children", "leaves", "saved")


def trie(rows: DataFrame, last: int, width: int = WIDTH) -> DataFrame:
    """One row a node: node, parent (ids), turn_id, conv_id (its smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens."""
    ns = [f"n{i}" for i in range(1, width + 1)]
    counted = _rollup(rows, width, "count(*) AS n_convs, min(conv_id) AS conv_id, max(turns) AS turns, "
                      + ", ".join(f"max({n}) AS {n}" for n in ns))
    depth = F.col("block") * width + F.col("level")
    n_chars = F.coalesce(F.get(F.array(*ns), F.col("level") - 1), F.lit(0))
    nodes = written(counted.select(
        "block", "prior", *_columns(width), "level", "n_convs", "conv_id",
        (F.col("turns") == depth).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * n_chars).alias("saved"), F.lit(0).cast("long").alias("children")), "trie-nodes")
    totals = nodes
    if last:
        later = _later_blocks(nodes, rows, last).select(
            F.col("node").alias("later"), F.col("children").alias("c"), F.col("leaves").alias("l"),
            F.col("saved").alias("s"))
        ends = nodes.where(F.col("level") == width).join(later, F.col(f"c{width}") == F.col("later"), "left")
        totals = nodes.where(F.col("level") < width).unionByName(
            ends.withColumn("children", F.coalesce("c", "children"))
            .withColumn("leaf", F.col("leaf") + F.coalesce("l", F.lit(0)))
            .withColumn("saved", F.col("saved") + F.coalesce("s", F.lit(0))).drop("later", "c", "l", "s"))
    levels = [f"sum(CAST(level = {i} AS BIGINT)) AS k{i}" for i in range(1, width + 1)]
    summed = _rollup(totals.withColumnRenamed("level", "own"), width, ", ".join(
        ["max(n_convs) AS n_convs", "min(conv_id) AS conv_id", "sum(leaf) AS n_leaves",
         "sum(saved) AS saved_tokens", "max(children) AS children",
         *[s.replace("level", "own") for s in levels]]))
    at, width_children = F.col("level"), F.coalesce("children", F.lit(0))
    n_children = F.when(at == width, width_children).otherwise(
        F.get(F.array(*[f"k{i}" for i in range(1, width + 1)]), at))
    tree = written(summed.select(
        _node(width, at).alias("node"),
        F.when(depth > 0, F.when(at <= 1, F.col("prior")).otherwise(_node(width, at - 1))).alias("parent"),
        depth.alias("depth"), "conv_id", "n_convs", n_children.alias("n_children"), "n_leaves", "saved_tokens"),
        "trie-tree")
    # the root's children have one parent, which no join needs to find
    first = tree.where("depth = 0").select("conv_id").first()
    near = tree.where("depth <= 1").withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.lit(first and first[0]).cast("long")))
    above = tree.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return near.unionByName(tree.where("depth > 1").join(above, "parent"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a node's sorted ids as texts of ``PIECE`` bytes or so."""
    node, first, ids, size = None, None, [], 0
    out: list[tuple[bytes, int, str]] = []

    def batch() -> pa.RecordBatch:
        nodes, firsts, texts = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(firsts, pa.int64()),
                                           pa.array(texts, pa.string())], ["node", "first", "ids"])

    for b in batches:
        for n, c in zip(b.column("node").to_pylist(), b.column("conv_id").to_pylist()):
            if n != node or size > PIECE:
                if ids:
                    out.append((node, first, ",".join(ids)))
                node, first, ids, size = n, c, [], 0
            ids.append(str(c))
            size += len(ids[-1]) + 1
        if out:
            yield batch()
            out = []
    if ids:
        out.append((node, first, ",".join(ids)))
        yield batch()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each node's pieces, joined by commas."""
    node, sha, out = None, None, []

    def batch() -> pa.RecordBatch:
        nodes, texts = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(texts, pa.string())],
                                          ["node", "sha256"])

    for b in batches:
        for n, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
            if n == node:
                sha.update(b",")
            else:
                if sha:
                    out.append((node, sha.hexdigest()))
                node, sha = n, hashlib.sha256()
            sha.update(ids.encode())
        if out:
            yield batch()
            out = []
    if sha:
        out.append((node, sha.hexdigest()))
        yield batch()


def ends(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """(node, first, ids): the ids of the conversations that end in a node,
    ascending, as texts of bounded size, which go by ``first``."""
    at = rows.where(F.col("block") * width + F.col("size") == F.col("turns"))
    at = at.select(_node(width, F.col("size")).alias("node"), "conv_id")
    spread = at.repartitionByRange(shuffle_partitions(rows.sparkSession), "node", "conv_id")
    return map_arrow(spread.sortWithinPartitions("node", "conv_id"), _pieces,
                     "node binary, first long, ids string")


def end_digests(pieces: DataFrame) -> DataFrame:
    """(node, sha256) of the pieces of ``ends``."""
    return map_arrow(pieces.repartition(shuffle_partitions(pieces.sparkSession), "node")
                     .sortWithinPartitions("node", "first"), _digests, "node binary, sha256 string")


def conversation_trie(conversations: DataFrame, rebuild=None, width: int = WIDTH) -> DataFrame:
    """The nodes of ``trie`` with ``ends_sha256``; ``rebuild`` may change turns
    and conversations before."""
    turns, convs = ordered_turns(conversations)
    if rebuild:
        turns, convs = rebuild(turns, convs)
    rows, last = blocks(turns, convs, width)
    found = end_digests(written(ends(rows, width), "trie-ends"))
    return trie(rows, last, width).join(found, "node", "left").withColumn(
        "ends_sha256", F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256))).drop("sha256")
