"""Sharding by balanced label propagation.

Rows that share a group (here: equal texts) are linked. Every row starts in a
shard dealt by its hash; in each round the links vote: Spark counts a group's
rows by shard, adds the counts up over a row's groups, itself included, and a
row wants to move to the shard with most votes; of equal ones to the one that a
hash of the group names first, so the rows of a group that is split evenly agree
on one shard and no shard is preferred. Unlinked
rows take no room in the rounds: they give up their places. Between each two
shards as many rows move as their wishes and the room of both allow, where rows
that leave make room (``_admitted``); largest gain first and a group's rows
together. Groups larger than a shard take no part. The rounds end
when nothing wants to move or may move, or the cut links no longer become fewer.
The groups that are cut then, and those larger than a shard, fill the room that
the others left, one shard after another, so few of them are cut at the borders.
At last each shard keeps exactly its even share of rows, unlinked rows leaving
first, and the excess fills the shards that lack rows.

A group may hold any share of all rows: its votes are counted map-side, ranks
come from a range-partitioned sort whose keys are unique, and the excess of a
group larger than a shard goes on to the next shards. Only counts by shard
and by partition reach the driver.

Law: ``rows``: the row counts of two shards differ by one at most. A shard's
slots run from 0 without gaps.

Defined results: a null text counts as the empty text (1 byte with the row's
own); rows with equal or null ids are rows of their own; ties of votes go to
the shard that a hash of the smallest group names first; other columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, written

SHARDS = 8
#: A shard may hold this much more than its even share during the rounds.
SLACK = 0.02


def _number(df: DataFrame, name: str, *order: str) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """``df`` sorted by ``shard`` and ``order`` with ``rank``, its place among
    the rows of its shard from 0; and (shard, partition, rows) counts.
    ``order`` ends in a unique column, so no key is too large for a task."""
    n = shuffle_partitions(df.sparkSession)
    rows = written(df.repartitionByRange(n, "shard", *order)
                   .sortWithinPartitions("shard", *order)
                   .withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33).cast("int").alias("part")
    firsts = (rows.groupBy("shard", part).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
              .orderBy("shard", "part").collect())  # at most partitions + shards rows
    before: dict[int, int] = {}
    offsets = []
    for r in firsts:
        offsets.append((r["shard"], r["part"], before.get(r["shard"], 0) - r["first"]))
        before[r["shard"]] = before.get(r["shard"], 0) + r["n"]
    table = df.sparkSession.createDataFrame(offsets, "o_shard int, o_part int, shift long")
    ranked = (rows.join(F.broadcast(table), (F.col("shard") == F.col("o_shard"))
                        & (F.shiftright("at", 33).cast("int") == F.col("o_part")))
              .withColumn("rank", F.col("at") + F.col("shift"))
              .drop("o_shard", "o_part", "shift", "at"))
    return ranked, sorted(before.items())


def _case(column: str, values: dict[int, int]):
    """The value of each shard as an expression (one branch for each shard)."""
    out = F.lit(0).cast("long")
    for s, v in values.items():
        out = F.when(F.col(column) == s, F.lit(v).cast("long")).otherwise(out)
    return out


def _wishes(memberships: DataFrame, state: DataFrame) -> DataFrame:
    """(row, shard, gain, label): rows that have more neighbours in ``shard``
    than in their own, and the group that most of these come from."""
    held = memberships.join(state, "row")
    votes = held.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
    options = F.collect_list(F.struct("shard", "n")).alias("options")  # one entry for each shard
    by_group = votes.groupBy("group").agg(options)
    total = (held.join(by_group, "group")
             .select("row", F.col("shard").alias("own"), "group", F.explode("options").alias("o"))
             .groupBy("row", "own", F.col("o.shard").alias("shard"))
             .agg(F.sum("o.n").alias("votes"),
                  F.min("group").alias("label"))
             .withColumn("order", F.xxhash64("label", "shard")))
    best = total.groupBy("row").agg(
        F.max(F.struct("votes", "order", "shard", "label")).alias("b"),
        F.max(F.when(F.col("shard") == F.col("own"), F.col("votes")).otherwise(0)).alias("here"),
        F.min("own").alias("own"))
    return (best.select("row", F.col("b.shard").alias("shard"), "own", F.col("b.label").alias("label"),
                        (F.col("b.votes") - F.col("here")).alias("gain"))
            .where("shard != own"))


def _admitted(wanted: dict[tuple[int, int], int], held: dict[int, int],
              capacity: dict[int, int]) -> dict[tuple[int, int], int]:
    """How many of the rows that want to go from one shard to another may:
    all, less what no shard has room for after those that leave it."""
    may = dict(wanted)
    while True:
        for t in capacity:
            into = [e for e in may if e[1] == t and may[e]]
            over = (held.get(t, 0) + sum(may[e] for e in into)
                    - sum(n for e, n in may.items() if e[0] == t) - capacity[t])
            if over > 0 and into:
                # the fewest rows that may still come, dealt over the shards they come from
                total = sum(may[e] for e in into)
                left = max(0, total - over)
                for e in into:
                    n = may[e]
                    may[e] = left * n // total
                break
        else:
            return may


def _cut_links(linked: DataFrame, state: DataFrame) -> float:
    """Pairs of rows of a group that are in different shards."""
    n = F.col("n").cast("double")
    by_group = (linked.join(state.select("row", "shard"), "row")
                .groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
                .groupBy("group").agg((F.sum(n) * F.sum(n) - F.sum(n * n)).alias("cut")))
    return by_group.agg(F.coalesce(F.sum("cut"), F.lit(0.0)).alias("cut")).first()["cut"] / 2


def propagate(rows: DataFrame, memberships: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(row, shard, slot) for each ``row`` of ``rows``, linked by
    ``memberships`` (row, group): rows of a group are neighbours."""
    total = rows.count()
    quota = {s: total // shards + (s < total % shards) for s in range(shards)}
    capacity = {s: int(q * (1 + SLACK)) + 1 for s, q in quota.items()}
    sizes = memberships.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    fits = F.col("n") <= max(quota.values())
    links = written(memberships.join(sizes.withColumn("fits", fits).drop("n"), "group")
                    .select("row", "group", "fits"), "shard-links")
    labels = links.groupBy("row").agg(F.max("fits").alias("fits"), F.min_by(
        "group", F.struct(~F.col("fits"), "group")).alias("label"))
    linked = links.where("fits").select("row", "group")
    # 0: links that a shard can hold, 1: groups that none can hold, 2: no links
    kind = F.when(F.col("fits"), 0).when(F.col("label").isNotNull(), 1).otherwise(2)
    state = written(rows.select("row").join(labels, "row", "left").select(
        "row", "label", kind.alias("kind"),
        F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")), "shard-state")
    cut = _cut_links(linked, state)
    while cut:
        held = dict(state.where("kind = 0").groupBy("shard").count().collect())
        # one shard after another of each shard's movers: at most shards squared
        pair = (F.col("own") * shards + F.col("to")).cast("int")
        wishes, wanted = _number(
            _wishes(linked, state.select("row", "shard")).withColumnRenamed("shard", "to")
            .select("row", "to", pair.alias("shard"), "label", (-F.col("gain")).alias("loss")),
            "shard-wishes", "loss", "label", "row")
        may = _admitted({divmod(p, shards): n for p, n in wanted}, held, capacity)
        if not any(may.values()):
            break
        places = links.sparkSession.createDataFrame(
            [(o * shards + t, n) for (o, t), n in may.items()], "shard int, places long")
        moves = wishes.join(F.broadcast(places), "shard").where("rank < places").select("row", "to")
        moved = written(state.join(moves, "row", "left").select(
            "row", "label", "kind", F.coalesce("to", "shard").alias("shard")), "shard-state")
        before, cut = cut, _cut_links(linked, moved)
        if cut >= before:
            break
        state = moved
    if cut:  # groups that are still cut
        spread = linked.join(state.select("row", "shard"), "row").groupBy("group").agg(
            F.min("shard").alias("least"), F.max("shard").alias("most")).where("least != most")
        split = linked.join(spread.select("group"), "group").select("row").distinct()
        state = written(state.join(split.withColumn("split", F.lit(1)), "row", "left").select(
            "row", "label", F.coalesce("split", "kind").alias("kind"), "shard"), "shard-state")
    if state.where("kind = 1").limit(1).count():
        # these and the groups that no shard can hold fill what the others left
        held = dict(state.where("kind = 0").groupBy("shard").count().collect())
        room = sorted(((max(0, quota[s] - held.get(s, 0)), s) for s in quota), reverse=True)
        large, _ = _number(state.where("kind = 1").select("row", "label", F.lit(0).alias("shard")),
                           "shard-large", "label", "row")
        to, filled = F.lit(room[-1][1]), sum(n for n, _ in room)
        for n, s in reversed(room):
            to = F.when(F.col("rank") < filled, F.lit(s)).otherwise(to)
            filled -= n
        state = written(state.join(large.select("row", to.alias("to")), "row", "left").select(
            "row", "label", "kind", F.coalesce("to", "shard").alias("shard")), "shard-state")
    # linked rows first, so that the excess of a shard is made of others
    ranked, counts = _number(state, "shard-ranks", "kind", "label", "row")
    held = dict(counts)
    stay = {s: min(quota[s], held.get(s, 0)) for s in range(shards)}
    excess, start = {}, 0  # before the excess of each shard
    for s in range(shards):
        excess[s] = start
        start += held.get(s, 0) - stay[s]
    to, slot, filled = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    nth = F.col("rank") - _case("shard", stay) + _case("shard", excess)
    for s in range(shards):
        lack = quota[s] - stay[s]
        here = (nth >= filled) & (nth < filled + lack)
        to = F.when(here, F.lit(s)).otherwise(to)
        slot = F.when(here, nth - filled + stay[s]).otherwise(slot)
        filled += lack
    stays = F.col("rank") < _case("shard", stay)
    return ranked.select("row", F.when(stays, F.col("shard")).otherwise(to).alias("shard"),
                         F.when(stays, F.col("rank")).otherwise(slot).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): documents with equal texts
    are neighbours."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    base = written(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("group")), "shard-rows")
    placed = propagate(base.select("row"), base.select("row", "group"), shards)
    return base.drop("group").join(placed, "row").select(
        "doc_id", "size", "text_crc32", "shard", "slot")
