"""Mixing sources to target weights by pivotal dependent rounding.

Targets: the sources share ``share`` times all words by weight; a source gets
``MOST`` times its words at most, and the excess goes to the others by weight
until none is above. Each round is one aggregate over the table of sources.

Rounding: a document of a source is taken target / size-of-source times, a whole
part and a fraction. Two documents with fractions are paired and words are moved
from one to the other, at random in either direction, as many as make one of the
fractions 0 or 1; the odds keep each expected number of copies, and the words of
the pair do not change. So a group of documents ends with one fraction at most,
and its words are kept exactly. Groups of ``GROUP`` documents are rounded in
parallel and what is left of them meets in a tree: groups of ``FAN`` residuals, groups of
these, until one fraction a source is left, which goes to the nearer end. Large
documents are paired first, so that what is left is mostly small. A source's
words differ from its target by half of one document at most.

Scale: documents are numbered by a range-partitioned sort on (source, digest), and
every ``GROUP`` of these numbers is a group, so the groups are bounded whatever
share a source holds. Texts are read once, for their size and digest. The
tree's levels grow with the logarithm of the rows.

Reruns agree: numbers, groups and random draws depend on the rows' content only
(rows that are equal in id, source and text are interchangeable).

Defined results: a null or empty text has size 0, is taken with the whole part of
its copies and adds no words; a null source is the last source; repeated rows are
documents of their own; other columns are ignored; texts of any length count whole;
an empty table gives an empty table; sources without words have target 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, workers_import_package, written
from ..session import broadcast_fits

#: Weights of the sources in their order, again and again.
WEIGHTS = (5, 2, 1)
#: Words of the mix, as a part of all words.
SHARE = 1.5
#: Most copies of a document, and of a source.
MOST = 2
#: Documents that one task rounds together, and residuals of groups that meet.
GROUP, FAN = 1000, 1000
SEED = 20240611

_STATE = "source_nth long, nth long, doc_id {id}, size long, source_size long, target double, copies int, open double"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """(source, source_nth, source_size, target) from (source, source_size): one
    row a source, ordered by code points, null last."""
    named = sizes.select("source", F.col("source").isNull().alias("no_name"), "source_size")
    table = numbered(named, "mix-sources", "no_name", "source")
    by_turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                           (F.col("nth") % len(weights) + 1).cast("int"))
    table = written(table.select("source", F.col("nth").alias("source_nth"), "source_size",
                                 by_turn.alias("weight"),
                                 (F.col("source_size") * most).cast("double").alias("limit")), "mix-weights")
    wanted = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    each = 0.0  # words for each unit of weight; grows until no source is above its limit
    while True:
        above = F.col("weight") * each > F.col("limit")
        free = F.when(~above, F.col("weight")).otherwise(0.0)
        held = F.when(above, F.col("limit")).otherwise(0.0)
        left, full, n = table.agg(F.sum(free), F.sum(held), F.sum(above.cast("long"))).first()
        before, each = each, (wanted - full) / left if left else each
        if not left or each <= before:
            break
    return table.select("source", "source_nth", "source_size",
                        F.least(F.col("weight") * each, F.col("limit")).alias("target"))


def pivot(sizes: np.ndarray, parts: np.ndarray, draws: np.ndarray, last: bool) -> np.ndarray:
    """Fractions after pivotal rounding in the given order: 0 or 1 but for one at
    most, which is rounded to the nearer end if ``last``. The sum of
    ``sizes * parts`` is kept up to that."""
    done = parts.astype(float).copy()
    held = -1  # the one fraction that is open
    for i in range(len(done)):
        if held < 0:
            held = i
            continue
        a, b, x, y = float(sizes[held]), float(sizes[i]), done[held], done[i]
        up = min((1 - x) * a, y * b)      # words that can go from i to held
        down = min(x * a, (1 - y) * b)    # and from held to i
        if draws[i] * (up + down) < down:
            gives, takes, moved = i, held, up
        else:
            gives, takes, moved = held, i, down
        # the one that reaches its end first gets it exactly
        ends = done[gives] * sizes[gives] <= (1 - done[takes]) * sizes[takes]
        if ends:
            done[takes] += moved / sizes[takes]
            done[gives] = 0.0
            held = takes
        else:
            done[gives] -= moved / sizes[gives]
            done[takes] = 1.0
            held = gives
        if done[held] <= 0.0 or done[held] >= 1.0:  # both reached an end
            done[held] = min(max(done[held], 0.0), 1.0)
            held = -1
    if last and held >= 0:
        done[held] = float(done[held] >= 0.5)
    return done


def _rounded(width: int, level: int, last: bool):
    def group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "nth"], ascending=[False, True], kind="stable", ignore_index=True)
        rng = np.random.default_rng([SEED, level, int(rows["source_nth"][0]), int(rows["nth"].min()) // width])
        done = pivot(rows["size"].to_numpy(), rows["open"].to_numpy(), rng.random(len(rows)), last)
        whole = (done == 0.0) | (done == 1.0)
        rows["copies"] = rows["copies"] + np.where(whole, done, 0.0).astype("int32")
        rows["open"] = np.where(whole, np.nan, done)
        return rows
    return group


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
           id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           group: int = GROUP, fan: int = FAN) -> DataFrame:
    """(doc_id, size, source_size, target, copies) for each document."""
    spark = docs.sparkSession
    workers_import_package(spark)
    text = F.col(text_col).cast("string")
    content = F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    base = written(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        n_words(text).alias("size"), F.xxhash64(F.col(id_col), content).alias("key"), content.alias("content")),
        "mix-documents")
    goals = targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share)
    goals = goals.withColumnRenamed("source", "of")
    goals = F.broadcast(goals) if broadcast_fits(goals, 1_000_000) else goals
    rows = (base.join(goals, F.col("source").eqNullSafe(F.col("of")))
            .withColumn("row", F.monotonically_increasing_id()))
    rows = numbered(rows, "mix-order", "source_nth", "key", "content", "doc_id", "row")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    part = each - F.floor(each)
    schema = _STATE.format(id=base.schema["doc_id"].dataType.simpleString())
    state = rows.select(
        "source_nth", "nth", "doc_id", "size", "source_size", "target", F.floor(each).cast("int").alias("copies"),
        F.when((F.col("size") > 0) & (part > 0), part).alias("open"))
    total = rows.agg(F.max("nth")).first()[0]
    width, level, done = group, 0, []
    if total is None:
        return state.drop("source_nth", "nth", "open")
    while True:
        last = width > total
        # what is whole already needs no group
        done.append(state.where("open IS NULL"))
        state = written(state.where("open IS NOT NULL")
                        .groupBy("source_nth", F.floor(F.col("nth") / width))
                        .applyInPandas(_rounded(width, level, last), schema), "mix-rounded")
        if last:
            break
        width, level = width * fan, level + 1
    out = state
    for d in done:
        out = out.unionByName(d)
    return out.select("doc_id", "size", "source_size", "target", "copies")


def mix(docs: DataFrame, **options) -> DataFrame:
    """``copies`` with ``taken``, the words that the mix takes of a document."""
    return copies(docs, **options).withColumn("taken", F.col("size") * F.col("copies"))
