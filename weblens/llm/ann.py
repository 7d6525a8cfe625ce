"""Nearest neighbours by an inverted multi-index.

Two codebooks quantise the halves of a vector separately, so ``CENTROIDS``
squared cells hold the vectors. For a query the cells are visited in order of
the summed distance of its halves to the two centroids, by a heap over pairs,
until the visited cells hold ``CANDIDATES`` distinct vectors or the share
``SHARE`` of them, whichever is more; these are ranked by exact distance. The codebooks are fitted by k-means on a bounded
sample of ``SAMPLE`` expected vectors taken by a hash of the id; every vector is
indexed.

Equal vectors are indexed once with their ``k`` + 1 smallest ids, which are all
that any result can need, and equal queries are searched once, so one vector
that a third of all rows hold makes no hot cell. The cells of one first centroid
are searched together, and split into blocks where they hold many vectors; a
task group ranks one such block for at most about ``QUERIES`` queries.

Defined results: vectors that are null, zero, hold null or non-finite
components or have another dimension than most take no part, as candidate or
query; ties of distance go to the smaller id; a query has all candidates if
there are fewer than ``k``; a repeated row counts once, as query and as
candidate; an id with several vectors is searched for and found by each of
them, at its least distance, once in a result, and never for a query of that
id; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, shuffle_partitions, workers_import_package, written

CENTROIDS = 128
CANDIDATES = 6000
#: Share of the distinct vectors that a query looks at, if that is more. Near
#: neighbours of vectors without clusters are spread over many cells: on
#: uniform ones of 64 components this share finds 0.93 of them.
SHARE = 0.35
SAMPLE = 20_000
#: Distinct vectors of one first centroid that one task group ranks.
BLOCK = 4000
#: Distinct queries of one task group, about.
QUERIES = 4000


def _valid(dimension):
    def run(batches):
        for batch in batches:
            ids, vecs = [], []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
                if i is None or not v or None in v or (dimension and len(v) != dimension):
                    continue
                x = np.asarray(v, np.float64) + 0.0  # no negative zero
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    vecs.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary())],
                                             ["vec_id", "vec"])
    return run


def kmeans(x: np.ndarray, k: int, steps: int = 12, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    if len(x) <= k:
        return x
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(steps):
        near = _distances(x, centres).argmin(axis=1)
        n = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, x[:, d], k) for d in range(x.shape[1])], axis=1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(1, n)[:, None], centres)
    return centres


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1))


def traverse(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Non-empty cells in order of summed distance until they hold ``wanted``
    vectors. ``sizes``: vectors of cell i * len(second) + j."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, out, held = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(second) + int(b[j])
        if sizes[cell]:
            out.append(cell)
            held += int(sizes[cell])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (first[a[p]] + second[b[q]], p, q))
    return out


def _assign(books):
    def run(batches):
        one, two = books.value
        half = one.shape[1]
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack([np.frombuffer(v) for v in batch.column("vec").to_pylist()])
            cell = (_distances(x[:, :half], one).argmin(1) * len(two)
                    + _distances(x[:, half:], two).argmin(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.astype(np.int32)), batch.column("vec"), batch.column("ids")],
                ["cell", "vec", "ids"])
    return run


def _visits(books, sizes, blocks, wanted):
    """(first, block, vec, seconds): the cells of each query by first centroid."""
    def run(batches):
        one, two = books.value
        held, parts = sizes.value, blocks.value
        half = one.shape[1]
        for batch in batches:
            firsts, part, row, seconds = [], [], [], []
            for i, v in enumerate(batch.column("vec").to_pylist()):
                x = np.frombuffer(v)
                visited: dict[int, list[int]] = {}
                for cell in traverse(((x[:half] - one) ** 2).sum(1), ((x[half:] - two) ** 2).sum(1),
                                     held, wanted):
                    visited.setdefault(cell // len(two), []).append(cell % len(two))
                for first, second in visited.items():
                    for b in range(parts[first]):
                        firsts.append(first)
                        part.append(b)
                        row.append(i)
                        seconds.append(second)
            yield pa.RecordBatch.from_arrays(
                [pa.array(firsts, pa.int32()), pa.array(part, pa.int32()),
                 batch.column("vec").take(pa.array(row, pa.int64())),
                 pa.array(seconds, pa.list_(pa.int32()))], ["first", "block", "vec", "seconds"])
    return run


def _rank(k):
    def run(key, queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        out = {"query": [], "vec_id": [], "score": []}
        if len(queries) and len(entries):
            x = np.stack([np.frombuffer(v) for v in entries["vec"]])
            second, ids = entries["second"].to_numpy(), entries["ids"].to_numpy()
            known = np.concatenate(ids)
            most = k + len(known) - len(np.unique(known))  # ids of several vectors count once
            for start in range(0, len(queries), 256):
                part = queries.iloc[start:start + 256]
                q = np.stack([np.frombuffer(v) for v in part["vec"]])
                rough = _distances(q, x)
                for name, own, d, cells in zip(part["query"], q, rough, part["seconds"]):
                    at = np.flatnonzero(np.isin(second, cells))
                    if len(at) > most + 1:  # with a margin for the rounding of rough distances
                        limit = np.partition(d[at], most)[most]
                        at = at[d[at] <= limit + 1e-6 * (1 + limit + own @ own)]
                    exact = np.sqrt(((x[at] - own) ** 2).sum(axis=1))
                    least: dict[int, float] = {}
                    for s, e in zip(exact, at):
                        for i in ids[e]:
                            least[i] = min(s, least.get(i, s))
                    best = heapq.nsmallest(k + 1, ((s, i) for i, s in least.items()))
                    out["query"].extend([name] * len(best))
                    out["score"].extend(b[0] for b in best)
                    out["vec_id"].extend(b[1] for b in best)
        return pd.DataFrame(out)
    return run


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id",
            vec_col: str = "embedding", centroids: int = CENTROIDS,
            candidates: int = CANDIDATES, share: float = SHARE, group: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows found for
    each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    workers_import_package(spark)
    raw = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                         F.col(vec_col).cast("array<double>").alias("v"))
    common = (raw.where("v is not null").groupBy(F.size("v").alias("d"))
              .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first())
    rows = written(map_arrow(raw, _valid(common["d"] if common else 0), "vec_id long, vec binary")
                   .distinct(), "ann-rows")
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    place = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / (1 << 30)
    sample = rows.where(place < min(1.0, SAMPLE / total)).toArrow().sort_by("vec_id")
    if not len(sample):
        sample = rows.limit(1).toArrow()
    x = np.stack([np.frombuffer(v) for v in sample["vec"].to_pylist()])
    half = x.shape[1] // 2
    books = spark.sparkContext.broadcast((kmeans(x[:, :half], centroids), kmeans(x[:, half:], centroids)))

    # the k + 1 smallest ids of each vector: limited in the map tasks already
    smallest = Window.partitionBy("vec").orderBy("vec_id")
    entries = (rows.withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1)
               .groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    index = written(map_arrow(entries, _assign(books), "cell int, vec binary, ids array<long>"),
                    "ann-index")
    cells = len(books.value[0]) * len(books.value[1])
    sizes = np.zeros(cells, np.int64)
    for r in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # one row for a cell
        sizes[r["cell"]] = r["n"]
    seconds = len(books.value[1])
    parts = np.maximum(1, -(-sizes.reshape(-1, seconds).sum(axis=1) // BLOCK))
    wanted = max(candidates, int(share * sizes.sum()))
    held, blocks = spark.sparkContext.broadcast(sizes), spark.sparkContext.broadcast(parts)

    queries = rows.where(F.col("vec_id") % every == 0)
    # by an expression of its own, which AQE does not coalesce: few queries are work for all tasks
    wanted_by = (queries.select("vec").distinct()
                 .repartition(shuffle_partitions(spark), F.xxhash64("vec")))
    visits = map_arrow(wanted_by, _visits(books, held, blocks, wanted),
                       "first int, block int, vec binary, seconds array<int>")
    groups = max(1, -(-queries.count() // group))
    name = F.unhex(F.md5("vec"))  # 128 bits stand for the vector where results are merged
    visits = visits.withColumn("part", F.pmod(F.xxhash64("vec"), F.lit(groups)).cast("int")) \
        .withColumn("query", name)
    first = F.floor(F.col("cell") / seconds).cast("int")
    split = F.element_at(F.array(*(F.lit(int(n)) for n in parts)), first + 1)
    entries = index.select(first.alias("first"), (F.col("cell") % seconds).alias("second"), "vec", "ids",
                           F.pmod(F.xxhash64("vec"), split).cast("int").alias("block"),
                           F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    at = ["first", "block", "part"]
    found = (visits.groupBy(*at).cogroup(entries.groupBy(*at))
             .applyInPandas(_rank(k), "query binary, vec_id long, score double")
             .groupBy("query", "vec_id").agg(F.min("score").alias("score")))
    best = Window.partitionBy("query").orderBy("score", "vec_id")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    pairs = (queries.select(F.col("vec_id").alias("query_id"), name.alias("query")).join(found, "query")
             .where("vec_id != query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score")))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
