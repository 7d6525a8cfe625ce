"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import os
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows of the labelled tables used for training: four of five remainders.
FOLDS, HELD_OUT_FOLD = 5, 0


def workers_import_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (a shared mount, or local mode). With ``--py-files`` this adds nothing."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, PACKAGE_ROOT])


def map_arrow(df: DataFrame, func: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose workers can import this package, and give back what
    their largest slice took: they stay for the next task."""
    workers_import_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from func(batches)
        free_memory()
    return df.mapInArrow(run, schema)


def free_memory() -> None:
    """Give free memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not this C library


#: Seconds that ``written`` waits at most for a plan to be let go.
LET_GO = 15.0


def written(df: DataFrame, name: str, let_go: bool = False) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back: the
    lineage is cut and the rows survive the loss of any executor. The folder
    is removed when the driver's JVM ends. ``let_go``: return only when the
    plan that was run is gone, so that its shuffle files are not on disk
    together with the next ones; set it where they are large."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    # a copy: ``df`` itself, which the caller holds, never runs and keeps no shuffle
    copy = df.select("*")
    plan = spark._jvm.java.lang.ref.WeakReference(copy._jdf)
    copy.write.parquet(path)
    del copy
    remove_on_exit(spark, path)
    drop_unused_shuffles(spark)
    if let_go:
        until_gone(spark, plan)
    return spark.read.schema(df.schema).parquet(path)


def drop_unused_shuffles(spark: SparkSession) -> None:
    """Shuffle files go when the driver's JVM collects the plans that made
    them; after a written table nothing refers to those below it."""
    gc.collect()
    spark._jvm.System.gc()


def until_gone(spark: SparkSession, plan) -> bool:
    """Wait until the object of a Java weak reference is collected. Python lets
    go of its plans in the background, after a second or more, so no fixed time
    is enough."""
    end = time.monotonic() + LET_GO
    while not plan.refersTo(None):
        if time.monotonic() > end:
            return False
        time.sleep(0.2)
        drop_unused_shuffles(spark)
    return True


def remove_on_exit(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column | str) -> Column:
    """True for documents whose crc32(doc_id as text) mod 5 is 0; a null id
    counts as the empty text (crc32 0), so it is held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS)) == HELD_OUT_FOLD


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, name: str, *order: str) -> DataFrame:
    """``df`` written in the order of ``order`` with ``nth``, a row's place from
    0. The sort is range-partitioned and only a count for each partition
    reaches the driver; end ``order`` with a unique column, so that no key is
    too large for a task."""
    spark = df.sparkSession
    rows = written(df.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
                   .withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    firsts = (rows.groupBy(part.alias("part")).agg(F.min("_at").alias("first"), F.count(F.lit(1)).alias("n"))
              .orderBy("part").collect())  # one row for each partition
    shifts, before = [], 0
    for r in firsts:
        shifts.append((r["part"], before - r["first"]))
        before += r["n"]
    table = spark.createDataFrame(shifts, "_part long, _shift long")
    return (rows.join(F.broadcast(table), part == F.col("_part"))
            .withColumn("nth", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift"))
