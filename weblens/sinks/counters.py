"""A written counter table that micro-batches add to (K5, K6, T5).

The original incremented counters in a key-value store; a retried task or a
replayed batch counted twice. Here a batch's deltas are added to the counters of the
days that it touches, and only these days are written again, as a new
version: ``day=<day>/v=<batch id>``. A version is made from the newest one *below* it, so a
replayed batch writes the same rows into the same folder. Readers take a day's
newest version. A day keeps its newest two versions (the older one for readers that
listed it, and for a replay), so the folders are bounded by the days, whatever
the number of batches.

Batch ids come from the stream's checkpoint: a counter table belongs to one
checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import clear_path, list_path, path_exists

COUNTER_DDL = "stat_key STRING, field STRING, value LONG, day STRING, v LONG"
KEPT_VERSIONS = 2


def read_counters(spark: SparkSession, path: str, days: list[str] | None = None,
                  below: int | None = None) -> DataFrame:
    """Counters ``stat_key, field, value, day`` by each day's newest version
    (of those below ``below``); named counters have the field ``''``."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], COUNTER_DDL).drop("v")
    rows = spark.read.schema(COUNTER_DDL).parquet(path)
    if days is not None:
        rows = rows.where(F.col("day").isin(days))  # prunes the folders
    if below is not None:
        rows = rows.where(F.col("v") < below)
    newest = rows.groupBy("day").agg(F.max("v").alias("v"))
    return rows.join(newest, ["day", "v"]).select("stat_key", "field", "value", "day")


def add_counters(deltas: DataFrame, path: str, version: int) -> list[str]:
    """Add ``deltas`` (stat_key, field, value, day) as ``version``; returns the
    days written. Deltas are a few rows a day, computed once."""
    spark = deltas.sparkSession
    first = not path_exists(spark, path)
    held = deltas.select("stat_key", "field", "value", "day").persist()
    try:
        days = sorted(r["day"] for r in held.select("day").distinct().collect())
        if not days:
            return []
        rows = read_counters(spark, path, days, below=version).unionByName(held)
        # dealt by day once: the sums and the day's file need no other shuffle
        (rows.repartition("day").groupBy("day", "stat_key", "field").agg(F.sum("value").alias("value"))
             .withColumn("v", F.lit(version).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("day", "v").parquet(path))
    finally:
        held.unpersist()
    for day in [] if first else days:
        versions = sorted(int(name[2:]) for name in list_path(spark, f"{path}/day={day}")
                          if name.startswith("v="))
        for old in versions[:-KEPT_VERSIONS]:
            clear_path(spark, f"{path}/day={day}/v={old}")
    return days
