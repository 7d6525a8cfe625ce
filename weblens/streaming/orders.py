"""Streaming paid-order counters.

The original ran 5-second micro-batches over a message queue and added each
batch's per-day / per-hour deltas to external counters with increments - a
retried task or replayed batch double-counted, and nothing was checkpointed.

Here each micro-batch is reduced to its deltas and added to a written counter
table (``sinks.counters``), which a replayed batch leaves unchanged. The totals
live in that table, as in the original they lived outside the job, so the
stream keeps no state that a watermark would have to bound, and an order
of any age lands on its own day.

A micro-batch has two more outputs, each one folder a batch that a replay
rewrites: messages that cannot be counted (``dead``), and, with ``watermark``, orders
that came too late (``late``). Lateness is judged for every order and level by
its own arrival: late is what arrives more than the watermark after the end
of its hour (or day). No other order's time matters, so one with a time
in the future makes no other late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import orders as o
from ..session import scratch_path
from ..sinks.counters import add_counters, read_counters
from ..sources import derived as d

def read_messages(spark: SparkSession, fmt: str, options: dict[str, str] | None = None,
                  path: str | None = None, schema=None, max_per_trigger: int | None = None,
                  with_arrival: bool = False) -> DataFrame:
    """An unbounded DataFrame with the message text in ``value``.

    ``kafka``: ``subscribe``/``kafka.bootstrap.servers`` come in ``options``;
    start at the latest offsets unless told otherwise, as the original did.
    File formats read ``path``. ``max_per_trigger`` bounds one micro-batch
    (offsets for Kafka, files otherwise) so a restart after downtime works
    through the backlog in steps instead of one huge batch; nothing is
    dropped. ``with_arrival`` adds when a message arrived (the queue's own
    time stamp, or the file's)."""
    opts = dict(options or {})
    reader = spark.readStream.format(fmt)
    if max_per_trigger:
        key = "maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger"
        opts.setdefault(key, str(max_per_trigger))
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "latest")
        cols = [F.col("timestamp").alias("arrival")] if with_arrival else []
        return reader.options(**opts).load().select(F.col("value").cast("string").alias("value"), *cols)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.options(**opts).load(path)
    return rows.withColumn("arrival", F.col("_metadata.file_modification_time")) if with_arrival else rows


def running_totals(messages: DataFrame, daily: bool = False) -> DataFrame:
    """Messages -> ``total, success, fee`` per day and day+hour key (T4), on a
    stream as one stateful aggregation. With ``daily`` only day keys, for
    every order whose day is known (T3)."""
    parsed = o.observe_quality(o.parse_orders(messages))
    keyed = o.day_keys(parsed) if daily else o.stat_keys(parsed)
    return keyed.groupBy("stat_key").agg(F.sum("total").alias("total"), F.sum("success").alias("success"),
                                         F.sum("fee_paid").alias("fee"))


def _period_end():
    """The end of the period that a ``stat_key`` (day, or day and hour) stands for."""
    hourly = F.length("stat_key") == 10
    start = F.try_to_timestamp(F.rpad("stat_key", 10, "0"), F.lit("yyyyMMddHH"))
    return start + F.when(hourly, F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 24 HOURS"))


def _deltas(keyed: DataFrame, daily: bool, prefixes: tuple[str, str], prefix: str) -> DataFrame:
    """Counter rows of the keyed orders: named counters by day (K5), or the
    fields of a key's hash (K6)."""
    sums = (keyed.groupBy("stat_key").agg(F.sum("total").alias("total"), F.sum("success").alias("success"),
                                          F.sum("fee_paid").alias("fee")))
    day = F.substring("stat_key", 1, 8).alias("day")
    if daily:
        pairs = F.array(F.struct(F.lit(prefixes[0]).alias("p"), F.col("success").alias("value")),
                        F.struct(F.lit(prefixes[1]).alias("p"), F.col("fee").alias("value")))
        return sums.select("stat_key", day, F.explode(pairs).alias("c")).select(
            F.concat("c.p", "stat_key").alias("stat_key"), F.lit("").alias("field"), "c.value", "day")
    return (sums.select("*", day).unpivot(["stat_key", "day"], o.COUNTER_FIELDS, "field", "value")
            .select(F.concat(F.lit(prefix), "stat_key").alias("stat_key"), "field", "value", "day"))


def _rewrite(rows: DataFrame, path: str, batch_id: int) -> None:
    """The batch's own folder, only if it has rows; the same after a replay."""
    if not rows.isEmpty():
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def count_batch(counter_path: str, *, daily: bool = False, watermark: str | None = None,
                prefix: str = o.HASH_PREFIX, prefixes: tuple[str, str] = (o.COUNT_PREFIX, o.FEE_PREFIX),
                dead_path: str | None = None, late_path: str | None = None):
    """The ``foreachBatch`` function: parsed orders (with ``value`` and ``arrival``)
    -> counters, dead letters, late orders."""
    usable = F.col("valid_day") if daily else F.col("valid")

    def write(batch: DataFrame, batch_id: int) -> None:
        # three outputs of one read, as the original cached it; texts only where one needs them
        text = F.col("value") if watermark else F.when(~usable, F.col("value"))
        rows = batch.select(text.alias("value"), "arrival", "day", "hour", "flag", "fee_long",
                            "valid_day", "valid").persist()
        try:
            keep = ["value", "arrival"]
            keyed = o.day_keys(rows, keep) if daily else o.stat_keys(rows, keep)
            if watermark:
                late = F.coalesce(F.col("arrival") > _period_end() + F.expr(f"INTERVAL {watermark}"), F.lit(False))
                _rewrite(keyed.where(late).select("stat_key", *keep), late_path or f"{counter_path}_late", batch_id)
                keyed = keyed.where(~late)
            _rewrite(rows.where(~usable).select(*keep), dead_path or f"{counter_path}_dead", batch_id)
            add_counters(_deltas(keyed, daily, prefixes, prefix), counter_path, batch_id)
        finally:
            rows.unpersist()
    return write


def start_order_counters(messages: DataFrame, counter_path: str, checkpoint: str, *,
                         trigger: dict | None = None, name: str | None = None, **counting) -> StreamingQuery:
    """Start the counter query (T1, T2, T5, K5, K6). ``trigger`` defaults to
    5-second micro-batches; tests pass ``{"availableNow": True}``. The other
    arguments are those of ``count_batch``; ``watermark`` is an interval such as
    ``1 hour``, measured by the messages' ``arrival`` (or, without that column, the
    time of processing)."""
    arrival = F.col("arrival") if "arrival" in messages.columns else F.current_timestamp()
    parsed = o.parse_orders(messages.select("value", arrival.alias("arrival")), keep=["value", "arrival"])
    writer = (o.observe_quality(parsed).writeStream
              .option("checkpointLocation", checkpoint)
              .foreachBatch(count_batch(counter_path, **counting))
              .trigger(**(trigger or {"processingTime": "5 seconds"})))
    if name:
        writer = writer.queryName(name)
    return writer.start()


def read_totals(spark: SparkSession, counter_path: str, prefix: str = o.HASH_PREFIX) -> DataFrame:
    """``stat_key, total, success, fee`` from the written hash counters (K6)."""
    fields = [F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in o.COUNTER_FIELDS]
    return (read_counters(spark, counter_path).groupBy("stat_key").agg(*fields)
            .withColumn("stat_key", F.expr(f"substring(stat_key, {len(prefix) + 1})")))


def read_hash_counters(spark: SparkSession, counter_path: str) -> DataFrame:
    """The written hash counters ``stat_key, field, value`` (K6)."""
    return read_counters(spark, counter_path).drop("day")


def read_daily_counters(spark: SparkSession, counter_path: str) -> DataFrame:
    """The written named counters ``stat_key, value`` (K5)."""
    return read_counters(spark, counter_path).select("stat_key", "value")


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the dead letters or late orders of all batches, if there are any."""
    from ..session import path_exists
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_counter(counters: DataFrame, key) -> DataFrame:
    """Counter rows for one key, a list of keys, or a boolean condition."""
    if isinstance(key, str):
        return counters.where(F.col("stat_key") == key)
    if isinstance(key, (list, tuple, set)):
        return counters.where(F.col("stat_key").isin(list(key)))
    return counters.where(key)


def event_order_stream(spark: SparkSession, sf_dir: str, max_files: int = 1, messages=None) -> DataFrame:
    """Order messages streamed from the ``events`` parquet table (test source);
    ``messages`` makes them from the events (default ``derived.order_messages``)."""
    schema = d.read_table(spark, sf_dir, "events").schema
    events = read_messages(spark, "parquet", {"pathGlobFilter": "events.parquet",
                                              "maxFilesPerTrigger": str(max_files)},
                           path=sf_dir, schema=schema)
    return (messages or d.order_messages)(events)


def run_order_counters_from_events(spark: SparkSession, sf_dir: str, messages=None, **counting) -> str:
    """Run the counter stream to completion over the events table and return
    the path of the counters that it wrote."""
    counter_path = scratch_path(spark, "order-counters")
    q = start_order_counters(event_order_stream(spark, sf_dir, messages=messages), counter_path,
                             scratch_path(spark, "order-counters-ckpt"),
                             trigger={"availableNow": True}, **counting)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return counter_path
