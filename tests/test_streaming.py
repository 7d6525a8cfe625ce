"""The counter stream equals the batch rollup, survives restarts, and a
replayed batch does not double-count."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from weblens.operators import orders as o
from weblens.sinks import counters
from weblens.sources import derived as d
from weblens.streaming import orders as s

from conftest import SF_SMALL, rows


def _messages(spark):
    return d.order_messages(d.read_table(spark, SF_SMALL, "events"))


def _batch_totals(spark, msgs):
    return rows(o.order_rollup(o.parse_orders(msgs)))


def test_stream_restart_equals_batch(spark, tmp_path):
    msgs = _messages(spark).orderBy("value").cache()
    half_a = msgs.limit(400)
    half_b = msgs.subtract(half_a)
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    half_a.coalesce(2).write.mode("append").text(src)

    def run():
        stream = s.read_messages(spark, "text", path=src, max_per_trigger=1)
        q = s.start_order_counters(stream, out, ckpt, trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None

    run()
    assert rows(s.read_totals(spark, out)) == _batch_totals(spark, half_a)
    half_b.coalesce(3).write.mode("append").text(src)  # new input while stopped
    run()                                              # restart on the same checkpoint
    assert rows(s.read_totals(spark, out)) == _batch_totals(spark, msgs)
    run()                                              # nothing new: nothing changes
    assert rows(s.read_totals(spark, out)) == _batch_totals(spark, msgs)


def _parsed(spark, msgs):
    return o.parse_orders(msgs.withColumn("arrival", F.current_timestamp()), keep=["value", "arrival"])


def test_replayed_batch_is_idempotent(spark, tmp_path):
    out = str(tmp_path / "out")
    msgs = _messages(spark)
    write = s.count_batch(out)
    write(_parsed(spark, msgs.limit(300)), 0)
    first = rows(s.read_totals(spark, out))
    write(_parsed(spark, msgs), 1)
    after = rows(s.read_totals(spark, out))
    dead = s.read_batches(spark, f"{out}_dead", "value STRING").count()
    write(_parsed(spark, msgs), 1)  # the same batch again, as after a failure
    assert rows(s.read_totals(spark, out)) == after != first
    assert s.read_batches(spark, f"{out}_dead", "value STRING").count() == dead
    total = sum(r[1] for r in first) + sum(r[1] for r in _batch_totals(spark, msgs))
    assert sum(r[1] for r in after) == total


def test_a_batch_that_fails_half_way_is_counted_once(spark, tmp_path):
    out = str(tmp_path / "out")
    deltas = "stat_key string, field string, value long, day string"
    counters.add_counters(spark.createDataFrame([("a", "", 1, "20240101"), ("b", "", 1, "20240102")], deltas), out, 0)
    # batch 1 published one of its two days before it failed
    counters.add_counters(spark.createDataFrame([("a", "", 5, "20240101")], deltas), out, 1)
    counters.add_counters(spark.createDataFrame([("a", "", 5, "20240101"), ("b", "", 7, "20240102")], deltas), out, 1)
    assert rows(counters.read_counters(spark, out), "stat_key", "value") == [("a", 6), ("b", 8)]


def test_folders_are_bounded_by_days(spark, tmp_path):
    out = str(tmp_path / "out")
    deltas = "stat_key string, field string, value long, day string"
    for i in range(6):
        counters.add_counters(spark.createDataFrame(
            [("k", "", 1, "20240101"), (f"x{i}", "f", 2, "20240102" if i % 2 else "20240103")], deltas), out, i)
    assert counters.add_counters(spark.createDataFrame([], deltas), out, 9) == []
    folders = {day: sorted(os.listdir(os.path.join(out, day))) for day in os.listdir(out) if day.startswith("day=")}
    assert folders == {"day=20240101": ["v=4", "v=5"], "day=20240102": ["v=3", "v=5"], "day=20240103": ["v=2", "v=4"]}
    got = rows(counters.read_counters(spark, out), "stat_key", "value")
    assert got == [("k", 6)] + [(f"x{i}", 2) for i in range(6)]


def test_only_touched_days_are_written(spark, tmp_path):
    out = str(tmp_path / "out")
    s.count_batch(out)(_parsed(spark, _messages(spark)), 0)
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{out}/day=*/v=0/*.parquet")}
    late = spark.createDataFrame([('{"time":"20240105101010","flag":"1","fee":"3"}',)], "value string")
    s.count_batch(out)(_parsed(spark, late), 1)
    assert sorted(glob.glob(f"{out}/day=*/v=1")) == [f"{out}/day=20240105/v=1"]
    assert all(os.path.getmtime(p) == t for p, t in before.items())


def test_prefixes_and_named_counters(spark, tmp_path):
    msgs = spark.createDataFrame([('{"time":"20240105101010","flag":"1","fee":"3"}',),
                                  ('{"time":"20240105","flag":"1","fee":"4"}',)], "value string")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    s.count_batch(a, daily=True, prefixes=("n:", "sum:"))(_parsed(spark, msgs), 0)
    assert rows(s.read_daily_counters(spark, a)) == [("n:20240105", 2), ("sum:20240105", 7)]
    s.count_batch(b, prefix="paid:")(_parsed(spark, msgs), 0)
    assert rows(s.read_totals(spark, b, "paid:")) == [("20240105", 1, 1, 3), ("2024010510", 1, 1, 3)]
    assert rows(s.read_hash_counters(spark, b).where("field = 'fee'"), "stat_key", "value") == [
        ("paid:20240105", 3), ("paid:2024010510", 3)]


def test_an_unreadable_counter_table_fails(spark, tmp_path):
    out = str(tmp_path / "out")
    s.count_batch(out)(_parsed(spark, _messages(spark)), 0)
    for p in glob.glob(f"{out}/day=*/v=0/*.parquet"):
        with open(p, "wb") as f:
            f.write(b"not parquet")
        crc = os.path.join(os.path.dirname(p), f".{os.path.basename(p)}.crc")
        os.path.exists(crc) and os.remove(crc)
    with pytest.raises(Exception, match="(?i)parquet"):
        s.read_totals(spark, out).collect()
    with pytest.raises(Exception, match="(?i)parquet"):
        s.count_batch(out)(_parsed(spark, _messages(spark)), 1)


def test_events_stream_and_counter_views(spark):
    path = s.run_order_counters_from_events(spark, SF_SMALL)
    totals = s.read_totals(spark, path)
    assert rows(totals) == _batch_totals(spark, _messages(spark))
    one = s.read_counter(s.read_hash_counters(spark, path), "order-20240101")
    assert sorted(r.field for r in one.collect()) == ["fee", "success", "total"]
    dead = s.read_batches(spark, f"{path}_dead", "value STRING").count()
    assert dead == o.parse_orders(_messages(spark)).where("NOT valid").count() > 0


ORDER = '{"time":"%s","flag":"1","fee":"%d"}'


def _arriving(spark, orders):
    df = spark.createDataFrame([(ORDER % (t, fee), a) for t, fee, a in orders], "value string, a string")
    return o.parse_orders(df.select("value", F.to_timestamp("a").alias("arrival")), keep=["value", "arrival"])


def test_a_time_in_the_future_makes_no_order_late(spark, tmp_path):
    out = str(tmp_path / "out")
    batch = _arriving(spark, [("20240110100000", 1, "2024-01-10 10:00:05"), ("20990101000000", 2, "2024-01-10 10:01:00"),
                              ("20240110103000", 4, "2024-01-10 10:31:00")])
    write = s.count_batch(out, watermark="1 hour")
    write(batch, 0)
    write(_arriving(spark, [("20240110105900", 8, "2024-01-10 12:00:00")]), 1)  # just in time
    got = {r.stat_key: (r.total, r.fee) for r in s.read_totals(spark, out).collect()}
    assert got["20240110"] == (3, 13) and got["2024011010"] == (3, 13) and got["20990101"] == (1, 2)
    assert s.read_batches(spark, f"{out}_late", "stat_key STRING").count() == 0


def test_late_orders_are_accounted_by_level(spark, tmp_path):
    out = str(tmp_path / "out")
    write = s.count_batch(out, watermark="1 hour")
    batch = _arriving(spark, [("20240110105900", 8, "2024-01-10 12:00:01"),   # late for its hour only
                              ("20240109235959", 16, "2024-01-11 01:00:01"),  # late for both
                              ("20240110115900", 32, None)])                  # no arrival: never late
    write(batch, 0)
    write(batch, 0)
    got = {r.stat_key: (r.total, r.fee) for r in s.read_totals(spark, out).collect()}
    assert got == {"20240110": (2, 40), "2024011011": (1, 32)}
    late = s.read_batches(spark, f"{out}_late", "stat_key STRING, value STRING")
    assert rows(late, "stat_key") == [("20240109",), ("2024010923",), ("2024011010",)]


def test_watermark_by_the_files_arrival(spark, tmp_path):
    src = str(tmp_path / "src")
    _messages(spark).write.text(src)  # orders of 2024, files of now
    stream = s.read_messages(spark, "text", path=src, with_arrival=True)
    q = s.start_order_counters(stream, str(tmp_path / "out"), str(tmp_path / "ck"),
                               trigger={"availableNow": True}, watermark="2 hours")
    q.awaitTermination()
    late = s.read_batches(spark, str(tmp_path / "out_late"), "stat_key STRING")
    want = _batch_totals(spark, _messages(spark))
    assert late.count() == sum(r[1] for r in want)
    assert s.read_totals(spark, str(tmp_path / "out")).count() == 0


def test_stream_reports_quality_metrics(spark, tmp_path):
    src = str(tmp_path / "src")
    bad = spark.createDataFrame([('{"time": "2019", "flag": "1", "fee": "1"}',),
                                 ('{"time": "20190130101010", "flag": "1", "fee": "x"}',),
                                 ("not json",)], "value string")
    bad.write.text(src)
    q = s.start_order_counters(s.read_messages(spark, "text", path=src), str(tmp_path / "o"),
                               str(tmp_path / "c"), trigger={"availableNow": True})
    q.awaitTermination()
    metrics = [p["observedMetrics"].get("order_quality") for p in q.recentProgress
               if p.get("observedMetrics")]
    assert metrics and metrics[0]["rows"] == 3
    assert metrics[0]["bad_time"] == 2 and metrics[0]["bad_fee"] == 1


def test_processing_time_trigger(spark, tmp_path):
    src = str(tmp_path / "src")
    _messages(spark).write.text(src)
    q = s.start_order_counters(s.read_messages(spark, "text", path=src), str(tmp_path / "o"),
                               str(tmp_path / "c"), trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert rows(s.read_totals(spark, str(tmp_path / "o"))) == _batch_totals(spark, _messages(spark))


def test_late_order_lands_on_its_day(spark, tmp_path):
    import json
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))

    def send(*msgs):
        spark.createDataFrame([(json.dumps(m),) for m in msgs], "value string").write.mode("append").text(src)

    def run():
        q = s.start_order_counters(s.read_messages(spark, "text", path=src), out, ckpt,
                                   trigger={"availableNow": True})
        q.awaitTermination()

    send({"time": "20240110120000", "flag": "1", "fee": "5"})
    run()
    send({"time": "20231201080000", "flag": "1", "fee": "7"},   # a month late
         {"time": "20240110130000", "flag": "0", "fee": "9"})
    run()
    got = {r.stat_key: (r.total, r.success, r.fee) for r in s.read_totals(spark, out).collect()}
    assert got["20231201"] == (1, 1, 7) and got["2023120108"] == (1, 1, 7)
    assert got["20240110"] == (2, 1, 5)
