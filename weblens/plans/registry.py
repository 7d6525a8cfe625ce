"""Runnable queries over the driver's test tables, one per inventory id.

Each takes ``(spark, sf_dir)`` and returns a DataFrame; inputs are derived
from ``events`` / ``nation`` by ``weblens.sources.derived`` so every query's
work grows with the tables. Sinks and streams write under the session's
checkpoint folder and return what they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ip as ipf
from ..functions.parse import format_time, is_not_blank, is_not_empty, rowkey, visit_key
from ..operators import agents, analytics, geo, orders, widetable
from ..session import materialize_sized, scratch_path
from ..sinks import tables
from ..sources import derived as d
from ..sources.files import load_ranges, load_rules, read_access_log
from ..streaming import orders as stream
from . import etl

DAY = "20240101"


def _events(spark, sf_dir):
    return d.read_table(spark, sf_dir, "events")


def _ranges(spark, sf_dir):
    return d.ip_ranges(d.read_table(spark, sf_dir, "nation"))


def _lines(spark, sf_dir, repeat_keys=False):
    return d.access_lines(_events(spark, sf_dir), repeat_keys=repeat_keys)


def _records(spark, sf_dir, repeat_keys=False):
    return etl.parsed_records(_lines(spark, sf_dir, repeat_keys))


def _ips(spark, sf_dir):
    return _events(spark, sf_dir).select(d.event_ip().alias("ip_long"))


def _wide(spark, sf_dir, dedup=True):
    return etl.wide_rows(_lines(spark, sf_dir, True), _ranges(spark, sf_dir), DAY,
                         tz="UTC", dedup=dedup)


def _orders(spark, sf_dir):
    return orders.parse_orders(d.order_messages(_events(spark, sf_dir)))


# --- sources --------------------------------------------------------------

def s1_read_access_log(spark, sf_dir):
    path = scratch_path(spark, "access-log")
    _lines(spark, sf_dir).write.text(path)
    return read_access_log(spark, path)


def s3_widetable_scan(spark, sf_dir):
    path = scratch_path(spark, "wide")
    tables.write_day(_wide(spark, sf_dir), path, DAY)
    return widetable.scan(spark, path, DAY, ["country", "province", "browsername"]).drop("rowkey")


def s5_load_ranges(spark, sf_dir):
    path = scratch_path(spark, "ranges")
    _ranges(spark, sf_dir).write.parquet(path)
    return load_ranges(spark, path)


def s6_load_rules(spark, sf_dir):
    # a rule table of our own, larger than the inline limit: one rule a page
    # kind of the log and the agents' first product, written and loaded back
    path = scratch_path(spark, "rules")
    rows = spark.range(1000).select(
        (F.col("id") + 100).cast("int").alias("priority"), F.lit("browser").alias("kind"),
        F.concat(F.lit("^curl/"), F.col("id").cast("string"), F.lit(r"\.([0-9.]+)")).alias("pattern"),
        F.concat(F.lit("curl "), F.col("id").cast("string")).alias("name"),
        F.lit(1).alias("version_group"))
    agents.default_rules(spark).where("name <> 'curl'").union(rows).write.json(path)
    rec = _records(spark, sf_dir)
    return agents.classify(rec, load_rules(spark, path), "ua").select("ua", *agents.UA_COLUMNS)


def s7_get_by_rowkey(spark, sf_dir):
    # point reads for the keys of the visits to one page group (a semi-join)
    wide = _wide(spark, sf_dir)
    visits = _records(spark, sf_dir, True).where(F.col("url").startswith("/purchase/"))
    keys = visits.select(rowkey(DAY).alias("rowkey"), visit_key().alias("visit"))
    return widetable.get(wide, keys).drop("event_ts")


def s7_point_read(spark, sf_dir):
    # the visits of one address, by their keys, from a clustered table
    path = scratch_path(spark, "wide")
    wide = _wide(spark, sf_dir)
    tables.write_day(wide, path, DAY, clustered=True, files=8)
    first = _records(spark, sf_dir, True).agg(F.min("ip")).first()[0]
    keys = [r[0] for r in wide.where(F.col("ip") == first).select("rowkey").distinct().collect()]
    return tables.get_rows(spark, path, keys)


def s8_cell_scan(spark, sf_dir):
    return widetable.to_cells(_wide(spark, sf_dir))


def s9_read_counter(spark, sf_dir):
    cnt = orders.counters(orders.order_rollup(_orders(spark, sf_dir)))
    return stream.read_counter(cnt, F.length("stat_key") == len(orders.HASH_PREFIX) + 8)


# --- parsing and scalar functions ----------------------------------------

def p1_parse_access_log(spark, sf_dir):
    return _records(spark, sf_dir)


def p1_rejects(spark, sf_dir):
    return etl.rejected_lines(_lines(spark, sf_dir))


def p1_one_pass(spark, sf_dir):
    # the whole job on written lines: both outputs of the one parse, by their sizes
    logs, out = scratch_path(spark, "access-log"), scratch_path(spark, "wide")
    _lines(spark, sf_dir, True).write.text(logs)
    counts = etl.run_etl(spark, logs, _ranges(spark, sf_dir), out, DAY, tz="UTC")
    wide = spark.read.schema(widetable.WIDE_SCHEMA).parquet(out)
    bad = spark.read.schema("value STRING").parquet(f"{out}_rejects")
    return (wide.agg(F.count(F.lit(1)).alias("stored")).select(
        "stored", F.lit(counts["lines"]).alias("lines"), F.lit(counts["good"]).alias("good"),
        bad.agg(F.count(F.lit(1))).scalar().alias("rejected")))


def p2_strip_quotes(spark, sf_dir):
    return _records(spark, sf_dir).select("method", "protocal", "referer")


def p3_user_agent(spark, sf_dir):
    return _records(spark, sf_dir).select("ua")


def p4_time_field(spark, sf_dir):
    return _records(spark, sf_dir).select("time")


def p5_format_time(spark, sf_dir):
    return _records(spark, sf_dir).select("time", format_time("time", "UTC").alias("formattime"))


def p6_blank_tests(spark, sf_dir):
    conv = d.read_table(spark, sf_dir, "conversations")
    return (conv.groupBy("role")
                .agg(F.sum(is_not_blank("text").cast("long")).alias("not_blank"),
                     F.sum(is_not_empty("text").cast("long")).alias("not_empty"),
                     F.count(F.lit(1)).alias("n")))


def p7_fill_unknown_geo(spark, sf_dir):
    rec = _records(spark, sf_dir)
    return geo.enrich_geo(rec, _ranges(spark, sf_dir), "ip", fill=True).select(
        "ip", "country", "province", "city")


def p8_ip_to_long(spark, sf_dir):
    return _records(spark, sf_dir).select("ip", ipf.ip_to_long("ip").alias("ip_long"))


def p9_long_to_ip(spark, sf_dir):
    return _ips(spark, sf_dir).select("ip_long", ipf.long_to_ip("ip_long").alias("ip"))


def p11_normalize_region(spark, sf_dir):
    rec = _records(spark, sf_dir)
    out = geo.enrich_geo(rec, _ranges(spark, sf_dir), "ip", fill=False)
    return out.select("ip", "country", "province", "city")


def p12_address(spark, sf_dir):
    return geo.locate_address(_ips(spark, sf_dir), _ranges(spark, sf_dir))


def p13_rowkey(spark, sf_dir):
    return _records(spark, sf_dir).select("url", "ip", rowkey(DAY).alias("rowkey"))


def p14_time_parts(spark, sf_dir):
    return _orders(spark, sf_dir).select("orderid", "day", "hour", "minute")


def p15_parse_orders(spark, sf_dir):
    return _orders(spark, sf_dir).select(*orders.ORDER_FIELDS, "fee_long")


def p16_paid_metric(spark, sf_dir):
    m = orders.paid_metrics(_orders(spark, sf_dir))
    return m.select("orderid", "day", "total", "success", F.col("fee_paid").alias("fee"))


def p19_line_geo_map(spark, sf_dir):
    maps = geo.line_geo_map(_lines(spark, sf_dir), _ranges(spark, sf_dir))
    # the map's entries, one row each, so the values can be compared
    return maps.select(F.explode("geo").alias("geo_key", "geo_value"))


def p20_classify_user_agent(spark, sf_dir):
    rec = _records(spark, sf_dir)
    return agents.classify(rec, None, "ua").select("ua", *agents.UA_COLUMNS)


def p20_rule_index(spark, sf_dir):
    """Agents of many shop clients, one rule for each of 10,000 clients before
    the default rules: answered through the index."""
    rec = _events(spark, sf_dir).select(F.concat(
        F.element_at(F.array(*[F.lit(u) for u in d.USER_AGENTS]),
                     (F.pmod(F.col("user_id"), F.lit(len(d.USER_AGENTS))) + 1).cast("int")),
        F.lit(" shop/"), F.col("user_id").cast("string"), F.lit("."),
        F.pmod(F.col("event_id"), F.lit(7)).cast("string")).alias("ua"))
    clients = spark.range(10_000).select(
        F.lit(1).alias("priority"), F.lit("browser").alias("kind"),
        F.concat(F.lit(" shop/"), F.col("id").cast("string"), F.lit(r"\.([0-9]+)$")).alias("pattern"),
        F.concat(F.lit("shop "), F.col("id").cast("string")).alias("name"), F.lit(1).alias("version_group"))
    rules = clients.union(agents.default_rules(spark))
    return agents.classify(rec, rules, "ua").select("ua", *agents.UA_COLUMNS)


def p21_encode_orders(spark, sf_dir):
    return orders.encode_orders(_orders(spark, sf_dir))


# --- joins and dimension queries ------------------------------------------

def j1_ip_range_join(spark, sf_dir):
    return geo.locate(_ips(spark, sf_dir), _ranges(spark, sf_dir), keep_range=True)


def j1_dense_range_join(spark, sf_dir):
    dense = d.dense_ip_ranges(d.read_table(spark, sf_dir, "orders"))
    return geo.locate(_ips(spark, sf_dir), dense, keep_range=True)


def j1_crowded_ranges(spark, sf_dir):
    crowded = d.crowded_ip_ranges(d.read_table(spark, sf_dir, "orders"))
    ips = _events(spark, sf_dir).select(d.crowded_event_ip().alias("ip_long"))
    return geo.locate(ips, crowded, keep_range=True)


def j2_rule_match_distinct(spark, sf_dir):
    rec = _records(spark, sf_dir)
    return agents.classify(rec, None, "ua", dedup=True).select("ua", *agents.UA_COLUMNS)


def j2_rule_match_cached(spark, sf_dir):
    # a cache filled from the same lines, as an earlier run would leave it
    rec = _records(spark, sf_dir)
    cache = scratch_path(spark, "ua-cache")
    agents.update_cache(rec, cache)
    return agents.classify_cached(rec, cache, None, "ua").select("ua", *agents.UA_COLUMNS)


def j3_distinct_ip_lookup(spark, sf_dir):
    return geo.locate(_ips(spark, sf_dir), _ranges(spark, sf_dir), dedup=True, keep_range=True)


def f1_find_ranges(spark, sf_dir):
    return geo.find_ranges(_ranges(spark, sf_dir), "省")


def f2_range_end_ips(spark, sf_dir):
    return geo.range_end_ips(_ranges(spark, sf_dir))


def f3_area_lookup(spark, sf_dir):
    return geo.area_of(_ips(spark, sf_dir), _ranges(spark, sf_dir))


# --- aggregations, reshaping ----------------------------------------------

def a1_top_regions(spark, sf_dir):
    return analytics.top_regions(_wide(spark, sf_dir), 10)


def a2_browser_counts(spark, sf_dir):
    return analytics.browser_counts(_wide(spark, sf_dir))


def a3_browser_counts_df(spark, sf_dir):
    return analytics.browser_counts(_wide(spark, sf_dir).select("browsername"))


def a4_browser_counts_sql(spark, sf_dir):
    return analytics.browser_counts_sql(spark, _wide(spark, sf_dir), "weblens_tmp")


def a5_upsert_latest(spark, sf_dir):
    return _wide(spark, sf_dir).drop("day", "event_ts")


def r8_report(spark, sf_dir):
    return analytics.report(_wide(spark, sf_dir), 10)["both"]


def r3_cells_to_rows(spark, sf_dir):
    cells = widetable.to_cells(_wide(spark, sf_dir))
    return widetable.from_cells(cells, widetable.WIDE_COLUMNS)


def r4_sorted_cells(spark, sf_dir):
    return widetable.sorted_cells(widetable.to_cells(_wide(spark, sf_dir)))


# --- sinks (written, then read back) ---------------------------------------

def k1_write_day(spark, sf_dir):
    path = scratch_path(spark, "wide")
    tables.write_day(_wide(spark, sf_dir), path, DAY)
    tables.write_day(_wide(spark, sf_dir), path, DAY)  # a rerun replaces the day
    return spark.read.schema(widetable.WIDE_SCHEMA).parquet(path)


def k3_bulk_write_cells(spark, sf_dir):
    path = scratch_path(spark, "cells")
    tables.bulk_write_cells(_wide(spark, sf_dir), path, DAY)
    return spark.read.parquet(path).drop("day")


def k2_cluster_day(spark, sf_dir):
    # a stored day rewritten for point reads holds the same rows
    path = scratch_path(spark, "wide")
    tables.write_day(_wide(spark, sf_dir), path, DAY)
    tables.cluster_day(spark, path, DAY, files=8)
    return spark.read.schema(widetable.WIDE_SCHEMA).parquet(path)


def k3_etl_cells(spark, sf_dir):
    # the whole job in its sorted-cells mode
    logs, out = scratch_path(spark, "access-log"), scratch_path(spark, "cells")
    _lines(spark, sf_dir, True).write.text(logs)
    etl.run_etl(spark, logs, _ranges(spark, sf_dir), out, DAY, tz="UTC", cells=True)
    return spark.read.parquet(out).drop("day")


def k3_raw_cells(spark, sf_dir):
    # every visit as it was logged, a version for each: hot rows have many cells
    path = scratch_path(spark, "cells")
    wide = _wide(spark, sf_dir, dedup=False)
    version = F.unix_timestamp("event_ts")
    tables.bulk_write_cells(widetable.to_cells(wide, columns=["status", "bytessent"], version=version), path, DAY)
    return spark.read.parquet(path).drop("day")


def k4_replace_day(spark, sf_dir):
    path = scratch_path(spark, "browser-stat")
    # counted once: each of the two writes would compute the day again
    stats, _, _ = materialize_sized(analytics.browser_stat_rows(_wide(spark, sf_dir), DAY))
    tables.replace_day(stats, path, DAY)
    tables.replace_day(stats, path, DAY)
    return spark.read.schema("browser STRING, cnt LONG, day STRING").parquet(path)


def _table_name(what):
    return f"weblens_{what}_{uuid.uuid4().hex[:8]}"


def k7_ensure_table(spark, sf_dir):
    name, path = _table_name("k7"), scratch_path(spark, "k7")
    schema = "browser STRING, cnt LONG"
    try:
        created = tables.ensure_table(spark, name, schema, path=path)
        analytics.browser_counts(_wide(spark, sf_dir)).write.insertInto(name)
        again = tables.ensure_table(spark, name, schema, path=path)
        stored = spark.table(name).count()
        replaced = tables.ensure_table(spark, name, schema, path=path, replace=True)
        left = spark.table(name).count()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.createDataFrame([(created, again, stored, replaced, left)],
                                 "created boolean, again boolean, stored long, replaced boolean, left_rows long")


def k8_describe(spark, sf_dir):
    # a table with the columns of each given table it is asked for
    found = []
    for source in ("nation", "events", "orders"):
        name = _table_name("k8")
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.read_table(spark, sf_dir, source).schema)
        try:
            tables.ensure_table(spark, name, schema, path=scratch_path(spark, "k8"))
            found += [(source, i, c) for i, c in enumerate(dict(tables.describe(spark))[name])]
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.createDataFrame(found, "source string, place int, column_name string")


def k9_put_cells(spark, sf_dir):
    path = scratch_path(spark, "put-cells")
    wide = _wide(spark, sf_dir)
    widetable.put_cells(widetable.to_cells(wide, version=1), path)
    # a second put of the same keys with a newer version overwrites the cell
    newer = wide.withColumn("status", F.lit("304"))
    widetable.put_cells(widetable.to_cells(newer, columns=["status"], version=2), path)
    return widetable.latest_cells(widetable.read_cells(spark, path))


# --- orders and streaming ---------------------------------------------------

def t1_micro_batches(spark, sf_dir):
    # the messages in several files, one a micro-batch; every batch adds to the counters
    path, out = scratch_path(spark, "messages"), scratch_path(spark, "order-counters")
    d.order_messages(_events(spark, sf_dir)).repartition(4, "value").write.text(path)
    q = stream.start_order_counters(stream.read_messages(spark, "text", path=path, max_per_trigger=1), out,
                                    scratch_path(spark, "order-counters-ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    return stream.read_totals(spark, out)


def t3_daily_paid(spark, sf_dir):
    return orders.daily_paid(_orders(spark, sf_dir))


def t4_order_rollup(spark, sf_dir):
    return orders.order_rollup(_orders(spark, sf_dir))


def t5_stream_order_counters(spark, sf_dir):
    return stream.read_totals(spark, stream.run_order_counters_from_events(spark, sf_dir))


def _delayed_messages(hours, far_future):
    """Order messages with their arrival, ``event_id % hours`` hours after the
    order; every 83rd carries a time of the year 2099."""
    def messages(events):
        ahead = F.pmod(F.col("event_id"), F.lit(83)) == 0
        sent = events.withColumn("_sent", F.col("ts"))
        if far_future:
            sent = sent.withColumn("ts", F.when(ahead, F.make_timestamp_ntz(
                F.lit(2099), F.month("ts"), F.lit(1), F.hour("ts"), F.minute("ts"), F.second("ts"))
                .cast(events.schema["ts"].dataType)).otherwise(F.col("ts")))
        delay = F.pmod(F.col("event_id"), F.lit(hours)).cast("int")
        arrival = (F.col("_sent").cast("timestamp_ntz") + F.make_interval(hours=delay)).cast("timestamp")
        return d.order_messages(sent.withColumn("arrival", arrival), ["arrival"])
    return messages


def t6_watermark_day_total(spark, sf_dir):
    # all arrive within 24 hours, some carry a time far ahead: every order counts
    path = stream.run_order_counters_from_events(
        spark, sf_dir, _delayed_messages(24, True), watermark="24 hours")
    return stream.read_totals(spark, path)


def t6_late_orders(spark, sf_dir):
    # with an hour allowed, some orders miss their hour (not their day); none is lost
    path = stream.run_order_counters_from_events(
        spark, sf_dir, _delayed_messages(5, False), watermark="1 hour")
    late = stream.read_batches(spark, f"{path}_late", "stat_key STRING, value STRING, arrival TIMESTAMP")
    counted = stream.read_totals(spark, path).select("stat_key", "total", F.lit("counted").alias("outcome"))
    return counted.union(late.groupBy("stat_key").agg(F.count(F.lit(1)).alias("total"))
                         .select("stat_key", "total", F.lit("late").alias("outcome")))


def s4_dead_letters(spark, sf_dir):
    path = stream.run_order_counters_from_events(spark, sf_dir)
    return stream.read_batches(spark, f"{path}_dead", "value STRING, arrival TIMESTAMP").select("value")


def k5_daily_counters(spark, sf_dir):
    return stream.read_daily_counters(spark, stream.run_order_counters_from_events(spark, sf_dir, daily=True))


def k6_counter_sink(spark, sf_dir):
    return stream.read_hash_counters(spark, stream.run_order_counters_from_events(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in list(globals().items())
    if callable(fn) and name[:1] in "spjfarkt" and "_" in name and name.split("_")[0][1:].isdigit()
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log ETL end to end: derived lines -> keyed, enriched wide rows."""
    return _wide(spark, sf_dir).drop("event_ts")
