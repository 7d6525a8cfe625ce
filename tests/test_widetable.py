"""Wide rows, last-write-wins, cells and their round trips."""

from pyspark.sql import functions as F

from weblens.operators import widetable as wt
from weblens.plans import etl
from weblens.sources import derived as d

from conftest import SF_SMALL, rows


def _wide(spark, dedup=True):
    ev = d.read_table(spark, SF_SMALL, "events")
    rg = d.ip_ranges(d.read_table(spark, SF_SMALL, "nation"))
    return etl.wide_rows(d.access_lines(ev, repeat_keys=True), rg, "20240101", tz="UTC", dedup=dedup)


def test_upsert_latest_keeps_one_row_per_key(spark):
    raw = _wide(spark, dedup=False)
    deduped = wt.upsert_latest(raw)
    assert deduped.count() == raw.select("rowkey").distinct().count()
    # the survivor is the latest write
    latest = raw.groupBy("rowkey").agg(F.max("event_ts").alias("m"))
    joined = deduped.join(latest, "rowkey")
    assert joined.where(F.col("event_ts") != F.col("m")).count() == 0


def test_upsert_tie_break_is_deterministic(spark):
    df = spark.createDataFrame(
        [("k", "2019-01-30 00:00:00", "200", "5"), ("k", "2019-01-30 00:00:00", "304", "1"),
         ("j", "2019-01-30 00:00:01", "200", "1"), ("j", "2019-01-30 00:00:00", "500", "9")],
        "rowkey string, event_ts string, status string, bytessent string")
    got = rows(wt.upsert_latest(df))
    assert got == [("j", "2019-01-30 00:00:01", "200", "1"), ("k", "2019-01-30 00:00:00", "304", "1")]


def test_cells_round_trip(spark):
    wide = _wide(spark).drop("event_ts", "day")
    cells = wt.to_cells(wide)
    assert cells.count() == wide.count() * len(wt.WIDE_COLUMNS)
    back = wt.from_cells(cells, wt.WIDE_COLUMNS)
    assert rows(back.select("rowkey", *wt.WIDE_COLUMNS)) == rows(wide.select("rowkey", *wt.WIDE_COLUMNS))


def test_to_cells_nulls_become_unknown(spark):
    df = spark.createDataFrame([("k1", None, "x")], "rowkey string, ip string, url string")
    got = rows(wt.to_cells(df, columns=["ip", "url"]))
    assert got == [("k1", "o", "ip", "unknown", 0), ("k1", "o", "url", "x", 0)]


def test_sorted_cells_and_get(spark):
    cells = wt.to_cells(_wide(spark))
    s = [tuple(r) for r in wt.sorted_cells(cells).select("rowkey", "qualifier").collect()]
    assert s == sorted(s)
    wide = _wide(spark)
    k = wide.select("rowkey").first()[0]
    assert wt.get(wide, k).count() == 1
    assert wt.get(wide, [k, "nope"]).count() == 1
    assert wt.get(wide, wide.select("rowkey").limit(3)).count() == 3


def test_multi_family_put_and_latest(spark, tmp_path):
    # one key, two families, as a column-family store test would write
    put = spark.createDataFrame(
        [("user1", "info", "age", "18", 1), ("user1", "info", "birthday", "1992-11-02", 1),
         ("user1", "info", "company", "ACME", 1), ("user1", "address", "country", "CN", 1),
         ("user1", "address", "province", "NMG", 1), ("user1", "address", "city", "TL", 1)],
        wt.CELL_SCHEMA)
    path = str(tmp_path / "cells")
    wt.put_cells(put, path)
    wt.put_cells(spark.createDataFrame([("user1", "info", "age", "19", 2)], wt.CELL_SCHEMA), path)
    latest = wt.latest_cells(wt.read_cells(spark, path))
    assert latest.count() == 6
    assert latest.where("qualifier = 'age'").first().value == "19"
    info = wt.from_cells(wt.read_cells(spark, path), ["age", "company"], family="info").first()
    assert (info.age, info.company) == ("19", "ACME")


def test_scan_prunes_and_drops_empty_rows(spark, tmp_path):
    from weblens.sinks import tables
    wide = _wide(spark)
    path = str(tmp_path / "wide")
    tables.write_day(wide, path, "20240101")
    tables.write_day(wide.limit(5), path, "20240102")
    got = wt.scan(spark, path, "20240101", ["country", "browsername"])
    assert got.count() == wide.count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert "ReadSchema: struct<rowkey:string,country:string,browsername:string>" in plan
    empty = spark.createDataFrame([("k", None, None, "x")], "rowkey string, a string, b string, day string")
    empty.write.mode("overwrite").partitionBy("day").parquet(str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).select("rowkey", "a", "b").dropna(
        how="all", subset=["a", "b"]).count() == 0


def test_equal_versions_resolve_deterministically(spark):
    cells = spark.createDataFrame([("k", "o", "ip", "b", 1), ("k", "o", "ip", "a", 1),
                                   ("k", "o", "ip", "z", 0)], wt.CELL_SCHEMA)
    assert wt.latest_cells(cells).first().value == "b"
    assert wt.from_cells(cells.repartition(3), ["ip"]).first().ip == "b"


def test_latest_cells_are_sorted_by_a_hash_first(spark):
    cells = wt.to_cells(_wide(spark))
    assert "Sort [_hash" in wt.latest_cells(cells)._jdf.queryExecution().executedPlan().toString()
