"""Day-replacing sinks are idempotent and leave other days alone."""

import glob
import os

import pytest
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from weblens.operators import analytics
from weblens.operators import widetable as wt
from weblens.sinks import tables

from conftest import rows
from test_widetable import _wide


def test_write_day_rerun_and_other_days(spark, tmp_path):
    path = str(tmp_path / "wide")
    wide = _wide(spark)
    n = wide.count()
    tables.write_day(wide, path, "20240101")
    tables.write_day(wide.limit(7), path, "20240102")
    tables.write_day(wide, path, "20240101")  # rerun replaces, never duplicates
    back = spark.read.schema(wt.WIDE_SCHEMA).parquet(path)
    counts = {r.day: r.n for r in back.groupBy("day").agg(F.count("*").alias("n")).collect()}
    assert counts == {"20240101": n, "20240102": 7}


def test_bulk_write_cells_sorted_ranges(spark, tmp_path):
    path = str(tmp_path / "cells")
    tables.bulk_write_cells(_wide(spark), path, "20240101", partitions=4)
    files = sorted(glob.glob(f"{path}/day=20240101/*.parquet"))
    assert len(files) >= 2
    spans = []
    for f in files:
        t = pq.read_table(f, columns=["rowkey", "family", "qualifier"]).to_pylist()
        keys = [(r["rowkey"], r["family"], r["qualifier"]) for r in t]
        assert keys == sorted(keys)  # sorted inside every file
        if keys:
            spans.append((keys[0][0], keys[-1][0]))
    spans.sort()
    for a, b in zip(spans, spans[1:]):
        assert a[1] < b[0]  # files hold disjoint key ranges


def test_replace_day_idempotent(spark, tmp_path):
    path = str(tmp_path / "stat")
    stats = analytics.browser_stat_rows(_wide(spark), "20240101")
    tables.replace_day(stats, path, "20240101")
    tables.replace_day(stats, path, "20240101")
    back = spark.read.parquet(path)
    assert back.count() == stats.count()
    assert len(glob.glob(f"{path}/day=20240101/*.parquet")) == 1  # one small file


def test_ensure_table_and_describe(spark, tmp_path):
    name = "weblens_t_access"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert tables.ensure_table(spark, name, "rowkey STRING, ip STRING, day STRING",
                               partitioned_by=["day"], path=str(tmp_path / "t"))
    assert not tables.ensure_table(spark, name, "rowkey STRING, ip STRING, day STRING")
    assert tables.ensure_table(spark, name, "rowkey STRING, day STRING", replace=True,
                               path=str(tmp_path / "t2"))
    described = dict(tables.describe(spark))
    assert described[name] == ["rowkey", "day"]
    spark.sql(f"DROP TABLE {name}")


def test_an_empty_day_replaces_the_old_one(spark, tmp_path):
    stats = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    target = str(tmp_path / "stats")
    tables.replace_day(stats, target, "20210314")
    tables.replace_day(stats, target, "20210315")
    tables.replace_day(stats.limit(0), target, "20210314")
    assert {r["day"] for r in spark.read.parquet(target).collect()} == {20210315}


def test_a_recreated_table_is_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.ensure_table(spark, "recreated", "k string", path=path)
    spark.sql("INSERT INTO recreated VALUES ('old')")
    assert tables.ensure_table(spark, "recreated", "k string", path=path, replace=True)
    assert spark.table("recreated").count() == 0
    spark.sql("DROP TABLE recreated")


def _rows_of(spark, path):
    return sorted((r["k"], r["n"], str(r["day"])) for r in spark.read.parquet(path).collect())


def test_a_failing_rerun_keeps_the_old_day(spark, tmp_path):
    stats = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    target = str(tmp_path / "stats")
    tables.replace_day(stats, target, "20210314")
    with pytest.raises(Exception, match="wrong row"):
        tables.replace_day(stats.withColumn("n", F.raise_error(F.lit("wrong row")).cast("int")), target, "20210314")
    assert _rows_of(spark, target) == [("a", 1, "20210314"), ("b", 2, "20210314")]
    assert sorted(os.listdir(target)) == ["day=20210314"]  # nothing is left beside it


def test_a_plan_may_read_the_day_it_replaces(spark, tmp_path):
    target = str(tmp_path / "stats")
    tables.replace_day(spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"), target, "20210314")
    more = spark.read.parquet(target).select("k", (F.col("n") + 10).alias("n"))
    tables.replace_day(more, target, "20210314")
    assert _rows_of(spark, target) == [("a", 11, "20210314"), ("b", 12, "20210314")]


def test_the_old_day_comes_back_if_the_new_one_cannot_take_its_place(spark, tmp_path):
    from weblens.session import replace_path
    (tmp_path / "day").mkdir()
    (tmp_path / "day" / "f").write_text("old")
    with pytest.raises(OSError):
        replace_path(spark, str(tmp_path / "missing"), str(tmp_path / "day"))
    assert (tmp_path / "day" / "f").read_text() == "old"


def test_a_recreated_table_clears_its_own_folder_only(spark, tmp_path):
    old, other = str(tmp_path / "old"), tmp_path / "other"
    other.mkdir()
    (other / "keep.txt").write_text("x")
    tables.ensure_table(spark, "moved", "k string", path=old)
    spark.sql("INSERT INTO moved VALUES ('old')")
    assert tables.ensure_table(spark, "moved", "k string", replace=True)
    assert (other / "keep.txt").exists() and not glob.glob(f"{old}/*.parquet")
    assert spark.table("moved").count() == 0
    spark.sql("DROP TABLE moved")


def test_a_point_read_opens_one_file(spark, tmp_path):
    path = str(tmp_path / "wide")
    wide = _wide(spark)
    tables.write_day(wide, path, "20240101", clustered=True, files=6)
    files = glob.glob(f"{path}/day=20240101/*.parquet")
    assert len(files) == 6
    spans = sorted((min(k), max(k)) for k in (pq.read_table(f, columns=["rowkey"])["rowkey"].to_pylist() for f in files))
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    for f in files:
        keys = pq.read_table(f, columns=["rowkey", "visit"]).to_pylist()
        assert keys == sorted(keys, key=lambda r: (r["rowkey"], r["visit"]))
    key = wide.agg(F.max("rowkey")).first()[0]
    got = tables.get_rows(spark, path, key)
    assert len(got.inputFiles()) == 1
    assert got.select("rowkey").collect() == [(key,)]
    assert tables.get_rows(spark, path, ["20240101_x", "20990101_5", "no key"]).count() == 0
    assert len(tables.get_rows(spark, path, [key, spans[0][0]]).inputFiles()) == 2
    # readers of the whole table do not see the key ranges
    assert rows(spark.read.schema(wt.WIDE_SCHEMA).parquet(path).drop("day")) == rows(wide.drop("day", "event_ts"))


def test_point_reads_without_clustering_and_an_empty_day(spark, tmp_path):
    path = str(tmp_path / "wide")
    wide = _wide(spark)
    tables.write_day(wide, path, "20240101")
    key = wide.first()["rowkey"]
    assert tables.get_rows(spark, path, key).count() == 1
    tables.cluster_day(spark, path, "20240101", files=3)
    assert tables.get_rows(spark, path, key).count() == 1
    tables.write_day(wide.limit(0), path, "20240101", clustered=True)
    assert tables.get_rows(spark, path, key).count() == 0


def test_a_row_with_a_third_of_all_cells_spreads_over_tasks(spark, tmp_path):
    path = str(tmp_path / "cells")
    hot = spark.range(4000).select(F.lit("20240101_7").alias("rowkey"), F.lit("v").alias("visit"), F.lit("o").alias("family"),
                                   F.lit("status").alias("qualifier"), F.lit("200").alias("value"), F.col("id").alias("version"))
    rest = spark.range(8000).select(F.concat(F.lit("20240101_"), F.col("id").cast("string")).alias("rowkey"), F.lit("w").alias("visit"),
                                    F.lit("o").alias("family"), F.lit("url").alias("qualifier"), F.lit("/").alias("value"),
                                    F.lit(0).cast("long").alias("version"))
    tables.bulk_write_cells(hot.union(rest), path, "20240101", partitions=12)
    spans, holding = [], 0
    for f in glob.glob(f"{path}/day=20240101/*.parquet"):
        t = pq.read_table(f).to_pylist()
        order = [tuple(r[c] for c in ("rowkey", "visit", "family", "qualifier", "version", "value")) for r in t]
        assert order == sorted(order)
        spans += [(order[0], order[-1])] if order else []
        holding += any(r["rowkey"] == "20240101_7" for r in t)
        assert len(t) < 2500
    spans.sort()
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and holding >= 3


def test_report_reads_its_input_once(spark):
    rep = analytics.report(_wide(spark))
    wide = _wide(spark)
    assert rows(rep["top_regions"]) == rows(analytics.top_regions(wide))
    assert rows(rep["browsers"]) == rows(analytics.browser_counts(wide))
    for df in rep.values():  # what is left to do reads the written aggregate only
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" not in plan and "event_id" not in plan


def test_bulk_cells_deal_and_sort_rows_not_cells(spark):
    wide = spark.createDataFrame([(f"20240101_{i * 7919 % 97}", f"v{i}", "200", f"10.0.0.{i}", None) for i in range(97)],
                                 "rowkey string, visit string, status string, ip string, city string")
    cells = tables.bulk_cells(wide, 3)
    lines = cells._jdf.queryExecution().optimizedPlan().toString().splitlines()
    made = next(i for i, ln in enumerate(lines) if "Expand" in ln)
    assert any("Sort" in ln for ln in lines[made:]) and not any("Sort" in ln or "Repartition" in ln for ln in lines[:made])
    keys = [tuple(r) for r in cells.select("rowkey", "visit", "family", "qualifier").collect()]
    assert keys == sorted(keys)  # the ranges follow each other
    assert rows(cells) == rows(wt.stored_cells(wt.to_cells(wide)))
