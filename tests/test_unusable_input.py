"""Input that is unusable, extreme or collides: no row is lost or merged silently."""

from pyspark.sql import functions as F

from weblens.functions.parse import parse_access_log, split_rejects, visit_key
from weblens.operators import agents, geo
from weblens.operators import orders as o
from weblens.operators import widetable as wt
from weblens.plans import etl
from weblens.sinks import tables
from weblens.streaming import orders as s

from conftest import rows
from test_parse import UA_A, line

RANGE_DDL = "begin_ip long, end_ip long, country string, area string"


def test_good_and_rejected_lines_are_all_lines(spark):
    lines = [line("1.2.3.4", "14/Mar/2021:00:00:21 +0800", "/a", 200, 10, "-", UA_A), "broken", "", None]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good, _ = split_rejects(parse_access_log(df))
    bad = etl.rejected_lines(df)
    assert good.count() == 1
    assert rows(bad) == [("",), (None,), ("broken",)]


def test_etl_writes_rejects(spark, tmp_path):
    (tmp_path / "a.log").write_text(
        line("1.2.3.4", "14/Mar/2021:00:00:21 +0800", "/a", 200, 1, "-", UA_A) + "\nbroken\n")
    ranges = spark.createDataFrame([(0, 255, "x", "y")], RANGE_DDL)
    out = str(tmp_path / "wide")
    counts = etl.run_etl(spark, str(tmp_path / "a.log"), ranges, out, "20210314", tz="UTC")
    assert counts == {"lines": 2, "good": 1, "rejected": 1}
    assert rows(spark.read.parquet(out + "_rejects").select("value")) == [("broken",)]


def _equal_checksums(spark):
    # referer + url are the same text, so both visits have one row key
    at = "14/Mar/2021:00:00:21 +0800"
    lines = [line("1.2.3.4", at, "/xy", 200, 1, "-", UA_A),
             line("1.2.3.4", at, "/xy", 200, 1, "-", UA_A).replace('"-" - ', '"-"/x - ').replace("/xy ", "y ")]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    ranges = spark.createDataFrame([(0, 255, "x", "y")], RANGE_DDL)
    return etl.wide_rows(df, ranges, "20210314", tz="UTC")


TWO_VISITS = [('"-"', "/xy"), ('"-"/x', "y")]


def test_visits_with_equal_checksums_stay_apart(spark):
    wide = _equal_checksums(spark).collect()
    assert sorted((r.referer, r.url) for r in wide) == TWO_VISITS
    assert len({r.rowkey for r in wide}) == 1 and len({r.visit for r in wide}) == 2


def test_equal_checksums_in_cells_sinks_and_reads(spark, tmp_path):
    wide = _equal_checksums(spark)
    key = wide.first()["rowkey"]

    def visits(rows_):
        return sorted((r["referer"], r["url"]) for r in rows_.collect())
    cells = wt.to_cells(wide)
    assert visits(wt.from_cells(cells, ["referer", "url"])) == TWO_VISITS         # R2, R3
    tables.bulk_write_cells(wide, str(tmp_path / "k3"), "20210314")               # K3
    back = spark.read.schema(wt.STORED_CELLS).parquet(str(tmp_path / "k3"))
    assert visits(wt.from_cells(back, ["referer", "url"])) == TWO_VISITS
    wt.put_cells(cells, str(tmp_path / "k9"))                                     # K9: the newest of each cell
    wt.put_cells(wt.to_cells(wide.withColumn("status", F.lit("304")), columns=["status"], version=1), str(tmp_path / "k9"))
    newest = wt.latest_cells(wt.read_cells(spark, str(tmp_path / "k9")))
    assert newest.count() == 2 * len(wt.WIDE_COLUMNS)
    one = wide.where(F.col("url") == "y")
    assert visits(wt.get(wide, key)) == TWO_VISITS                                # S7
    assert visits(wt.get(wide, one)) == TWO_VISITS[1:]
    assert visits(wt.get(wide, one.select("rowkey"))) == TWO_VISITS
    tables.write_day(wide, str(tmp_path / "wide"), "20210314", clustered=True)
    assert visits(tables.get_rows(spark, str(tmp_path / "wide"), key)) == TWO_VISITS


def test_visit_key_tells_texts_and_nulls_apart(spark):
    texts = [("a", "b", "c", "d"), ("ab", "", "c", "d"), (None, "b", "c", "d"), ("", "b", "c", "d"), ("-", "b", "c", "d"),
             ("a", "1:b", "c", "d"), (None, None, None, None), ("a,1:b", None, "c", "d")]
    df = spark.createDataFrame(texts, "referer string, url string, ip string, ua string")
    assert df.select(visit_key()).distinct().count() == len(texts)


def test_day_counters_keep_times_without_a_minute(spark):
    def order(time, fee):
        return ('{"time":"%s","flag":"1","fee":"%s"}' % (time, fee),)
    msgs = spark.createDataFrame([order("20240110", 3), order("20240110103000", 7), order("2024-01-10 10:00", 9)],
                                 "value string")
    parsed = o.parse_orders(msgs)
    assert rows(o.daily_paid(parsed)) == [("20240110", 2, 10)]
    assert rows(o.order_rollup(parsed)) == [("20240110", 1, 1, 7), ("2024011010", 1, 1, 7)]
    assert rows(s.running_totals(msgs, daily=True)) == [("20240110", 2, 2, 10)]


def test_large_rule_table_answers_like_the_chain(spark):
    uas = spark.createDataFrame([(r[2].replace("([0-9.]+)", "4.2"),) for r in agents.DEFAULT_RULES]
                                + [("",), (None,), ("nothing known",)], "ua string")
    more = [(1000 + i, "browser", f"NoSuchAgent{i}/", f"n{i}", 0) for i in range(agents.INLINE_RULES + 1)]
    large = agents.default_rules(spark).union(
        spark.createDataFrame(more, agents.RULE_SCHEMA))
    assert rows(agents.classify(uas, large)) == rows(agents.classify(uas))


def test_ranges_beyond_the_address_space_and_overlapping(spark):
    ranges = [(-50, 10, "before", "a"), (-5, 20, "later before", "b"), (0, 3, "zero", "c"),
              (65000, 1 << 50, "wide", "d"), (70000, 70010, "inner", "e"),
              (1 << 31, (1 << 31) + 5, "far", "f"), (1 << 40, 1 << 41, "outside", "g")]
    ips = [0, 3, 4, 64999, 65000, 69999, 70005, 70011, (1 << 31) + 5, (1 << 31) + 6, (1 << 32) - 1]
    df = spark.createDataFrame([(i,) for i in ips], "ip_long long")
    got = {r.ip_long: r.geo_country for r in geo.locate(
        df, spark.createDataFrame(ranges, RANGE_DDL), not_found=("none", "none")).collect()}

    def search(ip):
        best = max((r for r in ranges if r[0] <= ip), default=None)
        return best[2] if best and ip <= best[1] else "none"
    assert got == {ip: search(ip) for ip in ips}


def test_many_wide_overlapping_ranges_are_not_exploded(spark):
    ranges = spark.createDataFrame([(i, 4294967295 - i, f"c{i}", "x") for i in range(40)], RANGE_DDL)
    out = geo.effective_ranges(ranges)
    assert "Generate explode" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert rows(out, "begin_ip", "end_ip") == sorted(
        [(i, i) for i in range(39)] + [(39, 4294967256)], key=lambda t: tuple(map(str, t)))


def test_a_failing_etl_leaves_both_days(spark, tmp_path):
    import pytest
    log = tmp_path / "a.log"
    log.write_text(line("1.2.3.4", "14/Mar/2021:00:00:21 +0800", "/a", 200, 1, "-", UA_A) + "\nbroken\n")
    ranges = spark.createDataFrame([(0, 255, "x", "y")], RANGE_DDL)
    out = str(tmp_path / "wide")
    etl.run_etl(spark, str(log), ranges, out, "20210314", tz="UTC")
    log.write_text("broken again\n" * 3)
    bad = spark.createDataFrame([(1, "browser", "(", "no pattern", 0)], agents.RULE_SCHEMA)
    log.write_text(line("1.2.3.4", "14/Mar/2021:00:00:21 +0800", "/b", 200, 1, "-", "x") + "\n")
    with pytest.raises(Exception):
        etl.run_etl(spark, str(log), ranges, out, "20210314", bad, tz="UTC")
    assert rows(spark.read.schema(wt.WIDE_SCHEMA).parquet(out), "url") == [("/a",)]
    assert rows(spark.read.parquet(out + "_rejects").select("value")) == [("broken",)]


def test_etl_scans_the_text_once(spark, tmp_path):
    (tmp_path / "a.log").write_text("broken\n" * 5)
    good, bad, counts = etl.parsed_once(spark.read.text(str(tmp_path / "a.log")))
    for df in (good, bad):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan and "PartitionFilters" in plan
    assert counts == {"lines": 5, "good": 0, "rejected": 5} and good.count() == 0 and bad.count() == 5
