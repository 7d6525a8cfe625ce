"""Range join: bucketed = naive between-join, edge addresses, plan shape."""

import pytest
from pyspark.sql import functions as F

from weblens.functions.ip import ip_to_long
from weblens.operators import geo
from weblens.sources import derived as d

from conftest import SF_CHECK, rows

RANGES = [
    (0, 255, "局域网", "A"),                                # first range, starts at 0.0.0.0
    (65000, 70000, "浙江省杭州市", "crosses a /16"),
    (16777216, 33554431, "美国", "a /8"),                 # 1.0.0.0/8
    (4294967040, 4294967295, "香港", "last /24"),          # ends at 255.255.255.255
]


@pytest.fixture()
def ranges(spark):
    return spark.createDataFrame(RANGES, "begin_ip long, end_ip long, country string, area string")


@pytest.mark.parametrize("ip,country", [
    (0, "局域网"), (255, "局域网"), (256, "未知国家"), (65000, "浙江省杭州市"), (65536, "浙江省杭州市"),
    (70000, "浙江省杭州市"), (70001, "未知国家"), (16777216, "美国"), (33554431, "美国"),
    (4294967295, "香港"), (4294967039, "未知国家"), (None, None),
])
def test_edges(spark, ranges, ip, country):
    df = spark.createDataFrame([(ip,)], "ip_long long")
    assert geo.locate(df, ranges).first().geo_country == country


def test_bucketed_equals_between_join(spark):
    events = d.read_table(spark, SF_CHECK, "events")
    ips = events.select("event_id", d.event_ip().alias("ip_long"))
    rg = d.ip_ranges(d.read_table(spark, SF_CHECK, "nation"))
    fast = geo.locate(ips, rg, keep_range=True)
    cond = ips["ip_long"].between(rg["begin_ip"], rg["end_ip"])
    naive = ips.join(rg, cond, "left").select(
        "event_id", "ip_long", F.col("begin_ip").alias("range_begin"), F.col("end_ip").alias("range_end"),
        F.when(F.col("begin_ip").isNull(), "未知国家").otherwise(F.col("country")).alias("geo_country"),
        F.when(F.col("begin_ip").isNull(), "未知地区").otherwise(F.col("area")).alias("geo_area"))
    cols = ["event_id", "ip_long", "range_begin", "range_end", "geo_country", "geo_area"]
    assert rows(fast, *cols) == rows(naive, *cols)
    hits = fast.where(F.col("range_begin").isNotNull()).count()
    assert (hits, fast.count() - hits) == (9569, 431)  # FIXTURES.md section 3
    dedup = geo.locate(ips, rg, keep_range=True, dedup=True)
    assert rows(dedup, *cols) == rows(fast, *cols)


def test_plan_has_no_nested_loop(spark, ranges):
    df = spark.range(1000).select(F.col("id").alias("ip_long"))
    plan = geo.locate(df, ranges)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan
    assert "BroadcastHashJoin" in plan


def test_shuffle_path_when_too_big(spark, ranges):
    df = spark.range(1000).select((F.col("id") * 64).alias("ip_long"))
    small = geo.locate(df, ranges)
    big = geo.locate(df, geo.RangeTable(ranges, broadcast_max_rows=1))
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan
    assert rows(small) == rows(big)


def test_disjoint_check(spark, ranges):
    assert geo.check_disjoint(ranges).count() == 0
    overlap = ranges.union(spark.createDataFrame([(60000, 65001, "x", "y")], ranges.schema))
    assert geo.check_disjoint(overlap).count() == 1
    with pytest.raises(ValueError):
        geo.RangeTable(overlap, validate=True)


def test_find_and_end_ips(spark, ranges):
    found = rows(geo.find_ranges(ranges, "省"))
    assert found == [("0.0.253.232", "0.1.17.112", "浙江省杭州市", "crosses a /16")]
    ends = [r[0] for r in rows(geo.range_end_ips(ranges))]
    assert "255.255.255.255" in ends and len(ends) == len(RANGES)  # the last range included


def test_enrich_geo_unknowns(spark, ranges):
    df = spark.createDataFrame([("0.0.0.1",), ("300.1.1.1",), ("  ",), ("0.0.1.0",), ("1.2.3.4",)], "ip string")
    got = {r.ip: (r.country, r.province, r.city) for r in geo.enrich_geo(df, ranges, "ip").collect()}
    assert got["0.0.0.1"] == ("中国", "上海市", "unknown")
    assert got["300.1.1.1"] == ("unknown", "unknown", "unknown")
    assert got["  "] == ("unknown", "unknown", "unknown")
    assert got["0.0.1.0"] == ("未知国家", "unknown", "unknown")
    assert got["1.2.3.4"] == ("美国", "unknown", "unknown")


def test_line_geo_map(spark, ranges):
    df = spark.createDataFrame([("1.2.3.4 - - rest",), ("   ",)], "value string")
    got = [r.geo for r in geo.line_geo_map(df, ranges).orderBy("value").collect()]
    assert got[0] == {}
    assert got[1] == {"ip": "1.2.3.4", "country": "美国", "province": None, "city": None}
    assert df.select(ip_to_long(F.lit("1.2.3.4"))).first()[0] == 16909060


def _binary_search_answer(ranges, ip):
    """The original lookup, stated directly: greatest begin <= ip, accepted
    only if ip <= that range's end (equal begins: the greatest end, then
    the greatest text, the library's deterministic choice)."""
    best = None
    for r in ranges:
        if r[0] <= ip and (best is None or r > best):
            best = r
    return best[2] if best is not None and ip <= best[1] else "未知国家"


def test_overlapping_ranges_match_binary_search(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    span = 1 << 18  # a few /16 buckets, so ranges cross bucket borders
    rng = st.tuples(st.integers(0, span), st.integers(0, 70000))

    @settings(max_examples=4, deadline=None)
    @given(st.lists(rng, min_size=1, max_size=40), st.lists(st.integers(0, span + 70000), min_size=60, max_size=60))
    def check(raw, ips):
        table = [(b, b + w if i % 9 else b - 5, f"c{i}", "a") for i, (b, w) in enumerate(raw)]
        rdf = spark.createDataFrame(table, "begin_ip long, end_ip long, country string, area string")
        ipdf = spark.createDataFrame([(i,) for i in ips], "ip_long long")
        got = geo.locate(ipdf, rdf).collect()
        assert len(got) == len(ips)  # never duplicates a looked-up row
        for r in got:
            assert r.geo_country == _binary_search_answer(table, r.ip_long), (r.ip_long, table)
    check()


def test_missing_range_file_is_an_error(spark, tmp_path):
    from weblens.sources.files import load_ranges
    with pytest.raises(Exception):
        load_ranges(spark, str(tmp_path / "missing")).count()


def test_broadcast_byte_bound(spark):
    from weblens.session import broadcast_fits
    df = spark.createDataFrame([("x" * 1000, 1)] * 50, "s string, n long")
    assert broadcast_fits(df, max_rows=100, max_bytes=100_000)
    assert not broadcast_fits(df, max_rows=100, max_bytes=10_000)  # ~51 KB of text
    assert not broadcast_fits(df, max_rows=10, max_bytes=100_000)


def test_crowded_blocks_are_split(spark):
    # half a million ranges of two addresses in eight /16s, and a few wide ones around them
    dense = spark.range(500_000).select((F.lit(1 << 24) + F.col("id")
                                         ).cast("long").alias("begin_ip"))
    dense = dense.select("begin_ip", F.col("begin_ip").alias("end_ip"), F.concat(F.lit("c"), "begin_ip").alias("country"),
                         F.lit("x").alias("area"))
    wide = spark.createDataFrame([(0, (1 << 24) - 10, "before", "y"), ((1 << 24) + 500_010, (1 << 32) - 1, "after", "z")],
                                 "begin_ip long, end_ip long, country string, area string")
    table = geo.RangeTable(dense.union(wide))
    assert len(table.crowded) == 2
    most = table.blocks.groupBy("_block").count().agg(F.max("count")).first()[0]
    assert most <= geo.MOST_RANGES
    assert table.blocks.count() < 2 * 500_002 + 70_000
    ips = spark.createDataFrame([(i,) for i in [0, (1 << 24) - 10, (1 << 24) - 9, 1 << 24, (1 << 24) + 77_777,
                                                (1 << 24) + 499_999, (1 << 24) + 500_000, (1 << 24) + 500_010, (1 << 32) - 1]]
                                + [(None,)], "ip_long long")
    out = geo.locate(ips, table, not_found=("none", "none"))
    got = {r.ip_long: r.geo_country for r in out.collect()}
    base = 1 << 24
    assert got == {0: "before", base - 10: "before", base - 9: "none", base: f"c{base}", base + 77_777: f"c{base + 77_777}",
                   base + 499_999: f"c{base + 499_999}", base + 500_000: "none", base + 500_010: "after",
                   (1 << 32) - 1: "after", None: None}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_split_blocks_equal_the_search(spark):
    import random
    rng = random.Random(11)
    ranges = []
    for _ in range(600):  # crowded in a few places, overlapping, inverted
        begin = rng.choice([0, 70_000, 1 << 20, (1 << 32) - 3000]) + rng.randrange(3000)
        ranges.append((begin, begin + rng.choice([-3, 0, 1, 7, 300, 90_000]), f"c{len(ranges)}", "x"))
    df = spark.createDataFrame(ranges, "begin_ip long, end_ip long, country string, area string")
    ips = sorted({max(0, min((1 << 32) - 1, r[0] + k)) for r in ranges for k in (-1, 0, 2, 400)} | {1 << 31})
    probe = spark.createDataFrame([(i,) for i in ips], "ip_long long")

    def search(ip):
        best = max((r for r in ranges if r[0] <= ip), default=None)
        return best[2] if best and ip <= best[1] else "none"
    want = {ip: search(ip) for ip in ips}
    for options in ({"most_ranges": 4}, {"most_ranges": 4, "broadcast_max_rows": 0}):
        table = geo.RangeTable(df, **options)
        assert table.crowded
        got = {r.ip_long: r.geo_country for r in geo.locate(probe, table, not_found=("none", "none")).collect()}
        assert got == want
