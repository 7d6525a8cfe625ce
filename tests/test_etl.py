"""The log ETL end to end on hand-made lines (FIXTURES.md section 1 cases)."""

import zlib

from weblens.functions.parse import parse_access_log, split_rejects
from weblens.operators import widetable as wt
from weblens.plans import etl

from test_parse import UA_A, UA_B, line

RANGES = [(0, 16777215, "局域网", "LAN"), (1845493760, 1862270975, "浙江省杭州市", "电信")]  # 110.0.0.0/8


def test_etl_hand_cases(spark):
    lines = [
        line("110.20.30.40", "14/Mar/2021:00:00:21 +0800", "/a", 200, 10, "-", UA_A),
        # same key (referer+url+ip+ua) later, different status: this one wins
        line("110.20.30.40", "14/Mar/2021:00:05:00 +0800", "/a", 304, 0, "-", UA_A),
        line("300.1.1.1", "14/Mar/2021:00:00:22 +0800", "/b", 200, 1, "-", UA_B),
        line("::1", "14/Mar/2021:00:00:23 +0800", "/c", 200, 1, "-", ""),
        line("8.8.8.8", "14/Mar/2021:00:00:24 +0800", "/d", 200, 1, "-", UA_B),
        "", "only five tokens in here", "no quotes but many many tokens in this line at all ok",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    ranges = spark.createDataFrame(RANGES, "begin_ip long, end_ip long, country string, area string")
    _, bad = split_rejects(parse_access_log(df))
    assert bad.count() == 3
    wide = etl.wide_rows(df, ranges, "20210314", tz="UTC")
    got = {r.ip: r for r in wide.collect()}
    assert len(got) == 4  # 5 good lines, two share a row key
    a = got["110.20.30.40"]
    assert (a.status, a.formattime) == ("304", "202103131605")
    assert (a.country, a.province, a.city) == ("中国", "浙江省", "杭州市")
    assert (a.browsername, a.osname) == ("Sogou Explorer", "Windows")
    assert a.rowkey == "20210314_%d" % zlib.crc32(('"-"/a110.20.30.40' + UA_A).encode())
    assert (got["300.1.1.1"].country, got["300.1.1.1"].city) == ("unknown", "unknown")
    v6 = got["::1"]
    assert (v6.country, v6.browsername, v6.osversion) == ("unknown", "unknown", "unknown")
    miss = got["8.8.8.8"]
    assert (miss.country, miss.province) == ("未知国家", "unknown")
    assert set(wt.WIDE_COLUMNS) <= set(wide.columns)
    assert all(getattr(r, c) is not None for r in got.values() for c in wt.WIDE_COLUMNS)


def test_run_etl_day_glob(spark, tmp_path):
    from weblens.operators import widetable
    folder = tmp_path / "access" / "20210314"
    folder.mkdir(parents=True)
    (folder / "a.log").write_text(line("110.20.30.40", "14/Mar/2021:00:00:21 +0800", "/a", 200, 1, "-", UA_A) + "\n")
    (folder / "b.log").write_text(line("8.8.8.8", "14/Mar/2021:00:00:22 +0800", "/b", 200, 1, "-", UA_B) + "\n")
    ranges = spark.createDataFrame(RANGES, "begin_ip long, end_ip long, country string, area string")
    out = str(tmp_path / "wide")
    etl.run_etl(spark, str(folder / "*"), ranges, out, "20210314", tz="UTC")
    etl.run_etl(spark, str(folder / "*"), ranges, out, "20210314", tz="UTC")  # rerun: same result
    got = widetable.scan(spark, out, "20210314", ["country", "browsername"])
    assert sorted((r.country, r.browsername) for r in got.collect()) == [
        ("中国", "Sogou Explorer"), ("未知国家", "CFNetwork")]
