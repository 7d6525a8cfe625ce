"""Access-line parsing, time formatting and row keys on hand-made lines."""

import zlib

import pytest
from pyspark.sql import functions as F

from weblens.functions.parse import (format_time, is_not_blank, is_not_empty, parse_access_log,
                                     rowkey, split_rejects)

UA_A = ("Mozilla/5.0 (Windows NT 6.3; x64) AppleWebKit/600.9 (KHTML, like Gecko) "
        "Chrome/88.7.10.20 Safari/600.9 SE 2.X MetaSr 3.5")
UA_B = "PhotoSync/12 CFNetwork/1121.2.2 Darwin/19.3.0"
UA_C = "Go-http-client/2.0"


def line(ip, time, url, status, size, referer, ua, method="GET"):
    return (f'{ip} - - [{time}] "{method} {url} HTTP/1.1" {status} {size} "www.example.com" '
            f'"{referer}" - "{ua}" "-" 10.0.0.1:80 {status} 0.172 0.172')


LINES = [
    line("110.20.30.40", "14/Mar/2021:00:00:21 +0800", "/shop/hats?colour=red", 200, 4321,
         "https://www.example.com/shop/shoes?size=42", UA_A),
    line("203.0.113.77", "14/Mar/2021:00:00:22 +0800", "/robots.txt",
         200, 165, "-", UA_B),
    line("198.51.100.99", "14/Mar/2021:00:00:22 +0800", "/", 301, 178, "-", UA_C),
]


def test_parse_fields(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    good, bad = split_rejects(parse_access_log(df))
    assert bad.count() == 0
    r = {x.ip: x for x in good.collect()}
    first = r["110.20.30.40"]
    assert first.time == "[14/Mar/2021:00:00:21 +0800]"
    assert (first.method, first.url, first.protocal) == ("GET", "/shop/hats?colour=red", "HTTP/1.1")
    assert (first.status, first.bytessent) == ("200", "4321")
    assert first.referer == '"https://www.example.com/shop/shoes?size=42"'  # quotes kept
    assert first.ua == UA_A
    assert r["198.51.100.99"].status == "301"
    assert r["203.0.113.77"].referer == '"-"'


@pytest.mark.parametrize("tz,expected", [("UTC", "202103131600"), ("Asia/Shanghai", "202103140000")])
def test_format_time_zone(spark, tz, expected):
    df = spark.createDataFrame([("[14/Mar/2021:00:00:21 +0800]",)], "time string")
    assert df.select(format_time("time", tz)).first()[0] == expected


def test_format_time_default_is_session_zone(spark):
    df = spark.createDataFrame([("[14/Mar/2021:00:00:21 +0800]",), ("[garbage]",), (None,)], "time string")
    got = [r[0] for r in df.select(format_time("time")).collect()]
    assert got == ["202103131600", None, None]  # session zone is UTC in tests


def test_rejects_are_routed_not_lost(spark):
    odd = ["", "a b c d e", "no quotes at all in this line but many many tokens here ok",
           line("::1", "14/Mar/2021:00:00:21 +0800", "/", 200, 1, "-", "")]
    df = spark.createDataFrame([(x,) for x in LINES + odd], "value string")
    good, bad = split_rejects(parse_access_log(df))
    assert good.count() + bad.count() == len(LINES) + len(odd)
    assert bad.count() == 3
    # an empty user agent still parses (as an empty field)
    assert good.where(F.col("ip") == "::1").first().ua == ""


def test_rowkey_matches_crc32(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    good, _ = split_rejects(parse_access_log(df))
    for r in good.select("referer", "url", "ip", "ua", rowkey("20210314").alias("k")).collect():
        crc = zlib.crc32((r.referer + r.url + r.ip + r.ua).encode("utf-8"))
        assert r.k == f"20210314_{crc}"


def test_rowkey_empty_info_is_zero(spark):
    df = spark.createDataFrame([(None, None, None, None)],
                               "referer string, url string, ip string, ua string")
    assert df.select(rowkey("20210314")).first()[0] == "20210314_0"


def test_blank_and_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("  \t",), (" x ",)], "s string")
    got = df.select(is_not_blank("s"), is_not_empty("s")).collect()
    assert [tuple(r) for r in got] == [(False, False), (False, False), (False, True), (True, True)]


def test_read_day_glob(spark, tmp_path):
    from weblens.sources.files import read_access_log
    for day, n in (("20210314", 2), ("20190131", 1)):
        folder = tmp_path / "access" / day
        folder.mkdir(parents=True)
        (folder / "part-0.log").write_text("\n".join(LINES[:n]) + "\n")
    assert read_access_log(spark, str(tmp_path / "access" / "20210314" / "*")).count() == 2
    assert read_access_log(spark, str(tmp_path / "access" / "*" / "*")).count() == 3


def test_java_split_semantics(spark):
    # trailing separators do not make missing tokens exist
    short = "1.2.3.4 - - [14/Mar/2021:00:00:21 +0800] \"GET / HTTP/1.1\" 200 5 \"h\"   "
    empty_ua_at_end = line("1.2.3.4", "14/Mar/2021:00:00:21 +0800", "/", 200, 5, "-", "").split(' "-" 10.0.0.1')[0]
    df = spark.createDataFrame([(short,), (empty_ua_at_end,), (LINES[0],)], "value string")
    good, bad = split_rejects(parse_access_log(df))
    assert bad.count() == 2 and good.count() == 1
    from weblens.functions.parse import java_split
    got = spark.createDataFrame([("a b  ",), ("a\"\"",)], "s string").select(
        java_split("s", " ").alias("sp"), java_split("s", '"').alias("q")).collect()
    assert got[0].sp == ["a", "b"] and got[1].q == ["a"]


def _java_split(text, sep):
    parts = text.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _parse_in_python(text):
    """The field rules stated directly: space tokens 0, 3+4, 5-9, 11 and the
    8th quote segment; a line missing any of them is rejected."""
    toks, segs = _java_split(text, " "), _java_split(text, '"')
    if len(toks) < 12 or len(segs) < 8 or toks[3] == "":
        return None
    return (toks[0], toks[3] + " " + toks[4], toks[5].replace('"', ""), toks[6],
            toks[7].replace('"', ""), toks[8], toks[9], toks[11], segs[7])


def test_parse_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    piece = st.sampled_from([" ", '"', "a", "GET", "/x", "-", "[t", "z]", "200", ""])

    @settings(max_examples=3, deadline=None)
    @given(st.lists(st.lists(piece, max_size=30).map("".join), min_size=200, max_size=200))
    def check(texts):
        texts = texts + LINES
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
        got = {r.i: r for r in parse_access_log(df, keep=["i"]).collect()}
        cols = ["ip", "time", "method", "url", "protocal", "status", "bytessent", "referer", "ua"]
        for i, t in enumerate(texts):
            want = _parse_in_python(t)
            r = got[i]
            assert r.parse_ok == (want is not None), repr(t)
            if want is not None:
                assert tuple(r[c] for c in cols) == want, repr(t)
    check()
