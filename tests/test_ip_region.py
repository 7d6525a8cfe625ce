"""IPv4 conversions and the region rules."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weblens.functions.ip import address, ip_to_long, long_to_ip
from weblens.functions.region import normalize_region

CASES = [
    ("局域网", "中国", "上海市", None),
    (None, "中国", "上海市", None),
    ("", "中国", "上海市", None),
    (" CZ88.NET", "中国", "上海市", None),
    ("浙江省杭州市", "中国", "浙江省", "杭州市"),
    ("吉林省延边州", "中国", "吉林省", None),
    ("台湾省", "中国", "台湾省", None),
    ("省会", "省会", None, None),
    ("内蒙古呼和浩特市", "中国", "内蒙古自治区", "呼和浩特市"),
    ("内蒙古", "中国", "内蒙古自治区", None),
    ("内蒙", "中国", "内蒙古自治区", None),
    ("广西南宁市", "中国", "广西", "南宁市"),
    ("新疆伊犁州", "中国", "新疆", None),
    ("西藏拉萨市", "中国", "西藏", "拉萨市"),
    ("宁夏银川市", "中国", "宁夏", "银川市"),
    ("上海市浦东新区", "中国", "上海市", "浦东新区"),
    ("天津市南开区", "中国", "天津市", "南开区"),
    ("北京市", "中国", "北京市", None),
    ("北京", "中国", "北京市", None),
    ("重庆市云阳县", "中国", "重庆市", None),
    ("香港", "中国", "香港特别行政区", None),
    ("澳门", "中国", "澳门特别行政区", None),
    ("美国", "美国", None, None),
    ("日本东京都", "日本东京都", None, None),
    ("未知国家", "未知国家", None, None),
    ("日", None, None, None),
]


def test_region_rules(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "c string")
    got = {r.c: (r.r.country, r.r.province, r.r.city)
           for r in df.select("c", normalize_region("c").alias("r")).collect()}
    for text, *expected in CASES:
        assert got[text] == tuple(expected), text


@settings(max_examples=1, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=(1 << 32) - 1), min_size=50, max_size=50))
def test_ip_round_trip(spark, values):
    values = values + [0, (1 << 32) - 1, 1 << 16, (1 << 24) - 1]
    df = spark.createDataFrame([(v,) for v in values], "n long")
    out = df.select("n", ip_to_long(long_to_ip("n")).alias("m"), long_to_ip("n").alias("s")).collect()
    for r in out:
        assert r.n == r.m
        assert r.s == ".".join(str((r.n >> s) & 255) for s in (24, 16, 8, 0))


@pytest.mark.parametrize("text", ["300.1.1.1", "1.2.3", "1.2.3.4.5", "a.b.c.d", "", None, "::1", "1..2.3"])
def test_invalid_ip_is_null(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(ip_to_long("s")).first()[0] is None


def test_long_to_ip_out_of_range(spark):
    df = spark.createDataFrame([(-1,), (1 << 32,)], "n long")
    assert [r[0] for r in df.select(long_to_ip("n")).collect()] == [None, None]


def test_address(spark):
    df = spark.createDataFrame([("美国", " CZ88.NET"), (" CZ88.NET", "电信"), ("中国", "联通")],
                               "c string, a string")
    assert [r[0] for r in df.select(address("c", "a")).collect()] == ["美国", "电信", "中国 联通"]


def _rules_in_python(c):
    if c is None or c == "" or c == "局域网" or c.strip(" ").startswith("CZ88"):
        return ("中国", "上海市", None)
    p = c.find("省")
    if p > 0:
        q = c.find("市", p)
        return ("中国", c[:p + 1], c[p + 1:q + 1] if q > 0 else None)
    if len(c) < 2:
        return (None, None, None)
    head = c[:2]

    def upto(rest, ch):
        i = rest.find(ch)
        return rest[:i + 1] if i > 0 else None

    if head == "内蒙":
        return ("中国", "内蒙古自治区", upto(c[3:], "市") if len(c) >= 3 else None)
    if head in ("广西", "西藏", "宁夏", "新疆"):
        return ("中国", head, upto(c[2:], "市"))
    if head in ("上海", "北京", "重庆", "天津"):
        return ("中国", head + "市", upto(c[3:], "区") if len(c) >= 3 else None)
    if head in ("香港", "澳门"):
        return ("中国", head + "特别行政区", None)
    return (c, None, None)


ALPHABET = list("省市区县内蒙古广西藏宁夏新疆上海北京重庆天津香港澳门浙江杭州局域网美国日本 CZ88.NETa")


@settings(max_examples=3, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=8)), min_size=200, max_size=200))
def test_region_rules_property(spark, texts):
    texts = texts + [c[0] for c in CASES]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    got = {r.i: (r.r.country, r.r.province, r.r.city)
           for r in df.select("i", normalize_region("c").alias("r")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == _rules_in_python(t), repr(t)
