"""Order messages: parsing, hand cases, rollups, encode/parse round trip."""

import json

from weblens.operators import orders as o

from conftest import rows


def msg(**kw):
    return json.dumps(kw)


HAND = [
    msg(time="20190130101500", userid="1", courseid="2", fee="100", flag="1", orderid="a"),
    msg(time="20190130103000", userid="1", courseid="2", fee="50", flag="0", orderid="b"),
    msg(time="20190130110000", userid="1", courseid="2", fee="7", flag=None, orderid="c"),   # null flag
    msg(time="20190130110500", userid="1", courseid="2", flag="1", orderid="d"),             # fee missing
    msg(time="20190130111000", userid="1", courseid="2", fee="abc", flag="1", orderid="e"),  # bad fee
    msg(time="2019013", userid="1", courseid="2", fee="1", flag="1", orderid="f"),           # short time
    "{not json",
    msg(time="20190131000000", userid="1", courseid="2", fee="9", flag="0", orderid="g"),   # no paid order
    msg(time="20181230000000", userid="1", courseid="2", fee="5", flag="1", orderid="h"),   # a month late
]


def _orders(spark):
    return o.parse_orders(spark.createDataFrame([(m,) for m in HAND], "value string"))


def test_daily_paid_hand_cases(spark):
    got = rows(o.daily_paid(_orders(spark)))
    assert got == [("20181230", 1, 5), ("20190130", 3, 100), ("20190131", 0, 0)]


def test_rollup_levels(spark):
    got = {r.stat_key: (r.total, r.success, r.fee) for r in o.order_rollup(_orders(spark)).collect()}
    assert got["20190130"] == (5, 3, 100)
    assert got["2019013010"] == (2, 1, 100)
    assert got["2019013011"] == (3, 2, 0)
    assert got["20190131"] == (1, 0, 0)
    assert "2019013" not in got and len(got) == 7  # 3 days + 4 day-hours


def test_bad_fee_flag_and_invalid_json(spark):
    m = {r.orderid: r for r in o.paid_metrics(_orders(spark)).collect()}
    assert m["d"].bad_fee and m["e"].bad_fee and not m["a"].bad_fee
    assert m[None].valid is False  # invalid JSON: null fields, rejected from rollups


def test_counter_layouts(spark):
    c = rows(o.counters(o.order_rollup(_orders(spark))).where("stat_key = 'order-20190130'"))
    assert c == [("order-20190130", "fee", 100), ("order-20190130", "success", 3),
                 ("order-20190130", "total", 5)]


def test_encode_parse_round_trip(spark):
    parsed = _orders(spark).where("orderid IS NOT NULL")
    again = o.parse_orders(o.encode_orders(parsed))
    cols = o.ORDER_FIELDS
    assert rows(again, *cols) == rows(parsed, *cols)
    first = o.encode_orders(parsed.where("orderid = 'a'")).first()[0]
    assert json.loads(first) == json.loads(HAND[0])


def test_quality_observation(spark):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    obs = Observation("q")
    df = _orders(spark)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).collect()
    assert obs.get["rows"] == len(HAND)
    o.order_rollup(o.observe_quality(df)).collect()  # runs with the observation attached


def test_daily_needs_only_the_day(spark):
    msgs = [msg(time="20190130", fee="3", flag="1", orderid="x"),      # no hour: day total only
            msg(time="201901301", fee="4", flag="1", orderid="y")]
    df = o.parse_orders(spark.createDataFrame([(m,) for m in msgs], "value string"))
    assert rows(o.daily_paid(df)) == [("20190130", 2, 7)]
    assert o.order_rollup(df).count() == 0
