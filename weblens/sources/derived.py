"""Reference-shaped inputs derived, by Spark, from the driver's test tables.

The reference reads raw access logs, a binary IP-range database and order
messages from a queue; none of these ship with it. The same shapes are
derived here from ``events`` and ``nation`` with plain column formulas, so
the work grows with the tables. The oracle SQL applies the same formulas.

* access lines: one line per event;
* IP ranges: one range per nation, with gaps;
* order messages: one JSON message per event.

A few rows are unusable on purpose, by fixed remainders of ``event_id``:
malformed lines, invalid and IPv6 addresses, broken JSON, null flags, missing
and non-numeric fees, short and misspelt times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ip import long_to_ip

# Fixed values of the derivation (shared with the oracle SQL).
IP_USER_FACTOR = 28633115
IP_EVENT_FACTOR = 7919
RANGE_STRIDE = 171798691
RANGE_GAP = 40000000
HOST = "www.example.com"
REFERERS = [
    "-",
    "https://www.example.com/home",
    "https://www.example.com/shop/shoes?size=42",
    "https://www.example.com/shop/hats?colour=red",
    "https://find.example.org/query?text=boots",
    "-",
    "https://app.example.com/start",
]
USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 6.1; Win64; x64) AppleWebKit/601.5 (KHTML, like Gecko) Chrome/101.2.3.4 Safari/601.5",
    "PhotoSync/12 CFNetwork/1121.2.2 Darwin/19.3.0",
    "Mozilla/5.0 (X11; Linux x86_64; rv:102.0) Gecko/20100101 Firefox/102.0",
    "ShopFetcher/2.3 (+https://bots.example.com/about)",
    "curl/8.5.0",
]
# Location text of the range of nation k (index = n_nationkey).
RANGE_COUNTRIES = [
    "局域网", "浙江省杭州市", "吉林省延边州", "台湾省", "省会",
    "内蒙古呼和浩特市", "内蒙古", "内蒙", "广西南宁市", "新疆伊犁州",
    "西藏拉萨市", "宁夏银川市", "上海市浦东新区", "天津市南开区", "北京市",
    "北京", "重庆市云阳县", "香港", "澳门", "美国",
    "日本东京都", "日", " CZ88.NET", "", None,
]
# Remainders of event_id that make an unusable line or message.
LINE_MODULUS = 97
BAD_ADDRESSES = {1: "999.1.2.3", 2: "2001:db8::1"}
MALFORMED_LINE = 3
ORDER_MODULUS = 89
DAY_ONLY, NO_MINUTE, DASHED_TIME, TEXT_FEE, NO_FEE, NO_FLAG, BROKEN_JSON = 1, 2, 3, 4, 5, 6, 7
LOG_TAIL = '"-" 192.0.2.10:8080 200 0.004 0.003'


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]),
                        (index + 1).cast("int"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_ip(repeat_keys: bool = False) -> Column:
    """The derived client address of an event, as a number."""
    base = F.col("user_id") * F.lit(IP_USER_FACTOR)
    if not repeat_keys:
        base = base + F.col("event_id") * F.lit(IP_EVENT_FACTOR)
    return F.pmod(base, F.lit(1 << 32))


def access_lines(events: DataFrame, repeat_keys: bool = False,
                 keep: list[str] | None = None) -> DataFrame:
    """One raw access-log line (column ``value``) per event.

    ``repeat_keys=True`` makes repeat visits: the address depends on the user
    only and the url on ``k % 10``, so the same (referer, url, ip, ua) key
    recurs at different times, as in a real day of logs."""
    k = F.get_json_object("props", "$.k").try_cast("long")
    url_k = F.pmod(k, F.lit(10)) if repeat_keys else k
    url = F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), url_k.cast("string"))
    cents = F.floor(F.col("value") * 100).cast("long").cast("string")
    ts = F.date_format(F.col("ts").cast("timestamp_ntz"), "dd/MMM/yyyy:HH:mm:ss")
    kind = F.pmod(F.col("event_id"), F.lit(LINE_MODULUS))
    ip = long_to_ip(event_ip(repeat_keys))
    for remainder, text in BAD_ADDRESSES.items():
        ip = F.when(kind == remainder, F.lit(text)).otherwise(ip)
    line = F.concat(
        ip, F.lit(" - - ["), ts, F.lit(' +0000] "GET '),
        url, F.lit(' HTTP/1.1" 200 '), cents, F.lit(f' "{HOST}" "'),
        _pick(REFERERS, F.pmod(F.col("user_id"), F.lit(len(REFERERS)))),
        F.lit('" - "'),
        _pick(USER_AGENTS, F.pmod(F.col("user_id"), F.lit(len(USER_AGENTS)))),
        F.lit('" ' + LOG_TAIL),
    )
    malformed = F.concat(F.lit("malformed "), F.col("event_id").cast("string"))
    line = F.when(kind == MALFORMED_LINE, malformed).otherwise(line)
    return events.select(*(keep or []), line.alias("value"))


def ip_ranges(nation: DataFrame) -> DataFrame:
    """One disjoint address range per nation: ``begin_ip, end_ip, country, area``."""
    k = F.col("n_nationkey").cast("long")
    begin = k * F.lit(RANGE_STRIDE)
    end = (begin + F.lit(RANGE_STRIDE - 1)
           - F.when(F.pmod(k, F.lit(5)) == 0, F.lit(RANGE_GAP)).otherwise(F.lit(0)))
    return nation.select(
        begin.alias("begin_ip"), end.alias("end_ip"),
        _pick(RANGE_COUNTRIES, k).alias("country"),
        F.col("n_name").alias("area"))


def dense_ip_ranges(orders: DataFrame) -> DataFrame:
    """One disjoint range per order, splitting the address space evenly by
    order key (with a gap after every 7th range): a range table as dense as a
    real IP database, whose size grows with the tables. The stride comes from
    a scalar subquery over the same table (no join)."""
    span = orders.select((F.max("o_orderkey").cast("long") + 1).alias("n")).scalar()
    # the stride is projected once, so the scalar subquery is planned once
    staged = orders.select(F.col("o_orderkey").cast("long").alias("_k"), "o_orderpriority",
                           F.floor(F.lit(1 << 32) / span).cast("long").alias("_stride"))
    k, stride = F.col("_k"), F.col("_stride")
    begin = k * stride
    end = begin + stride - 1 - F.when(F.pmod(k, F.lit(7)) == 0, F.floor(stride / 4)).otherwise(0)
    return staged.select(begin.alias("begin_ip"), end.cast("long").alias("end_ip"),
                         _pick(RANGE_COUNTRIES, F.pmod(k, F.lit(len(RANGE_COUNTRIES)))).alias("country"),
                         F.col("o_orderpriority").alias("area"))


# Where the crowded ranges begin, their stride and length.
CROWDED_BEGIN, CROWDED_STRIDE, CROWDED_LENGTH = 3232235520, 5, 4


def crowded_ip_ranges(orders: DataFrame) -> DataFrame:
    """One range of four addresses per order, one after the other with a gap of
    one: thousands of ranges in each ``/16`` that they reach."""
    k = F.col("o_orderkey").cast("long")
    begin = F.lit(CROWDED_BEGIN).cast("long") + k * CROWDED_STRIDE
    return orders.select(begin.alias("begin_ip"), (begin + (CROWDED_LENGTH - 1)).alias("end_ip"),
                         _pick(RANGE_COUNTRIES, F.pmod(k, F.lit(len(RANGE_COUNTRIES)))).alias("country"),
                         F.col("o_orderpriority").alias("area"))


def crowded_event_ip() -> Column:
    """An address among the crowded ranges for each event."""
    return F.lit(CROWDED_BEGIN).cast("long") + F.col("event_id") * 7 + F.pmod(F.col("user_id"), F.lit(11))


def order_messages(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One JSON order message (column ``value``) per event; every field is a
    JSON string, as the producer sends them."""
    from ..operators.orders import encode_orders
    kind = F.pmod(F.col("event_id"), F.lit(ORDER_MODULUS))
    ts = F.col("ts").cast("timestamp_ntz")
    time = F.date_format(ts, "yyyyMMddHHmmss")
    fee = F.floor(F.col("value")).cast("long").cast("string")
    flag = F.when(F.col("event_type") == "purchase", F.lit("1")).otherwise(F.lit("0"))
    broken = F.concat(F.lit("{broken "), F.col("event_id").cast("string"))
    fields = events.select(
        *(keep or []),
        F.when(kind == BROKEN_JSON, broken).alias("_broken"),
        F.when(kind == DAY_ONLY, F.substring(time, 1, 8))
         .when(kind == NO_MINUTE, F.substring(time, 1, 10))
         .when(kind == DASHED_TIME, F.date_format(ts, "yyyy-MM-dd HH:mm"))
         .otherwise(time).alias("time"),
        F.col("user_id").cast("string").alias("userid"),
        F.get_json_object("props", "$.k").alias("courseid"),
        F.when(kind == TEXT_FEE, F.lit("n/a")).when(kind != NO_FEE, fee).alias("fee"),
        F.when(kind != NO_FLAG, flag).alias("flag"),
        F.col("event_id").cast("string").alias("orderid"),
    )
    messages = encode_orders(fields, [*(keep or []), "_broken"])
    return messages.withColumn("value", F.coalesce("_broken", "value")).drop("_broken")
