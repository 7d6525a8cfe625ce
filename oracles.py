"""DuckDB SQL for the correctness oracle.

Each query of ``__spark_entry__.queries()`` has an equivalent here that
DuckDB runs on the same parquet tables (views ``events``, ``nation`` ...).
The derived inputs (access lines, IP ranges, order messages) are rebuilt by
the same formulas as ``weblens.sources.derived``; every rule (regions, user
agents, row-key CRC32) and its lists are stated independently here.
"""

from __future__ import annotations

from weblens.sources import derived as d  # the formulas of the inputs; no code under test

# Fixed values, stated here again so that the library's own lists are tested.
AUTONOMOUS_REGIONS = ["广西", "西藏", "宁夏", "新疆"]
MUNICIPALITIES = ["上海", "北京", "重庆", "天津"]
SPECIAL_REGIONS = ["香港", "澳门"]
WIDE_COLUMNS = ["ip", "country", "province", "city", "formattime", "method", "url", "protocal", "status",
                "bytessent", "referer", "browsername", "browserversion", "osname", "osversion"]
# (pattern, name, version group) in order of priority.
BROWSERS = [
    (r"Sogou web spider/([0-9.]+)", "Sogou web spider", 1),
    (r"Baiduspider(?:-[a-z]+)?/([0-9.]+)", "Baiduspider", 1),
    (r"Googlebot/([0-9.]+)", "Googlebot", 1),
    (r"bingbot/([0-9.]+)", "bingbot", 1),
    (r"MetaSr ([0-9.]+)", "Sogou Explorer", 1),
    (r"Edge?/([0-9.]+)", "Edge", 1),
    (r"OPR/([0-9.]+)", "Opera", 1),
    (r"MicroMessenger/([0-9.]+)", "WeChat", 1),
    (r"Chrome/([0-9.]+)", "Chrome", 1),
    (r"Firefox/([0-9.]+)", "Firefox", 1),
    (r"Version/([0-9.]+).*Safari/", "Safari", 1),
    (r"MSIE ([0-9.]+)", "IE", 1),
    (r"Trident/.*rv:([0-9.]+)", "IE", 1),
    (r"CFNetwork/([0-9.]+)", "CFNetwork", 1),
    (r"Go-http-client/([0-9.]+)", "Go-http-client", 1),
    (r"curl/([0-9.]+)", "curl", 1),
    (r"python-requests/([0-9.]+)", "Python Requests", 1),
    (r"okhttp/([0-9.]+)", "OkHttp", 1),
]
SYSTEMS = [
    (r"Windows NT ([0-9.]+)", "Windows", 1),
    (r"iPhone OS ([0-9_]+)", "iOS", 1),
    (r"Android ([0-9.]+)", "Android", 1),
    (r"Mac OS X ([0-9_.]+)", "Mac OS X", 1),
    (r"Darwin/([0-9.]+)", "Darwin", 1),
    (r"CrOS", "Chrome OS", 0),
    (r"Linux", "Linux", 0),
]


def _q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _ip_text(n: str) -> str:
    return (f"concat_ws('.', ({n} >> 24) & 255, ({n} >> 16) & 255, "
            f"({n} >> 8) & 255, {n} & 255)")


def events_cte(repeat_keys: bool = False) -> str:
    """``ev``: events plus the derived address, url and log fields; ``lg``:
    the log lines with their unusable addresses; ``good``: the parsable ones."""
    bad = " ".join(f"WHEN {k} THEN {_q(v)}" for k, v in d.BAD_ADDRESSES.items())
    unlocated = ", ".join(str(k) for k in [*d.BAD_ADDRESSES, d.MALFORMED_LINE])
    ip = (f"(user_id * {d.IP_USER_FACTOR}) % 4294967296" if repeat_keys else
          f"(user_id * {d.IP_USER_FACTOR} + event_id * {d.IP_EVENT_FACTOR}) % 4294967296")
    k = "TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)"
    url_k = f"({k} % 10)" if repeat_keys else k
    return f"""ev AS (
  SELECT event_id, user_id, event_type, ts, value, {ip} AS ip_long,
         {_ip_text(ip)} AS ip,
         '[' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000]' AS time,
         'GET' AS method,
         '/' || event_type || '/' || CAST({url_k} AS VARCHAR) AS url,
         'HTTP/1.1' AS protocal,
         '200' AS status,
         CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) AS bytessent,
         '"' || {_list(d.REFERERS)}[(user_id % {len(d.REFERERS)}) + 1] || '"' AS referer,
         {_list(d.USER_AGENTS)}[(user_id % {len(d.USER_AGENTS)}) + 1] AS ua,
         strftime(ts, '%Y%m%d%H%M') AS formattime,
         date_trunc('second', ts) AS event_ts,
         event_id % {d.LINE_MODULUS} AS kind
  FROM events),
lg AS (
  SELECT * REPLACE (CASE kind {bad} WHEN {d.MALFORMED_LINE} THEN 'malformed' ELSE ip END AS ip,
                    CASE WHEN kind IN ({unlocated}) THEN NULL ELSE ip_long END AS ip_long)
  FROM ev),
good AS (SELECT * FROM lg WHERE kind <> {d.MALFORMED_LINE})"""


def lines_select() -> str:
    return (f"""CASE WHEN kind = {d.MALFORMED_LINE} THEN 'malformed ' || event_id ELSE """
            f"""ip || ' - - ' || time || ' "' || method || ' ' || url || ' ' || protocal """
            f"""|| '" ' || status || ' ' || bytessent || ' "{d.HOST}" ' || referer """
            f"""|| ' - "' || ua || '" ' || '{d.LOG_TAIL}' END""")


def ranges_cte() -> str:
    k = "CAST(n_nationkey AS BIGINT)"
    return f"""rg AS (
  SELECT {k} * {d.RANGE_STRIDE} AS begin_ip,
         {k} * {d.RANGE_STRIDE} + {d.RANGE_STRIDE - 1}
           - CASE WHEN {k} % 5 = 0 THEN {d.RANGE_GAP} ELSE 0 END AS end_ip,
         {_list(d.RANGE_COUNTRIES)}[{k} + 1] AS country,
         n_name AS area
  FROM nation)"""


def dense_ranges_cte() -> str:
    k = "CAST(o_orderkey AS BIGINT)"
    stride = "CAST(floor(4294967296 / ((SELECT max(o_orderkey) FROM orders) + 1)) AS BIGINT)"
    return f"""rg AS (
  SELECT {k} * {stride} AS begin_ip,
         CAST({k} * {stride} + {stride} - 1
           - CASE WHEN {k} % 7 = 0 THEN floor({stride} / 4) ELSE 0 END AS BIGINT) AS end_ip,
         {_list(d.RANGE_COUNTRIES)}[({k} % {len(d.RANGE_COUNTRIES)}) + 1] AS country,
         o_orderpriority AS area
  FROM orders)"""


def region_sql(c: str) -> dict[str, str]:
    """The region rules as three CASE expressions over text ``c``."""
    n = f"length({c})"
    flag = f"substring({c}, 1, 2)"
    p = f"instr({c}, '省')"
    default = (f"({c} IS NULL OR {n} = 0 OR {c} = '局域网' "
               f"OR starts_with(trim({c}), 'CZ88'))")
    prov = f"({p} > 1)"
    short = f"({n} < 2)"
    mongo = f"({flag} = '内蒙')"
    auto = f"({flag} IN ({', '.join(_q(x) for x in AUTONOMOUS_REGIONS)}))"
    muni = f"({flag} IN ({', '.join(_q(x) for x in MUNICIPALITIES)}))"
    spec = f"({flag} IN ({', '.join(_q(x) for x in SPECIAL_REGIONS)}))"
    rest2 = f"substring({c}, 3)"
    rest3 = f"substring({c}, 4)"
    after = f"substring({c}, {p})"

    def upto(rest, ch):
        return f"CASE WHEN instr({rest}, '{ch}') > 1 THEN substring({rest}, 1, instr({rest}, '{ch}')) END"

    country = (f"CASE WHEN {default} OR {prov} THEN '中国' WHEN {short} THEN NULL "
               f"WHEN {mongo} OR {auto} OR {muni} OR {spec} THEN '中国' ELSE {c} END")
    province = (f"CASE WHEN {default} THEN '上海市' WHEN {prov} THEN substring({c}, 1, {p}) "
                f"WHEN {short} THEN NULL WHEN {mongo} THEN '内蒙古自治区' WHEN {auto} THEN {flag} "
                f"WHEN {muni} THEN {flag} || '市' WHEN {spec} THEN {flag} || '特别行政区' END")
    city = (f"CASE WHEN {default} THEN NULL "
            f"WHEN {prov} THEN CASE WHEN instr({after}, '市') > 0 "
            f"THEN substring({c}, {p} + 1, instr({after}, '市') - 1) END "
            f"WHEN {short} THEN NULL "
            f"WHEN {mongo} AND {n} >= 3 THEN {upto(rest3, '市')} "
            f"WHEN {auto} THEN {upto(rest2, '市')} "
            f"WHEN {muni} AND {n} >= 3 THEN {upto(rest3, '区')} END")
    return {"country": country, "province": province, "city": city}


def located_region_sql() -> dict[str, str]:
    """The region fields of a located row; null where the address is none."""
    return {k: f"CASE WHEN ip_long IS NOT NULL THEN {v} END"
            for k, v in region_sql("loc_country").items()}


def ua_sql(ua: str) -> dict[str, str]:
    """The default user-agent rules as CASE expressions over ``ua``."""
    def chain(rs, version):
        parts = []
        for pat, name, grp in rs:
            val = ("'unknown'" if not grp else
                   f"coalesce(nullif(regexp_extract({ua}, {_q(pat)}, {grp}), ''), 'unknown')") \
                if version else _q(name)
            parts.append(f"WHEN regexp_matches({ua}, {_q(pat)}) THEN {val}")
        body = " ".join(parts)
        return f"CASE WHEN {ua} IS NULL OR length({ua}) = 0 THEN NULL {body} ELSE 'unknown' END"

    return {"browsername": chain(BROWSERS, False), "browserversion": chain(BROWSERS, True),
            "osname": chain(SYSTEMS, False), "osversion": chain(SYSTEMS, True)}


# CRC32 (polynomial 0xEDB88320) of the UTF-8 bytes of a text, in SQL: the
# 256-entry table is generated by its rule, then folded over the bytes.
CRC_TABLE_CTE = """crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END,
           n::BIGINT)) AS tbl)"""


def crc32_sql(text: str) -> str:
    b = f"encode({text})"
    return (f"xor(list_reduce(list_transform(range(octet_length({b})), "
            f"lambda i: ('0x' || substring(hex({b}), 2 * i + 1, 2))::INT), "
            f"lambda acc, x: xor(crc.tbl[(xor(acc, x) & 255) + 1], acc >> 8), "
            f"4294967295::BIGINT), 4294967295)")


def visit_sql() -> str:
    """The 128-bit identity of a visit."""
    parts = ", ".join(f"coalesce(octet_length(encode({c})) || ':' || {c}, '-')" for c in ("referer", "url", "ip", "ua"))
    return f"md5(concat_ws(',', {parts}))"


def geo_cte(src: str = "good", name: str = "geo") -> str:
    """``name``: rows of ``src`` with located country/area and region fields."""
    r = located_region_sql()
    return f"""{name}_loc AS (
  SELECT s.*, CASE WHEN r.begin_ip IS NULL THEN '未知国家' ELSE r.country END AS loc_country,
         CASE WHEN r.begin_ip IS NULL THEN '未知地区' ELSE r.area END AS loc_area
  FROM {src} s LEFT JOIN rg r ON s.ip_long BETWEEN r.begin_ip AND r.end_ip),
{name} AS (
  SELECT *, coalesce({r['country']}, 'unknown') AS country,
            coalesce({r['province']}, 'unknown') AS province,
            coalesce({r['city']}, 'unknown') AS city
  FROM {name}_loc)"""


def wide_cte(day: str, dedup: bool = True) -> str:
    """``wide``: the keyed, de-duplicated wide rows of the repeat-key log."""
    u = ua_sql("ua")
    cols = ", ".join(WIDE_COLUMNS)
    key = crc32_sql("coalesce(referer,'') || coalesce(url,'') || coalesce(ip,'') || coalesce(ua,'')")
    base = f"""{events_cte(True)},
{ranges_cte()},
{CRC_TABLE_CTE},
{geo_cte()},
enriched AS (
  SELECT geo.*, {", ".join(f"{v} AS {k}" for k, v in u.items())},
         '{day}_' || CAST({key} AS VARCHAR) AS rowkey, {visit_sql()} AS visit
  FROM geo, crc)"""
    if not dedup:
        return base + f",\nwide AS (SELECT rowkey, visit, {cols}, event_ts FROM enriched)"
    order = ("event_ts DESC, status DESC, bytessent DESC, method DESC, protocal DESC, "
             + ", ".join(f"{c} DESC" for c in WIDE_COLUMNS
                         if c not in ("status", "bytessent", "method", "protocal")))
    return base + f""",
ranked AS (
  SELECT rowkey, visit, {cols}, event_ts,
         row_number() OVER (PARTITION BY referer, url, ip, ua ORDER BY {order}) AS rn
  FROM enriched),
wide AS (SELECT rowkey, visit, {cols}, event_ts FROM ranked WHERE rn = 1)"""


def orders_cte(digits: int = 12, far_future: bool = False) -> str:
    """``ord``: parsed order messages (fields as the producer sends them, null
    where the message is broken); ``metric``: with their paid metrics; ``om``:
    those whose time begins with ``digits`` digits."""
    k = "json_extract_string(props, '$.k')"
    at = ("CASE WHEN event_id % 83 = 0 THEN make_timestamp(2099, month(ts), 1, hour(ts), minute(ts), second(ts)) ELSE ts END"
          if far_future else "ts")
    return f"""sent AS (
  SELECT ts, event_id, CAST(event_id AS VARCHAR) AS sent_id, strftime({at}, '%Y%m%d%H%M%S') AS time,
         CAST(user_id AS VARCHAR) AS userid,
         {k} AS courseid,
         CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS fee,
         CASE WHEN event_type = 'purchase' THEN '1' ELSE '0' END AS flag,
         CAST(event_id AS VARCHAR) AS orderid,
         event_id % {d.ORDER_MODULUS} AS kind, strftime({at}, '%Y-%m-%d %H:%M') AS dashed
  FROM events),
ord AS (
  SELECT ts, event_id, sent_id, kind, CASE kind WHEN {d.BROKEN_JSON} THEN NULL WHEN {d.DAY_ONLY} THEN substring(time, 1, 8)
                   WHEN {d.NO_MINUTE} THEN substring(time, 1, 10)
                   WHEN {d.DASHED_TIME} THEN dashed ELSE time END AS time,
         CASE WHEN kind <> {d.BROKEN_JSON} THEN userid END AS userid,
         CASE WHEN kind <> {d.BROKEN_JSON} THEN courseid END AS courseid,
         CASE WHEN kind = {d.TEXT_FEE} THEN 'n/a'
              WHEN kind NOT IN ({d.NO_FEE}, {d.BROKEN_JSON}) THEN fee END AS fee,
         CASE WHEN kind NOT IN ({d.NO_FLAG}, {d.BROKEN_JSON}) THEN flag END AS flag,
         CASE WHEN kind <> {d.BROKEN_JSON} THEN orderid END AS orderid
  FROM sent),
metric AS (
  SELECT *, substring(time, 1, 8) AS day, substring(time, 9, 2) AS hour,
         substring(time, 11, 2) AS minute,
         CAST(1 AS BIGINT) AS total,
         CAST(CASE WHEN flag = '1' THEN 1 ELSE 0 END AS BIGINT) AS success,
         CAST(CASE WHEN flag = '1' THEN coalesce(TRY_CAST(fee AS BIGINT), 0) ELSE 0 END AS BIGINT)
           AS fee_paid
  FROM ord),
om AS (SELECT * FROM metric WHERE regexp_matches(time, '^[0-9]{{{digits}}}'))"""


def rollup_sql() -> str:
    return f"""WITH {orders_cte()},
keys AS (
  SELECT day AS stat_key, total, success, fee_paid FROM om
  UNION ALL SELECT day || hour, total, success, fee_paid FROM om)
SELECT stat_key, CAST(sum(total) AS BIGINT) AS total, CAST(sum(success) AS BIGINT) AS success,
       CAST(sum(fee_paid) AS BIGINT) AS fee
FROM keys GROUP BY stat_key"""


def _wide_select(day: str, select: str, tail: str = "") -> str:
    return f"WITH {wide_cte(day)}\n{select}\n{tail}"


def oracle_queries(day: str = "20240101") -> dict[str, str]:
    ev = events_cte(False)
    evr = events_cte(True)
    recs = f"WITH {ev}\n"
    u = ua_sql("ua")
    r = located_region_sql()
    cells = ("SELECT rowkey, visit, 'o' AS family, q.qualifier, q.value, CAST(0 AS BIGINT) AS version "
             "FROM wide, (SELECT unnest(["
             + ", ".join(f"'{c}'" for c in WIDE_COLUMNS) + "]) AS qualifier) AS qn, "
             "LATERAL (SELECT qn.qualifier AS qualifier, CASE qn.qualifier "
             + " ".join(f"WHEN '{c}' THEN {c}" for c in WIDE_COLUMNS)
             + " END AS value) AS q")
    wide_cols = ", ".join(WIDE_COLUMNS)
    located = f"""WITH {ev}, {ranges_cte()},
loc AS (
  SELECT s.ip_long, r.begin_ip, r.end_ip,
         CASE WHEN r.begin_ip IS NULL THEN '未知国家' ELSE r.country END AS geo_country,
         CASE WHEN r.begin_ip IS NULL THEN '未知地区' ELSE r.area END AS geo_area
  FROM ev s LEFT JOIN rg r ON s.ip_long BETWEEN r.begin_ip AND r.end_ip)
"""
    dense = f"""WITH {ev}, {dense_ranges_cte()}
SELECT s.ip_long, r.begin_ip AS range_begin, r.end_ip AS range_end,
       CASE WHEN r.begin_ip IS NULL THEN '未知国家' ELSE r.country END AS geo_country,
       CASE WHEN r.begin_ip IS NULL THEN '未知地区' ELSE r.area END AS geo_area
FROM ev s LEFT JOIN rg r ON s.ip_long BETWEEN r.begin_ip AND r.end_ip"""
    q = {
        "j1_dense_range_join": dense,
        "s1_read_access_log": recs + f"SELECT {lines_select()} AS value FROM lg",
        "s3_widetable_scan": _wide_select(day, "SELECT country, province, browsername FROM wide"),
        "s5_load_ranges": f"WITH {ranges_cte()} SELECT begin_ip, end_ip, country, area FROM rg",
        "s7_get_by_rowkey": _wide_select(
            day, f"SELECT w.rowkey, w.visit, {', '.join('w.' + c for c in WIDE_COLUMNS)}, "
                 f"'{day}' AS day FROM wide w WHERE w.rowkey IN (SELECT rowkey FROM enriched WHERE url LIKE '/purchase/%')"
                 " AND url LIKE '/purchase/%'"),
        "s8_cell_scan": _wide_select(day, cells),
        "s9_read_counter": f"""WITH t AS ({rollup_sql()}),
c AS (
  SELECT 'order-' || stat_key AS stat_key, 'total' AS field, total AS value FROM t
  UNION ALL SELECT 'order-' || stat_key, 'success', success FROM t
  UNION ALL SELECT 'order-' || stat_key, 'fee', fee FROM t)
SELECT * FROM c WHERE length(stat_key) = 14""",
        "p1_parse_access_log": recs + "SELECT ip, time, method, url, protocal, status, bytessent, referer, ua FROM good",
        "p1_rejects": recs + f"SELECT {lines_select()} AS value FROM lg WHERE kind = {d.MALFORMED_LINE}",
        "p2_strip_quotes": recs + "SELECT method, protocal, referer FROM good",
        "p3_user_agent": recs + "SELECT ua FROM good",
        "p4_time_field": recs + "SELECT time FROM good",
        "p5_format_time": recs + "SELECT time, formattime FROM good",
        "p6_blank_tests": """SELECT role,
  CAST(sum(CASE WHEN regexp_matches(text, '\\S') THEN 1 ELSE 0 END) AS BIGINT) AS not_blank,
  CAST(sum(CASE WHEN length(text) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS not_empty,
  count(*) AS n
FROM conversations GROUP BY role""",
        "p7_fill_unknown_geo": f"WITH {ev}, {ranges_cte()}, {geo_cte()} SELECT ip, country, province, city FROM geo",
        "p8_ip_to_long": recs + "SELECT ip, ip_long FROM good",
        "p9_long_to_ip": recs + "SELECT ip_long, ip FROM ev",
        "p11_normalize_region": f"WITH {ev}, {ranges_cte()}, {geo_cte()} SELECT ip, "
                                f"{r['country']} AS country, {r['province']} AS province, "
                                f"{r['city']} AS city FROM geo",
        "p19_line_geo_map": f"""WITH {ev}, {ranges_cte()}, {geo_cte("lg")},
raw AS (SELECT ip, {r['country']} AS country, {r['province']} AS province, {r['city']} AS city FROM geo)
SELECT 'ip' AS geo_key, ip AS geo_value FROM raw
UNION ALL SELECT 'country', country FROM raw
UNION ALL SELECT 'province', province FROM raw
UNION ALL SELECT 'city', city FROM raw""",
        "p12_address": located + """SELECT ip_long, trim(
  CASE WHEN geo_country = ' CZ88.NET' THEN '' ELSE coalesce(geo_country, '') END || ' ' ||
  CASE WHEN geo_area = ' CZ88.NET' THEN '' ELSE coalesce(geo_area, '') END) AS address FROM loc""",
        "p13_rowkey": f"WITH {ev}, {CRC_TABLE_CTE}\nSELECT url, ip, '{day}_' || CAST("
                      + crc32_sql("referer || url || ip || ua") + " AS VARCHAR) AS rowkey FROM good, crc",
        "p14_time_parts": f"WITH {orders_cte()} SELECT orderid, day, hour, minute FROM metric",
        "p15_parse_orders": f"WITH {orders_cte()} SELECT time, userid, courseid, fee, flag, orderid, "
                            "TRY_CAST(fee AS BIGINT) AS fee_long FROM ord",
        "p16_paid_metric": f"WITH {orders_cte()} SELECT orderid, day, total, success, fee_paid AS fee FROM metric",
        "p20_classify_user_agent": recs + "SELECT ua, " + ", ".join(f"{v} AS {k}" for k, v in u.items()) + " FROM good",
        "p21_encode_orders": f"WITH {orders_cte()} SELECT '{{' || concat_ws(',', "
                             + ", ".join(f"""'"{c}":"' || {c} || '"'""" for c in
                                         ("time", "userid", "courseid", "fee", "flag", "orderid"))
                             + ") || '}' AS value FROM ord",
        "j1_ip_range_join": located + "SELECT ip_long, begin_ip AS range_begin, end_ip AS range_end, "
                                      "geo_country, geo_area FROM loc",
        "j3_distinct_ip_lookup": located + "SELECT ip_long, begin_ip AS range_begin, end_ip AS range_end, "
                                           "geo_country, geo_area FROM loc",
        "f1_find_ranges": f"WITH {ranges_cte()} SELECT {_ip_text('begin_ip')} AS begin_ip, "
                          f"{_ip_text('end_ip')} AS end_ip, country, area FROM rg "
                          "WHERE coalesce(contains(country, '省'), false) OR coalesce(contains(area, '省'), false)",
        "f2_range_end_ips": f"WITH {ranges_cte()} SELECT {_ip_text('end_ip')} AS end_ip FROM rg",
        "f3_area_lookup": located + "SELECT ip_long, geo_area FROM loc",
        "a1_top_regions": _wide_select(day, "SELECT country, province, count(*) AS cnt FROM wide "
                                            "GROUP BY country, province "
                                            "ORDER BY cnt DESC, country ASC NULLS FIRST, province ASC NULLS FIRST LIMIT 10"),
        "a2_browser_counts": _wide_select(day, "SELECT browsername, count(*) AS cnt FROM wide GROUP BY browsername"),
        "a5_upsert_latest": _wide_select(day, f"SELECT rowkey, visit, {wide_cols} FROM wide"),
        "r3_cells_to_rows": _wide_select(day, f"SELECT rowkey, visit, {wide_cols} FROM wide"),
        "r4_sorted_cells": _wide_select(day, cells),
        "k1_write_day": _wide_select(day, f"SELECT rowkey, visit, {wide_cols}, '{day}' AS day FROM wide"),
        "k3_bulk_write_cells": _wide_select(day, cells),
        "k4_replace_day": _wide_select(day, "SELECT browsername AS browser, count(*) AS cnt, "
                                            f"'{day}' AS day FROM wide GROUP BY browsername"),
        "k9_put_cells": _wide_select(day, cells.replace("CAST(0 AS BIGINT) AS version",
                                                        "CASE WHEN q.qualifier = 'status' THEN CAST(2 AS BIGINT) "
                                                        "ELSE CAST(1 AS BIGINT) END AS version")
                                     .replace("WHEN 'status' THEN status", "WHEN 'status' THEN '304'")),
        "t3_daily_paid": f"WITH {orders_cte(8)} SELECT day, CAST(sum(success) AS BIGINT) AS paid_count, "
                         "CAST(sum(fee_paid) AS BIGINT) AS paid_fee FROM om GROUP BY day",
        "t4_order_rollup": rollup_sql(),
        "t5_stream_order_counters": rollup_sql(),
        "k5_daily_counters": f"""WITH {orders_cte(8)},
t AS (SELECT day, CAST(sum(success) AS BIGINT) AS success, CAST(sum(fee_paid) AS BIGINT) AS fee
      FROM om GROUP BY day)
SELECT 'orderCount-' || day AS stat_key, success AS value FROM t
UNION ALL SELECT 'orderFee-' || day, fee FROM t""",
        "k6_counter_sink": f"""WITH t AS ({rollup_sql()})
SELECT 'order-' || stat_key AS stat_key, 'total' AS field, total AS value FROM t
UNION ALL SELECT 'order-' || stat_key, 'success', success FROM t
UNION ALL SELECT 'order-' || stat_key, 'fee', fee FROM t""",
    }
    q["s4_dead_letters"] = f"""WITH {orders_cte()}
SELECT CASE WHEN kind = {d.BROKEN_JSON} THEN '{{broken ' || orderid_sent ELSE value END AS value
FROM (SELECT metric.kind, metric.sent_id AS orderid_sent, '{{' || concat_ws(',', """ + ", ".join(
        f"""'"{c}":"' || metric.{c} || '"'""" for c in ("time", "userid", "courseid", "fee", "flag", "orderid")) + f""") || '}}' AS value, metric.time
FROM metric) WHERE time IS NULL OR NOT regexp_matches(time, '^[0-9]{{12}}')"""
    hours = lambda h, far: f"""WITH {orders_cte(12, far)},
late AS (SELECT *, ts + to_hours(CAST(event_id % {h} AS INT)) AS arrival FROM om),
keys AS (
  SELECT day AS stat_key, total, success, fee_paid, arrival, strptime(day, '%Y%m%d') + INTERVAL 24 HOURS AS over FROM late
  UNION ALL SELECT day || hour, total, success, fee_paid, arrival, strptime(day || hour, '%Y%m%d%H') + INTERVAL 1 HOUR FROM late)"""  # noqa: E731
    q["t6_watermark_day_total"] = hours(24, True) + """
SELECT stat_key, CAST(sum(total) AS BIGINT) AS total, CAST(sum(success) AS BIGINT) AS success,
       CAST(sum(fee_paid) AS BIGINT) AS fee FROM keys GROUP BY stat_key"""
    q["t6_late_orders"] = hours(5, False) + """
SELECT stat_key, count(*) AS total, CASE WHEN arrival > over + INTERVAL 1 HOUR THEN 'late' ELSE 'counted' END AS outcome
FROM keys GROUP BY ALL"""
    q["p1_one_pass"] = _wide_select(
        day, "SELECT (SELECT count(*) FROM wide) AS stored, (SELECT count(*) FROM lg) AS lines, "
             "(SELECT count(*) FROM good) AS good, (SELECT count(*) FROM lg) - (SELECT count(*) FROM good) AS rejected")
    q["j1_crowded_ranges"] = f"""WITH rg AS (
  SELECT {d.CROWDED_BEGIN} + CAST(o_orderkey AS BIGINT) * {d.CROWDED_STRIDE} AS begin_ip,
         {_list(d.RANGE_COUNTRIES)}[(CAST(o_orderkey AS BIGINT) % {len(d.RANGE_COUNTRIES)}) + 1] AS country,
         o_orderpriority AS area FROM orders),
s AS (SELECT {d.CROWDED_BEGIN} + event_id * 7 + user_id % 11 AS ip_long FROM events)
SELECT s.ip_long, r.begin_ip AS range_begin, r.begin_ip + {d.CROWDED_LENGTH - 1} AS range_end,
       CASE WHEN r.begin_ip IS NULL THEN '未知国家' ELSE r.country END AS geo_country,
       CASE WHEN r.begin_ip IS NULL THEN '未知地区' ELSE r.area END AS geo_area
FROM s LEFT JOIN rg r ON s.ip_long BETWEEN r.begin_ip AND r.begin_ip + {d.CROWDED_LENGTH - 1}"""
    q["t1_micro_batches"] = q["t4_order_rollup"]
    q["k3_etl_cells"] = q["k3_bulk_write_cells"]
    q["k7_ensure_table"] = _wide_select(
        day, "SELECT true AS created, false AS again, (SELECT count(DISTINCT coalesce(browsername, '-')) FROM wide) AS stored, "
             "true AS replaced, CAST(0 AS BIGINT) AS left_rows")
    q["k8_describe"] = " UNION ALL ".join(
        f"SELECT '{t}' AS source, CAST(column_index - 1 AS INT) AS place, column_name FROM duckdb_columns() "
        f"WHERE table_name = '{t}'" for t in ("nation", "events", "orders"))
    q["k2_cluster_day"] = q["k1_write_day"]
    q["s7_point_read"] = _wide_select(
        day, f"SELECT rowkey, visit, {wide_cols}, '{day}' AS day FROM wide "
             "WHERE rowkey IN (SELECT rowkey FROM wide WHERE ip = (SELECT min(ip) FROM good))")
    q["k3_raw_cells"] = f"WITH {wide_cte(day, False)}\n" + (
        "SELECT rowkey, visit, 'o' AS family, 'status' AS qualifier, status AS value, "
        "CAST(epoch(event_ts) AS BIGINT) AS version FROM wide "
        "UNION ALL SELECT rowkey, visit, 'o', 'bytessent', bytessent, CAST(epoch(event_ts) AS BIGINT) FROM wide")
    q["r8_report"] = _wide_select(day, "(SELECT country, province, NULL AS browsername, count(*) AS cnt FROM wide "
        "GROUP BY country, province ORDER BY cnt DESC, country ASC NULLS FIRST, province ASC NULLS FIRST LIMIT 10) "
        "UNION ALL SELECT NULL, NULL, browsername, count(*) FROM wide GROUP BY browsername")
    # the curl rule replaced by one rule a major version (up to 999)
    q["s6_load_rules"] = (
        recs + "SELECT ua, "
        + f"CASE WHEN regexp_matches(ua, '^curl/[0-9]{{1,3}}[.][0-9.]') "
          f"THEN 'curl ' || regexp_extract(ua, '^curl/([0-9]+)', 1) ELSE {u['browsername']} END AS browsername, "
        + f"CASE WHEN regexp_matches(ua, '^curl/[0-9]{{1,3}}[.][0-9.]') "
          f"THEN regexp_extract(ua, '^curl/[0-9]+[.]([0-9.]+)', 1) ELSE {u['browserversion']} END AS browserversion, "
        + f"{u['osname']} AS osname, {u['osversion']} AS osversion FROM good")
    shop = f"{_list(d.USER_AGENTS)}[(user_id % {len(d.USER_AGENTS)}) + 1] || ' shop/' || user_id || '.' || (event_id % 7)"
    q["p20_rule_index"] = (
        f"WITH s AS (SELECT {shop} AS ua, user_id, event_id FROM events) SELECT ua, "
        f"CASE WHEN user_id < 10000 THEN 'shop ' || user_id ELSE {u['browsername']} END AS browsername, "
        f"CASE WHEN user_id < 10000 THEN CAST(event_id % 7 AS VARCHAR) ELSE {u['browserversion']} END AS browserversion, "
        f"{u['osname']} AS osname, {u['osversion']} AS osversion FROM s")
    q["a3_browser_counts_df"] = q["a2_browser_counts"]
    q["a4_browser_counts_sql"] = q["a2_browser_counts"]
    q["j2_rule_match_distinct"] = q["p20_classify_user_agent"]
    q["j2_rule_match_cached"] = q["p20_classify_user_agent"]
    return q
