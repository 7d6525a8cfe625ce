"""User-agent classification by prioritised regex rules.

The original used a third-party parser with a vendored rule file; we keep the
behaviour (first matching rule wins, family + version, ``unknown`` when no
rule matches, all null for an empty agent) and express the rule set as two
projections: first, per kind, the index of the first matching rule (a
``CASE WHEN contains(ua, prefix) AND ua RLIKE pattern`` chain; the cheap
substring test rejects most rules), then the name by index and the version
extracted with the matched rule's pattern only. A rule table of up to
``INLINE_RULES`` rows is collected to build the expressions, so classification
has no join and no shuffle. A larger one is answered through an inverted index
(``rule_index``): each distinct agent meets only the rules that it may match.
``dedup=True`` classifies each distinct agent once and joins the answers back,
broadcast when they fit the row and byte bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import is_not_empty
from ..session import BROADCAST_MAX_BYTES, broadcast_fits, materialize_sized, path_exists
from ..sources.files import RULE_SCHEMA
from .rule_index import RuleIndex

UNKNOWN = "unknown"
# Rule tables up to this size become a CASE chain; larger ones are looked up
# in an index, so neither plans nor the work for an agent grow with the rules.
INLINE_RULES = 100
BROADCAST_MAX_ROWS = 2_000_000

# The default rule set (priority, kind, pattern, name,
# version group). Lower priority wins; browser and robot rules fill the
# browser columns, os rules the os columns.
DEFAULT_RULES = [
    (10, "robot", r"Sogou web spider/([0-9.]+)", "Sogou web spider", 1),
    (11, "robot", r"Baiduspider(?:-[a-z]+)?/([0-9.]+)", "Baiduspider", 1),
    (12, "robot", r"Googlebot/([0-9.]+)", "Googlebot", 1),
    (13, "robot", r"bingbot/([0-9.]+)", "bingbot", 1),
    (20, "browser", r"MetaSr ([0-9.]+)", "Sogou Explorer", 1),
    (21, "browser", r"Edge?/([0-9.]+)", "Edge", 1),
    (22, "browser", r"OPR/([0-9.]+)", "Opera", 1),
    (23, "browser", r"MicroMessenger/([0-9.]+)", "WeChat", 1),
    (24, "browser", r"Chrome/([0-9.]+)", "Chrome", 1),
    (25, "browser", r"Firefox/([0-9.]+)", "Firefox", 1),
    (26, "browser", r"Version/([0-9.]+).*Safari/", "Safari", 1),
    (27, "browser", r"MSIE ([0-9.]+)", "IE", 1),
    (28, "browser", r"Trident/.*rv:([0-9.]+)", "IE", 1),
    (30, "browser", r"CFNetwork/([0-9.]+)", "CFNetwork", 1),
    (31, "browser", r"Go-http-client/([0-9.]+)", "Go-http-client", 1),
    (32, "browser", r"curl/([0-9.]+)", "curl", 1),
    (33, "browser", r"python-requests/([0-9.]+)", "Python Requests", 1),
    (34, "browser", r"okhttp/([0-9.]+)", "OkHttp", 1),
    (50, "os", r"Windows NT ([0-9.]+)", "Windows", 1),
    (51, "os", r"iPhone OS ([0-9_]+)", "iOS", 1),
    (52, "os", r"Android ([0-9.]+)", "Android", 1),
    (53, "os", r"Mac OS X ([0-9_.]+)", "Mac OS X", 1),
    (54, "os", r"Darwin/([0-9.]+)", "Darwin", 1),
    (55, "os", r"CrOS", "Chrome OS", 0),
    (56, "os", r"Linux", "Linux", 0),
]

UA_COLUMNS = ["browsername", "browserversion", "osname", "osversion"]


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_RULES, RULE_SCHEMA)


def _rule_list(rules) -> list[tuple]:
    if rules is None:
        return sorted(DEFAULT_RULES)
    if isinstance(rules, DataFrame):
        rules = [tuple(r) for r in rules.collect()]
    return sorted(rules, key=lambda r: (r[0], r[1], r[2]))


_META = set("\\.^$|?*+()[]{}")
_QUANTIFIERS = set("?*+{")


def literal_prefix(pattern: str) -> str | None:
    """The literal text every match of ``pattern`` starts with, if the
    pattern begins with at least two plain characters (no alternation)."""
    if "|" in pattern:
        return None
    out = []
    for ch in pattern:
        if ch in _META:
            if ch in _QUANTIFIERS and out:
                out.pop()  # the quantifier makes the previous char optional
            break
        out.append(ch)
    return "".join(out) if len(out) >= 2 else None


def _matches(ua: Column, pattern: str) -> Column:
    # a substring test first: cheap, and false for most rules on most rows
    prefix = literal_prefix(pattern)
    test = ua.rlike(pattern)
    return test if prefix is None else (ua.contains(prefix) & test)


def _match_index(ua: Column, rules: list[tuple]) -> Column:
    """1-based index of the first rule whose pattern matches (0: none; null:
    no agent)."""
    out = F.when(~is_not_empty(ua), F.lit(None).cast("int"))
    for i, rule in enumerate(rules, 1):
        out = out.when(_matches(ua, rule[2]), F.lit(i))
    return out.otherwise(F.lit(0))


def _name_version(ua: Column, idx: Column, rules: list[tuple]) -> tuple[Column, Column]:
    # the matched rule is looked up by its index, and only its pattern is
    # evaluated again, for its group: the code does not grow with the rules
    known = [F.struct(F.lit(r[3]).alias("name"), F.lit(r[2]).alias("pattern"), F.lit(r[4]).alias("group"))
             for r in [(0, "", "", UNKNOWN, 0), *rules]]
    rule = F.get(F.array(*known), idx)
    text = F.call_function("regexp_extract", ua, rule["pattern"], rule["group"])
    version = F.coalesce(F.when(rule["group"] > 0, F.nullif(text, F.lit(""))), F.lit(UNKNOWN))
    return rule["name"], F.when(idx.isNotNull(), version)


def _split(rules) -> tuple[list[tuple], list[tuple]]:
    rs = _rule_list(rules)
    return ([r for r in rs if r[1] in ("browser", "robot")], [r for r in rs if r[1] == "os"])


def _index_columns(ua: Column, browser, system) -> dict[str, Column]:
    return {"_ua_b": _match_index(ua, browser), "_ua_o": _match_index(ua, system)}


def _output_columns(ua: Column, browser, system) -> dict[str, Column]:
    cols = {}
    for kind, idx, rules in (("browser", "_ua_b", browser), ("os", "_ua_o", system)):
        cols[f"{kind}name"], cols[f"{kind}version"] = _name_version(ua, F.col(idx), rules)
    return cols


def _is_large(rules) -> bool:
    return isinstance(rules, DataFrame) and len(rules.limit(INLINE_RULES + 1).collect()) > INLINE_RULES


def _answers(agents: DataFrame, rules, ua: str = "ua") -> DataFrame:
    """Distinct agents with their answers."""
    if not _is_large(rules) and not isinstance(rules, RuleIndex):
        browser, system = _split(rules)
        index = [c.alias(k) for k, c in _index_columns(F.col(ua), browser, system).items()]
        # a generator of one row: the rules' code is not in one generated method
        # with the rest of the job, which would be too large for the JVM to compile
        staged = agents.select("*", F.inline(F.array(F.struct(*index))))
        return staged.withColumns(_output_columns(F.col(ua), browser, system)).drop("_ua_b", "_ua_o")
    index = rules if isinstance(rules, RuleIndex) else RuleIndex(rules)
    found = index.first_rules(agents.withColumnRenamed(ua, "ua"))

    def version(rule: Column) -> Column:
        text = F.call_function("regexp_extract", F.col("ua"), rule["pattern"], rule["version_group"])
        return F.coalesce(F.when(rule["version_group"] > 0, F.nullif(text, F.lit(""))), F.lit(UNKNOWN))

    cols = {}
    for kind in ("browser", "os"):
        cols[f"{kind}name"] = F.coalesce(F.col(f"{kind}.name"), F.lit(UNKNOWN))
        cols[f"{kind}version"] = version(F.col(kind))
    present = is_not_empty("ua")
    return found.select(F.col("ua").alias(ua), *[F.when(present, v).alias(c) for c, v in cols.items()])


def _join_answers(df: DataFrame, answers: DataFrame, ua_col: str, max_rows: int) -> DataFrame:
    """Answers of the distinct agents back on all rows; written once, with
    the size that decides between broadcast and shuffle taken on the way."""
    table, rows, size = materialize_sized(answers)
    if rows <= max_rows and size <= BROADCAST_MAX_BYTES:
        table = F.broadcast(table)
    return df.join(table, on=ua_col, how="left")


def classify(df: DataFrame, rules=None, ua_col: str = "ua", *, dedup: bool = False,
             broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Add ``browsername, browserversion, osname, osversion``.
    ``rules``: a table, a list, a prepared ``RuleIndex``, or the default rules."""
    if dedup or isinstance(rules, RuleIndex) or _is_large(rules):
        distinct = df.select(ua_col).where(F.col(ua_col).isNotNull()).distinct()
        return _join_answers(df, _answers(distinct, rules, ua_col), ua_col, broadcast_max_rows)
    return _answers(df, rules, ua_col)


# --- a classification cache kept between runs -------------------------------

def _rules_key(rules) -> str:
    import hashlib
    if _is_large(rules):
        # the same for the same rows in any order
        row = F.xxhash64(*rules.columns)
        text = repr(tuple(rules.distinct().agg(F.count(F.lit(1)), F.bit_xor(row),
                                               F.sum(F.pmod(row, F.lit(1 << 31)))).first()))
    else:
        text = repr([tuple(r) for r in _rule_list(rules)])
    return hashlib.sha1(text.encode("utf-8")).hexdigest()[:12]


def cache_location(cache_path: str, rules=None) -> str:
    """Answers are stored per rule set, so changed rules never reuse them."""
    return f"{cache_path}/rules={_rules_key(rules)}"


def _read_cache(spark: SparkSession, location: str) -> DataFrame | None:
    if not path_exists(spark, location):
        return None
    return spark.read.schema("ua STRING, browsername STRING, browserversion STRING, "
                             "osname STRING, osversion STRING").parquet(location)


def classify_cached(df: DataFrame, cache_path: str, rules=None, ua_col: str = "ua", *,
                    broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``classify`` that first looks agents up in answers stored by
    ``update_cache``: a join on the agent text (broadcast below the bounds,
    by shuffle above), with the rule chain evaluated only for agents not in
    the cache, or the rule index asked for these if the rule table is large.
    Without a cache it is plain ``classify``."""
    spark = df.sparkSession
    known = _read_cache(spark, cache_location(cache_path, rules))
    if known is None:
        return classify(df, rules, ua_col)
    # one answer per agent even if two runs appended the same agent (a
    # duplicate key here would duplicate looked-up rows)
    one = (known.groupBy("ua").agg(F.min(F.struct(*UA_COLUMNS)).alias("_a"))
                .select("ua", *[F.col(f"_a.{c}").alias(c) for c in UA_COLUMNS]))
    if _is_large(rules):
        new = (df.select(F.col(ua_col).alias("ua")).where(F.col("ua").isNotNull()).distinct()
               .join(known.select("ua"), "ua", "left_anti"))
        both = one.union(_answers(new, rules).select("ua", *UA_COLUMNS)).withColumnRenamed("ua", ua_col)
        return _join_answers(df, both, ua_col, broadcast_max_rows)
    k = one.select(F.col("ua").alias("_k_ua"), *[F.col(c).alias(f"_k_{c}") for c in UA_COLUMNS])
    if broadcast_fits(known, broadcast_max_rows):
        k = F.broadcast(k)
    joined = df.join(k, F.col(ua_col) == F.col("_k_ua"), "left")
    ua = F.col(ua_col)
    hit = F.col("_k_ua").isNotNull()
    browser, system = _split(rules)
    # the rule chain runs only for agents the cache does not know
    staged = joined.withColumns({k2: F.when(~hit, v) for k2, v in
                                 _index_columns(ua, browser, system).items()})
    computed = _output_columns(ua, browser, system)
    out = staged.withColumns({c: F.when(hit, F.col(f"_k_{c}")).otherwise(computed[c])
                              for c in UA_COLUMNS})
    return out.drop("_ua_b", "_ua_o", "_k_ua", *[f"_k_{c}" for c in UA_COLUMNS])


def update_cache(df: DataFrame, cache_path: str, rules=None, ua_col: str = "ua") -> int:
    """Classify the distinct agents of ``df`` that the cache does not know
    yet and append them (partial aggregation first, then an anti-join).
    Returns how many were added. Run it after a day's ETL; appends are
    idempotent in effect because lookups only need one answer per agent."""
    spark = df.sparkSession
    location = cache_location(cache_path, rules)
    ua = F.col(ua_col)
    distinct = df.select(ua.alias("ua")).where(F.col("ua").isNotNull()).distinct()
    known = _read_cache(spark, location)
    if known is not None:
        distinct = distinct.join(known.select("ua"), "ua", "left_anti")
    fresh, added, _ = materialize_sized(_answers(distinct, rules).select("ua", *UA_COLUMNS))
    if added:
        fresh.write.mode("append").parquet(location)
    return added
