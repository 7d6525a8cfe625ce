"""Access-log line parsing (P1-P6, P13, P18) as pure column expressions.

Every function returns a ``Column`` or a ``DataFrame -> DataFrame`` transform
built from Spark built-ins, so the whole parse stays inside one codegen'd
Project. ANSI mode is assumed on: ``F.get`` instead of ``arr[i]`` (out of range
gives null rather than an error) and ``try_*`` conversions.

Line layout (space separated, quotes are part of the tokens)::

    ip - - [dd/MMM/yyyy:HH:mm:ss Z] "METHOD url PROTOCOL" status bytes "host" "referer" - "ua" ...

Token positions: 0 ip, 3+4 time, 5 method, 6 url, 7 protocol, 8 status,
9 bytes, 11 referer (quotes kept); the user agent is the 8th ``"``-delimited
segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Formats of the log and of the derived minute column.
LOG_TIME_PATTERN = "dd/MMM/yyyy:HH:mm:ss Z"
MINUTE_PATTERN = "yyyyMMddHHmm"

# The parsed record, all strings (D2); ``formattime`` is added by format_time.
PARSED_COLUMNS = ["ip", "time", "method", "url", "protocal", "status",
                  "bytessent", "referer", "ua"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_not_blank(c) -> Column:
    """True when the text has a non-whitespace character (null -> False)."""
    return F.coalesce(_col(c).rlike(r"\S"), F.lit(False))


def is_not_empty(c) -> Column:
    """True when the text is non-null and non-empty."""
    return F.coalesce(F.length(_col(c)) > 0, F.lit(False))


def strip_quotes(c) -> Column:
    """Remove every double quote."""
    return F.translate(_col(c), '"', "")


def java_split(text, sep: str) -> Column:
    """Split on a single character the way the original's ``String.split``
    did: trailing empty pieces are dropped (Spark's ``split`` keeps them).
    Trimming the trailing separators first gives exactly that list."""
    return F.split(F.rtrim(_col(text), F.lit(sep)), "\\" + sep if sep in ".$|()[]{}^?*+\\" else sep)


def user_agent(line) -> Column:
    """The 8th double-quote-delimited segment of the line."""
    return F.get(java_split(line, '"'), 7)


def time_field(tokens: Column) -> Column:
    """Re-join the bracketed time tokens 3 and 4 with one space."""
    return F.concat_ws(" ", F.get(tokens, 3), F.get(tokens, 4))


def event_time(time_col) -> Column:
    """The parsed instant of the bracketed time (TIMESTAMP); the zone offset
    in the text is honoured. Unparsable text gives null."""
    inner = F.regexp_extract(_col(time_col), r"\[(.*)\]", 1)
    return F.try_to_timestamp(inner, F.lit(LOG_TIME_PATTERN))


def minute_of(instant, tz: str | None = None) -> Column:
    """An instant rendered as ``yyyyMMddHHmm`` in ``tz`` (default: the
    session time zone)."""
    instant = _col(instant)
    if tz is None:
        return F.date_format(instant, MINUTE_PATTERN)
    wall = F.convert_timezone(None, F.lit(tz), instant.cast("timestamp_ntz"))
    return F.date_format(wall, MINUTE_PATTERN)


def format_time(time_col, tz: str | None = None) -> Column:
    """``[dd/MMM/yyyy:HH:mm:ss Z]`` -> ``yyyyMMddHHmm`` (P5)."""
    return minute_of(event_time(time_col), tz)


def parse_access_log(df: DataFrame, line_col: str = "value",
                     keep: list[str] | None = None) -> DataFrame:
    """Split raw lines into the D2 fields (P1-P4) plus a ``parse_ok`` flag.

    A line is parsable when it has the 12 space tokens and 8 quote segments
    the layout needs; other rows keep null fields and ``parse_ok = false`` so
    ``split_rejects`` can route them instead of failing the job.

    A line is split by a generator of one row: a filter on the fields stops
    above it, so neither the line nor its parts are made once more for the test,
    and the fields are compiled apart from what made the line."""
    line = F.col(line_col)
    keep = keep or []
    split = F.inline(F.array(F.struct(java_split(line, " ").alias("_toks"), java_split(line, '"').alias("_segs"))))
    toks, segs = F.col("_toks"), F.col("_segs")
    parsed = df.select(*keep, split).select(
        *keep,
        F.get(toks, 0).alias("ip"),
        time_field(toks).alias("time"),
        strip_quotes(F.get(toks, 5)).alias("method"),
        F.get(toks, 6).alias("url"),
        strip_quotes(F.get(toks, 7)).alias("protocal"),
        F.get(toks, 8).alias("status"),
        F.get(toks, 9).alias("bytessent"),
        F.get(toks, 11).alias("referer"),
        F.get(segs, 7).alias("ua"),
        # never null: a null line is a reject, in neither half it would be lost
        F.coalesce((F.size(toks) >= 12) & (F.size(segs) >= 8)
                   & is_not_empty(F.get(toks, 3)), F.lit(False)).alias("parse_ok"),
    )
    return parsed


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of a ``parse_access_log`` result (Q1)."""
    ok = F.col("parse_ok")
    return parsed.where(ok).drop("parse_ok"), parsed.where(~ok)


def rowkey(day, referer="referer", url="url", ip="ip", ua="ua") -> Column:
    """``day + "_" + crc32(referer + url + ip + ua)`` as unsigned decimal.

    Null parts count as empty text; an all-empty key hashes to 0 like CRC32
    of no bytes. The text is hashed as UTF-8 (P18)."""
    info = F.concat_ws("", *[F.coalesce(_col(c), F.lit("")) for c in (referer, url, ip, ua)])
    day_col = F.lit(day) if isinstance(day, str) else day
    return F.concat(day_col, F.lit("_"), F.crc32(info.cast("binary")).cast("string"))


def visit_key(referer="referer", url="url", ip="ip", ua="ua") -> Column:
    """The 128-bit identity of a visit as hex text: the MD5 of its four texts with
    their lengths (``-`` for null). The row key's 32-bit checksum is equal for
    some different visits; this key is kept beside it."""
    parts = []
    for c in (referer, url, ip, ua):
        text = _col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat_ws(",", *parts).cast("binary"))
