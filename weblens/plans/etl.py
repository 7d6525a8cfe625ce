"""End-to-end plans: the log ETL (E1) and the statistics job.

``wide_rows`` is one Catalyst plan: text scan -> parse (Project) ->
last-write-wins aggregate on the visit identity -> range join against the
broadcast, bucketed range table -> rule projection for agents -> row key.
There is no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import parse_access_log, split_rejects
from ..operators import agents, geo, widetable
from ..session import remove_on_exit, scratch_path
from ..sinks import tables
from ..sources.files import read_access_log


def parsed_records(lines: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Parsable lines as D2 records (the others: ``rejected_lines``)."""
    good, _ = split_rejects(parse_access_log(lines, keep=keep))
    return good


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The raw text (``value``) of the lines that cannot be parsed (Q1)."""
    _, bad = split_rejects(parse_access_log(lines, keep=["value"]))
    return bad.select("value")


def enrich(lines: DataFrame, ranges: DataFrame, rules=None, **kw) -> DataFrame:
    """Lines -> records with geo and user-agent fields (D3 without formattime)."""
    return enrich_records(parsed_records(lines), ranges, rules, **kw)


def enrich_records(rec: DataFrame, ranges: DataFrame, rules=None, *, geo_dedup: bool = False,
                   ua_dedup: bool = False, ua_cache: str | None = None) -> DataFrame:
    """Parsed records with geo and user-agent fields added. ``ua_cache``
    answers known agents from a classification cache."""
    rec = geo.enrich_geo(rec, ranges, "ip", dedup=geo_dedup)
    if ua_cache:
        return agents.classify_cached(rec, ua_cache, rules, "ua")
    return agents.classify(rec, rules, "ua", dedup=ua_dedup)


def wide_rows(lines: DataFrame, ranges: DataFrame, day: str, rules=None, *,
              tz: str | None = None, dedup: bool = True, **kw) -> DataFrame:
    """Lines -> keyed wide rows of ``day``; with ``dedup`` one row per visit
    identity (A5), chosen before the enrichment."""
    return wide_of_records(parsed_records(lines), ranges, day, rules, tz=tz, dedup=dedup, **kw)


def wide_of_records(rec: DataFrame, ranges: DataFrame, day: str, rules=None, *,
                    tz: str | None = None, dedup: bool = True, **kw) -> DataFrame:
    if dedup:
        rec = widetable.latest_visits(rec)
    # the row ids are made before the lookups: in one generated method with all
    # that follows them, they would make it too large for the JVM to compile
    rec = widetable.with_row_ids(rec, day)
    return widetable.to_wide(enrich_records(rec, ranges, rules, **kw), day, tz)


def parsed_once(lines: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(records, rejected lines, counts) from one scan and one parse: both go
    into one table, in folders of their own, and are counted on the way."""
    spark = lines.sparkSession
    seen, path = Observation(), scratch_path(spark, "parsed")
    ok = F.col("parse_ok")
    parsed = parse_access_log(lines, keep=["value"]).withColumn("value", F.when(~ok, F.col("value")))
    (parsed.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(ok).alias("good"),
                    F.count_if(~ok).alias("rejected"))
           .write.partitionBy("parse_ok").parquet(path))
    schema = parsed.schema
    stored = spark.read.schema(schema).parquet(path)
    remove_on_exit(spark, path)
    return (stored.where(ok).drop("parse_ok", "value"), stored.where(~ok).select("value"), dict(seen.get))


def run_etl(spark: SparkSession, input_path, ranges: DataFrame, out_path: str, day: str,
            rules=None, tz: str | None = None, ua_cache: str | None = None,
            rejects_path: str | None = None, cells: bool = False) -> dict[str, int]:
    """Read a day of logs, enrich, and replace that day of the wide table (K1),
    or with ``cells`` that day of a cell table, as sorted files (K3).
    The lines that cannot be parsed replace the day in ``rejects_path``
    (default: ``out_path`` + ``_rejects``), so no line is lost silently.
    The text is scanned and parsed once, and both days are written before either
    is replaced. With ``ua_cache`` known agents come from the cache, and the day's
    new agents are added to it afterwards (for the next run). Returns how many lines
    were read, parsed and rejected."""
    rec, bad, counts = parsed_once(read_access_log(spark, input_path))
    wide = wide_of_records(rec, ranges, day, rules, tz=tz, ua_cache=ua_cache)
    tables.write_days([(tables.bulk_cells(wide) if cells else tables.stored_rows(wide), out_path),
                       (bad, rejects_path or out_path.rstrip("/") + "_rejects")], day)
    if ua_cache:
        agents.update_cache(rec, ua_cache, rules)
    return counts
