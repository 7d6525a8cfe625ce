"""The keyed wide table and its cell (entity-attribute-value) form.

The original stored each log record as one row of a column-family store:
row key ``day_crc32(...)``, family ``o`` and 15 qualifiers; a later put with
the same key overwrote the earlier one. Here the wide form is a Parquet
table partitioned by ``day`` and the cell form a long table
``rowkey, visit, family, qualifier, value, version``. ``visit`` is the visit's
128-bit identity: two visits with one row key stay two rows in either form.

Operators: fill_unknown (P7), upsert_latest (A5), to_cells (R2/S8),
from_cells (R3), sorted_cells (R4), scan (S3), get (S7), put_cells (K9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import event_time, minute_of, rowkey, visit_key

FAMILY = "o"
UNKNOWN = "unknown"
# The fields that say whether two log lines are the same visit (P13's parts).
VISIT_KEY = ["referer", "url", "ip", "ua"]
# The qualifiers of the wide row, in the original's order.
WIDE_COLUMNS = ["ip", "country", "province", "city", "formattime", "method", "url",
                "protocal", "status", "bytessent", "referer", "browsername",
                "browserversion", "osname", "osversion"]
# What names a row: the row key of the layout, and the visit's full identity.
ROW_IDS = ["rowkey", "visit"]
WIDE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ROW_IDS]
    + [T.StructField(c, T.StringType()) for c in WIDE_COLUMNS]
    + [T.StructField("day", T.StringType())])
# A cell as the original's; stored cells also hold the visit.
CELL_SCHEMA = T.StructType([
    T.StructField("rowkey", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("qualifier", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("version", T.LongType()),
])
STORED_CELLS = T.StructType([CELL_SCHEMA[0], T.StructField("visit", T.StringType()), *CELL_SCHEMA[1:]])


def fill_unknown(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null -> ``unknown`` in the given (default: all wide) columns."""
    cols = [c for c in (columns or WIDE_COLUMNS) if c in df.columns]
    return df.fillna(UNKNOWN, subset=cols)


def to_wide(enriched: DataFrame, day: str, tz: str | None = None) -> DataFrame:
    """Enriched log records -> keyed wide rows (before de-duplication).

    Adds ``formattime`` and, unless they are there, the row ids; keeps ``event_ts`` (the parsed
    instant) for the last-write-wins choice; ``ua`` and raw ``time`` are not
    stored, as in the original."""
    # the time text is parsed once; the minute is rendered from the instant
    parsed = (enriched if "event_ts" in enriched.columns
              else enriched.withColumn("event_ts", event_time("time")))
    keyed = parsed if set(ROW_IDS) <= set(parsed.columns) else with_row_ids(parsed, day)
    return fill_unknown(keyed.withColumn("formattime", minute_of("event_ts", tz))).select(*ROW_IDS, *WIDE_COLUMNS, "event_ts",
                                          F.lit(day).alias("day"))


def with_row_ids(records: DataFrame, day: str) -> DataFrame:
    """Parsed records with the row key and visit of their wide row."""
    return records.withColumns({"rowkey": rowkey(day), "visit": visit_key()})


def latest_visits(records: DataFrame) -> DataFrame:
    """One parsed record per visit identity, the last one winning (A5).

    The identity is the four source texts themselves: the row key's 32-bit
    checksum is equal for some different visits and must not merge them.
    Run before enrichment, so that location and agent fields (functions of
    the identity) are found for the survivors only and never shuffled. The
    raw ``time`` becomes ``event_ts``."""
    return upsert_latest(records.withColumn("event_ts", event_time("time")).drop("time"),
                         VISIT_KEY)


def upsert_latest(wide: DataFrame, key: str | list[str] = "rowkey",
                  order: list[str] | None = None) -> DataFrame:
    """One row per key (a column or several), the last write winning (A5).

    "Last" is made deterministic: latest ``event_ts``, then the greatest
    (status, bytessent, method, protocal, then every other column). The
    choice is one ``max(struct)`` aggregate, so a hot key is reduced map-side
    (partial aggregation) before the shuffle and never lands whole in one
    task. Texts are aggregated by sorting, and key texts often begin alike: a
    64-bit hash before them decides nearly every comparison."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in wide.columns if c not in keys]
    first = [c for c in (order or ["event_ts", "status", "bytessent", "method", "protocal"])
             if c in rest]
    ordered = first + [c for c in rest if c not in first]
    best = F.max(F.struct(*[F.col(c) for c in ordered])).alias("_best")
    return (wide.withColumn("_hash", F.xxhash64(*keys)).groupBy("_hash", *keys).agg(best)
                .select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]))


def row_ids(df: DataFrame) -> list[str]:
    """The columns that name a row: ``rowkey``, and ``visit`` where it is known."""
    return [c for c in ROW_IDS if c in df.columns]


def to_cells(wide: DataFrame, family: str = FAMILY, columns: list[str] | None = None,
             version=None) -> DataFrame:
    """Melt each wide row into one cell per qualifier (R2, S8); null values
    become ``unknown``. ``version`` (a column or literal) stamps the cells."""
    cols, ids = columns or [c for c in WIDE_COLUMNS if c in wide.columns], row_ids(wide)
    filled = wide.select(*ids, *[F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c)
                                 for c in cols],
                         (F.lit(0) if version is None else
                          (F.lit(version) if not hasattr(version, "alias") else version))
                         .cast("long").alias("version"))
    cells = filled.unpivot([*ids, "version"], cols, "qualifier", "value")
    return cells.select(*ids, F.lit(family).alias("family"), "qualifier", "value", "version")


def from_cells(cells: DataFrame, qualifiers: list[str], family: str | None = FAMILY) -> DataFrame:
    """Cells -> one row per row key and visit with the chosen qualifiers as
    columns (R3).

    The newest version of each cell wins; missing cells give null. The
    pivot values are given, so no extra job discovers them."""
    src = cells if family is None else cells.where(F.col("family") == family)
    return (src.where(F.col("qualifier").isin(qualifiers))
               .groupBy(*row_ids(cells)).pivot("qualifier", qualifiers)
               .agg(F.max_by("value", _newest())))


def sorted_cells(cells: DataFrame) -> DataFrame:
    """Cells in (row, family, qualifier) order (R4): a range-partitioned
    global sort, each output partition holding one contiguous key range."""
    return cells.orderBy(*row_ids(cells), "family", "qualifier")


def scan(spark: SparkSession, path: str, day: str | None, columns: list[str]) -> DataFrame:
    """Read chosen qualifiers of a day of the wide table (S3).

    ``day`` prunes partitions, the column list prunes the Parquet read; a row
    whose chosen columns are all null is not returned, as a column-family scan
    would skip it."""
    df = spark.read.schema(WIDE_SCHEMA).parquet(path)
    if day is not None:
        df = df.where(F.col("day") == day)
    return df.select("rowkey", *columns).dropna(how="all", subset=columns)


def get(wide: DataFrame, keys) -> DataFrame:
    """Point read by row key (S7): one key, a list of keys, or a DataFrame with
    ``rowkey`` and perhaps ``visit`` values (a left-semi join)."""
    if isinstance(keys, DataFrame):
        on = [c for c in row_ids(keys) if c in wide.columns]
        return wide.join(keys.select(*on).distinct(), on, "left_semi")
    return wide.where(F.col("rowkey").isin([keys] if isinstance(keys, str) else list(keys)))


def put_cells(cells: DataFrame, path: str) -> None:
    """Append cells (K9); readers take the newest version per cell."""
    stored_cells(cells).write.mode("append").parquet(path)


def stored_cells(cells: DataFrame) -> DataFrame:
    """The columns of the cell table; cells without a visit have null there."""
    if "visit" not in cells.columns:
        cells = cells.withColumn("visit", F.lit(None).cast("string"))
    return cells.select(*STORED_CELLS.fieldNames())


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED_CELLS).parquet(path)


def latest_cells(cells: DataFrame) -> DataFrame:
    """The newest version of every (row, family, qualifier) cell. The aggregate
    sorts, and the row keys of a day begin alike: a hash decides first."""
    key = [*row_ids(cells), "family", "qualifier"]
    return (cells.withColumn("_hash", F.xxhash64(*key)).groupBy("_hash", *key)
                 .agg(F.max_by("value", _newest()).alias("value"),
                      F.max("version").alias("version"))
                 .drop("_hash"))


def _newest():
    # newest version first; equal versions are decided by the value, so the
    # answer does not depend on which task saw which cell first
    return F.struct(F.col("version"), F.col("value"))
