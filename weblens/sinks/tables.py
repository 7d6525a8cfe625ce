"""Table sinks and table management (K1-K4, K7, K8).

The original's sinks were a column-family store (put, write-ahead-log-free
put, sorted bulk load) and a relational table updated in one transaction.
Their user-visible contract is "replace one day, atomically, idempotently";
here a day's rows are written whole beside the table first and then take the
place of the ``day`` folder. A job that fails leaves the old day as it was, a
plan may read the day that it replaces, a day without rows replaces too, and a
rerun (or a retried task) replaces rather than duplicates.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.widetable import ROW_IDS, WIDE_COLUMNS, WIDE_SCHEMA, row_ids, stored_cells, to_cells
from ..session import clear_path, path_exists, replace_path


def _staged_path(path: str) -> str:
    return f"{path}/_staged-{uuid.uuid4().hex}"  # readers skip names that begin with _


def _stage(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    staged = _staged_path(path)
    try:
        df.drop("day").write.format(fmt).save(staged)
    except Exception:
        clear_path(df.sparkSession, staged)
        raise
    return staged


def _overwrite_day(df: DataFrame, path: str, day: str, fmt: str = "parquet") -> None:
    """Replace the day's folder by these rows."""
    replace_path(df.sparkSession, _stage(df, path, fmt), f"{path}/day={day}")


def write_days(parts: list[tuple[DataFrame, str]], day: str) -> None:
    """Replace the day of several tables (rows, path): all are written before
    the first takes its place, so a failure leaves every old day."""
    staged: list[tuple[DataFrame, str, str]] = []
    try:
        for df, path in parts:
            staged.append((df, _stage(df, path), path))
    except Exception:
        for df, rows, _ in staged:
            clear_path(df.sparkSession, rows)
        raise
    for df, rows, path in staged:
        replace_path(df.sparkSession, rows, f"{path}/day={day}")


def stored_rows(wide: DataFrame) -> DataFrame:
    """The columns of the wide table."""
    return wide.select(*ROW_IDS, *WIDE_COLUMNS)


def write_day(wide: DataFrame, path: str, day: str, fmt: str = "parquet", *,
              clustered: bool = False, files: int | None = None) -> None:
    """Replace the ``day`` partition of the wide table with these rows (K1, K2).

    Rows should already be one per key (``upsert_latest``); only the stored
    columns are written. ``clustered`` also sorts them into files by row key for
    point reads (``cluster_day``)."""
    out = stored_rows(wide)
    if not clustered:
        _overwrite_day(out, path, day, fmt)
        return
    spark, rows = wide.sparkSession, _staged_path(path)
    try:
        out.write.parquet(rows)
        _cluster(spark, rows, path, day, files)
    finally:
        clear_path(spark, rows)


# The key range of each of a day's files, kept in a folder that readers skip.
FILE_RANGES = "_ranges"
_RANGE_DDL = "file STRING, first STRING, last STRING"


def _cluster(spark: SparkSession, rows: str, path: str, day: str, files: int | None) -> None:
    stored = spark.read.schema(WIDE_SCHEMA).parquet(rows).drop("day")
    # the sample for the boundaries reads the key column only
    ranged = stored.repartitionByRange(files, "rowkey") if files else stored.repartitionByRange("rowkey")
    staged = _staged_path(path)
    try:
        (ranged.sortWithinPartitions(*ROW_IDS).write.option("parquet.bloom.filter.enabled#rowkey", "true")
               .parquet(staged))
        (spark.read.schema(WIDE_SCHEMA).parquet(staged)
              .groupBy(F.col("_metadata.file_name").alias("file"))
              .agg(F.min("rowkey").alias("first"), F.max("rowkey").alias("last"))
              .coalesce(1).write.parquet(f"{staged}/{FILE_RANGES}"))
    except Exception:
        clear_path(spark, staged)
        raise
    replace_path(spark, staged, f"{path}/day={day}")


def cluster_day(spark: SparkSession, path: str, day: str, files: int | None = None) -> None:
    """Rewrite a stored day for point reads (S7): files of disjoint row-key ranges,
    sorted, with bloom filters on the key, and a small table of the ranges."""
    _cluster(spark, f"{path}/day={day}", path, day, files)


def get_rows(spark: SparkSession, path: str, keys: str | list[str]) -> DataFrame:
    """Point read of the stored wide table (S7). The day is the key's own, and of a
    clustered day only the files whose key ranges hold a key are opened."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    by_day: dict[str, list[str]] = {}
    for k in keys:
        by_day.setdefault(k.rpartition("_")[0], []).append(k)
    found = spark.createDataFrame([], WIDE_SCHEMA)
    for day, wanted in by_day.items():
        folder = f"{path}/day={day}"
        if not path_exists(spark, folder):
            continue
        names = [folder]
        if path_exists(spark, f"{folder}/{FILE_RANGES}"):
            ranges = spark.read.schema(_RANGE_DDL).parquet(f"{folder}/{FILE_RANGES}")
            held = F.exists(F.array(*[F.lit(k) for k in wanted]),
                            lambda k: (k >= F.col("first")) & (k <= F.col("last")))
            names = [f"{folder}/{r['file']}" for r in ranges.where(held).collect()]  # at most one a key
        if names:
            rows = spark.read.schema(WIDE_SCHEMA).option("basePath", path).parquet(*names)
            found = found.unionByName(rows.where(F.col("rowkey").isin(wanted)))
    return found


def bulk_cells(wide_or_cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """Cells laid out for a sorted bulk write.

    Cells are range-partitioned (sampled boundaries, no single reducer) and
    sorted within each partition, so every output file holds one sorted,
    non-overlapping key range - the layout a sorted bulk load needs - and the
    day is replaced at commit. Wide rows, one for each row id, are split between
    row keys and sorted before they become cells, in the order of qualifiers, so
    that a row is dealt and sorted once and not once for each of its cells. Raw cells
    may hold any number of versions of a row, so their boundaries go on to
    qualifier, version and value: a key with a third of all cells is spread
    over many tasks."""
    def dealt(df: DataFrame, *bounds: str) -> DataFrame:
        # without an explicit count AQE sizes the range partitions (it only merges
        # neighbouring ranges, so the files stay sorted and disjoint)
        return df.repartitionByRange(partitions, *bounds) if partitions else df.repartitionByRange(*bounds)

    if "qualifier" in wide_or_cells.columns:
        order = [*ROW_IDS, "family", "qualifier", "version", "value"]
        return dealt(stored_cells(wide_or_cells), *order).sortWithinPartitions(*order)
    columns = sorted(c for c in WIDE_COLUMNS if c in wide_or_cells.columns)
    ids = row_ids(wide_or_cells)
    rows = dealt(wide_or_cells.select(*ids, *columns), "rowkey").sortWithinPartitions(*ids)
    return stored_cells(to_cells(rows, columns=columns))


def bulk_write_cells(wide_or_cells: DataFrame, path: str, day: str,
                     partitions: int | None = None) -> None:
    """Sorted bulk write of cells (K3): the day's files are replaced by those of
    ``bulk_cells``."""
    _overwrite_day(bulk_cells(wide_or_cells, partitions), path, day)


def replace_day(stats: DataFrame, target: str, day: str, *, fmt: str = "parquet",
                jdbc: dict[str, str] | None = None) -> None:
    """Idempotently replace one day of a result table (K4).

    File targets: the ``day`` folder is replaced. JDBC targets:
    the rows go (from the executors, in parallel) into a staging table, then
    one transaction on the driver deletes the day and inserts the staging
    rows - only SQL statements pass through the driver, never the data. The
    result is small, so it is coalesced to one writer (R7)."""
    rows = stats.withColumn("day", F.lit(day))
    if jdbc is None:
        _overwrite_day(rows.coalesce(1), target, day, fmt)
        return
    staging = f"{target}_staging_{uuid.uuid4().hex[:8]}"  # two jobs may run at once
    (rows.coalesce(1).write.format("jdbc").mode("overwrite")
         .options(**jdbc).option("dbtable", staging).save())
    _jdbc_transaction(stats.sparkSession, jdbc, [
        (f"DELETE FROM {target} WHERE day = ?", [day]),
        (f"INSERT INTO {target} SELECT * FROM {staging}", []),
        (f"DROP TABLE {staging}", []),
    ])


def _jdbc_transaction(spark: SparkSession, jdbc: dict[str, str], statements) -> None:
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k in ("user", "password"):
        if k in jdbc:
            props.setProperty(k, jdbc[k])
    conn = jvm.java.sql.DriverManager.getConnection(jdbc["url"], props)
    try:
        conn.setAutoCommit(False)
        for sql, params in statements:
            st = conn.prepareStatement(sql)
            for i, p in enumerate(params, start=1):
                st.setString(i, p)
            st.executeUpdate()
            st.close()
        conn.commit()
    except Exception:
        conn.rollback()  # the original rethrew without rolling back (Q20)
        raise
    finally:
        conn.close()


def ensure_table(spark: SparkSession, name: str, schema: str, *, replace: bool = False,
                 partitioned_by: list[str] | None = None, path: str | None = None) -> bool:
    """Create a catalog table if missing, or drop and recreate it (K7).
    Returns True when a table was created."""
    exists = spark.catalog.tableExists(name)
    if exists and not replace:
        return False
    if exists:
        told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        spark.sql(f"DROP TABLE {name}")
        if told.get("Type") == "EXTERNAL":  # its files outlive it, wherever they are
            clear_path(spark, told["Location"])
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    loc = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet{part}{loc}")
    return True


def describe(spark: SparkSession, database: str | None = None) -> list[tuple[str, list[str]]]:
    """Tables with their columns (K8), from the catalog (metadata only)."""
    out = []
    for t in spark.catalog.listTables(database):
        cols = [c.name for c in spark.catalog.listColumns(t.name, database)] if not t.isTemporary else []
        out.append((t.name, cols))
    return out
