"""Session construction and shared-storage helpers.

Everything that needs durable scratch space (written intermediate tables,
streaming checkpoints, read-back checks) goes under the folder the cluster
names in ``spark.checkpoint.dir``. Only when that setting is absent *and* the
master is local (tests, the bench) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "weblens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session configured for the library: AQE with skew-join splitting,
    UTC session zone, no UI. On a cluster pass ``master=None`` and let
    spark-submit decide."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # checkpointed helper tables are deleted once nothing references them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # The ETL fuses parsing, the rule CASE chains and the range-join probe
        # into one stage; past this bytecode size Spark compiles the stage's
        # expressions separately instead of one method the JIT would skip.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    if master and master.startswith("local"):
        # local mode: the driver JVM runs the tasks; let the JIT compile large
        # generated methods (on a cluster set this in the executor options)
        conf["spark.driver.extraJavaOptions"] = "-XX:-DontCompileHugeMethods"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the session first; only a local-mode session without one gets
    a private folder (a machine-local folder is meaningless on a cluster)."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if found:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(found)
        return sc.getCheckpointDir() or found
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; a cluster job needs a shared folder")
    local = tempfile.mkdtemp(prefix="weblens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


# Default bounds for a side we broadcast: rows and estimated bytes.
BROADCAST_MAX_BYTES = 128 * 1024 * 1024


def _row_bytes(df):
    """An estimate of a row's bytes: UTF-8 length of the strings, 8 bytes for
    every other field, 64 for a nested one, and a row header."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    size = F.lit(16)
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            size = size + F.lit(16) + F.coalesce(F.octet_length(F.to_json(F.col(f.name))), F.lit(0))
        else:
            size = size + F.lit(8)
    return size


def broadcast_fits(df, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``df`` is small enough to broadcast, from one aggregate: its
    row count and an estimate of its bytes. Only call it on a side whose size
    is already bounded (a dimension, a distinct set)."""
    from pyspark.sql import functions as F
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def materialize_sized(df):
    """(table, rows, bytes): ``df`` written once under the shared checkpoint
    folder and read back, with its row count and estimated bytes taken by the same
    job. The folder is removed when the driver's JVM ends."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).write.parquet(path)
    remove_on_exit(spark, path)
    got = seen.get
    return spark.read.schema(df.schema).parquet(path), got["n"], got["b"] or 0


def materialize(df):
    """Compute ``df`` once into the shared checkpoint folder and cut its
    lineage (a reliable checkpoint: it survives executor loss, unlike a
    local one). Used for small derived tables that are both size-checked and
    joined, so they are not computed twice."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever store the path names."""
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def clear_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder with all it holds."""
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def remove_on_exit(spark: SparkSession, path: str) -> None:
    """Remove the path when the driver's JVM ends."""
    fs, jpath = _fs(spark, path)
    fs.deleteOnExit(jpath)


def list_path(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder."""
    fs, jpath = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(jpath)]


def replace_path(spark: SparkSession, new: str, target: str) -> None:
    """Put the folder ``new`` in the place of ``target``. The old folder is moved
    aside first and comes back if the new one cannot take its place."""
    fs, jnew = _fs(spark, new)
    _, jtarget = _fs(spark, target)
    _, jold = _fs(spark, f"{new}-old")
    held = fs.exists(jtarget)
    if held and not fs.rename(jtarget, jold):
        raise OSError(f"cannot move {target} aside")
    try:  # some stores raise, some say false
        why, moved = None, fs.rename(jnew, jtarget)
    except Exception as e:  # noqa: BLE001
        why, moved = e, False
    if not moved:
        if held:
            fs.rename(jold, jtarget)
        raise OSError(f"cannot move {new} to {target}") from why
    if held:
        fs.delete(jold, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
