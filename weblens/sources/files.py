"""Batch sources: raw access logs (S1), the IP-range dimension (S5) and the
user-agent rule set (S6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE_SCHEMA = T.StructType([
    T.StructField("begin_ip", T.LongType()),
    T.StructField("end_ip", T.LongType()),
    T.StructField("country", T.StringType()),
    T.StructField("area", T.StringType()),
])

RULE_SCHEMA = T.StructType([
    T.StructField("priority", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("pattern", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("version_group", T.IntegerType()),
])


def read_access_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines (``value STRING``) of a file, directory or day glob such as
    ``/access/20190130/*``. Text files split by block, so the scan is as
    parallel as the input."""
    return spark.read.text(path)


def load_ranges(spark: SparkSession, path: str, fmt: str = "parquet",
                options: dict[str, str] | None = None) -> DataFrame:
    """The IP-range dimension ``begin_ip, end_ip, country, area`` (UTF-8).

    A missing path is an error here (the original silently answered every
    lookup with an error text instead)."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt != "parquet":
        reader = reader.schema(RANGE_SCHEMA)
    df = reader.load(path)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in RANGE_SCHEMA.fields])


def load_rules(spark: SparkSession, path: str, fmt: str = "json",
               options: dict[str, str] | None = None) -> DataFrame:
    """A user-agent rule table ``priority, kind, pattern, name, version_group``."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt != "parquet":
        reader = reader.schema(RULE_SCHEMA)
    return reader.load(path).select(*[F.col(f.name).cast(f.dataType) for f in RULE_SCHEMA.fields])
