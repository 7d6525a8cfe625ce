"""Batch statistics over the wide table.

All are ordinary aggregations: Spark adds the partial (map-side) aggregate
before the shuffle, and ``orderBy(...).limit(k)`` plans as a single
TakeOrderedAndProject (a per-partition top-k and one small merge), not a
full sort. Ties are broken by the key so the result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize_sized


def top_regions(wide: DataFrame, k: int = 10) -> DataFrame:
    """Visits per (country, province), the ``k`` largest."""
    return (wide.groupBy("country", "province").agg(F.count(F.lit(1)).alias("cnt"))
                .orderBy(F.desc("cnt"), F.asc_nulls_first("country"),
                         F.asc_nulls_first("province"))
                .limit(k))


def browser_counts(wide: DataFrame) -> DataFrame:
    """Visits per browser, descending (A2/A3)."""
    return (wide.groupBy("browsername").agg(F.count(F.lit(1)).alias("cnt"))
                .orderBy(F.desc("cnt"), F.asc_nulls_first("browsername")))


def browser_counts_sql(spark: SparkSession, wide: DataFrame, view: str = "tmp") -> DataFrame:
    """The same statistic through a temporary view and SQL."""
    wide.createOrReplaceTempView(view)
    return spark.sql(
        f"SELECT browsername, count(1) AS cnt FROM {view} "
        "GROUP BY browsername ORDER BY cnt DESC, browsername ASC NULLS FIRST")


def report(wide: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """Both statistics and the rows of the browser table from one scan (R8): one
    aggregate over two grouping sets, written once (its size is that of the
    results), instead of the same input twice."""
    grouped = wide.groupingSets([["country", "province"], ["browsername"]],
                                "country", "province", "browsername").agg(
        F.count(F.lit(1)).alias("cnt"), F.grouping("browsername").alias("of_region"))
    base, _, _ = materialize_sized(grouped)
    regions = (base.where("of_region = 1").select("country", "province", "cnt")
               .orderBy(F.desc("cnt"), F.asc_nulls_first("country"), F.asc_nulls_first("province")).limit(k))
    browsers = (base.where("of_region = 0").select("browsername", "cnt")
                .orderBy(F.desc("cnt"), F.asc_nulls_first("browsername")))
    none = F.lit(None).cast("string")
    both = regions.select("country", "province", none.alias("browsername"), "cnt").unionByName(
        browsers.select(none.alias("country"), none.alias("province"), "browsername", "cnt"))
    return {"top_regions": regions, "browsers": browsers, "both": both}


def stat_rows(browsers: DataFrame, day: str) -> DataFrame:
    """Browser counts as rows of the relational statistic ``day, browser, cnt`` (K4)."""
    return browsers.select(F.lit(day).alias("day"), F.col("browsername").alias("browser"), "cnt")


def browser_stat_rows(wide: DataFrame, day: str) -> DataFrame:
    """Rows of the relational browser statistic ``day, browser, cnt`` (K4)."""
    return stat_rows(browser_counts(wide), day)
