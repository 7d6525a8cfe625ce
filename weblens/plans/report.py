"""The statistics job (E2): one pruned scan of a day of the wide table feeds
the top regions and the browser counts (one aggregate over two grouping
sets), and the browser statistic replaces that day of a result table.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators import analytics, widetable
from ..sinks import tables


def run_report(spark: SparkSession, table: str, day: str, k: int = 10,
               stat_out: str | None = None, jdbc: dict[str, str] | None = None,
               show: bool = True) -> dict[str, list]:
    """Compute both statistics for ``day``; optionally replace the day in the
    browser-stat table (files, or JDBC with one transaction). Returns the
    two small results as lists of rows."""
    wide = widetable.scan(spark, table, day, ["country", "province", "browsername"])
    rep = analytics.report(wide, k)
    out = {"top_regions": rep["top_regions"].collect(), "browsers": rep["browsers"].collect()}
    if show:
        rep["top_regions"].show(k, truncate=False)
        rep["browsers"].show(truncate=False)
    if stat_out:
        tables.replace_day(analytics.stat_rows(rep["browsers"], day), stat_out, day, jdbc=jdbc)
    return out
