"""Regenerate PLANS.md: initial physical plans of the headline queries.

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from weblens.operators import widetable  # noqa: E402
from weblens.plans import registry  # noqa: E402
from weblens.session import build_session  # noqa: E402

NOTES = {"s3/s7 scan and point read of the stored table": "Reading the stored wide table (S3, S7): the day predicate prunes partitions (`PartitionFilters`), only the named columns are read (`ReadSchema`), and the row-key predicate reaches the Parquet reader (`PushedFilters`), where row-group statistics and, in clustered days, bloom filters skip data.", 'j1_ip_range_join': 'Range join (J1). The range table is first rewritten into exact disjoint ranges (greatest begin <= ip wins, as the original binary search) and written once when the `RangeTable` is prepared, so the broadcast side below is a scan of that table, not the rewrite itself. The fact side is never shuffled: the bucketed range table (at most 2^16 + N rows for disjoint ranges, measured once by `RangeTable`) is broadcast, and the `between` test is a residual condition of the hash join, so misses survive the left join. A plain `between` join plans as BroadcastNestedLoopJoin instead.', 'j3_distinct_ip_lookup': 'Distinct-first lookup (J3). Partial HashAggregate before the exchange collapses repeated addresses map-side, so a hot address never reaches one reducer whole. The distinct answers are written once, and broadcast back to the fact rows below a size that the write reports, else joined by shuffle.', 'a1_top_regions': 'Top-10 regions (A1) over the keyed table. Partial/final HashAggregate on (country, province), then TakeOrderedAndProject: a per-partition top-k and one small merge, with no global sort. Below it is the whole ETL of E1 in the same plan.', 'a5_upsert_latest': 'Last-write-wins per visit (A5), before the enrichment: the key is the visit\'s four texts, not the 32-bit row key. `max(struct(event_ts, status, ...))` needs a variable-width buffer, so Spark plans a sort-based aggregate; it is still partial before the exchange. Each map task reduces a hot key to one row, and the reducers get at most one row per key per map task. Sort-based aggregation spills instead of failing.', 'r3_cells_to_rows': 'Cells back to rows (R3), with the pivot values given. The extra exchange on `rowkey` appears only because the cells here come straight from an unpivot (Expand does not keep partitioning); cells read from storage take a single exchange.', 't4_order_rollup': 'Order rollup (T4) for both levels in one aggregation: `explode([day, day||hour])` then partial/final HashAggregate on the key. The stream runs the same aggregation on each micro-batch and adds its result to the written counter table. A two-level batch form (hours, then days from hours, exchange reused) was measured slower at 100k and 1M rows.', 'k3 sorted cells before write': 'Sorted bulk write (K3). `repartitionByRange` samples key boundaries, so there is no single reducer, and each partition is sorted by (rowkey, qualifier). Every output file then holds a sorted, non-overlapping key range. Rows that share a key are few after A5; raw cells take (row, qualifier, version, value) as the boundaries, so a hot row is spread.', 'j1_dense_range_join': 'The same range join against one range per order (15,000 at sf0.01, 150,000 at sf0.1), as dense as a real IP table. The exploded side stays at most 2^16 + N rows and is still broadcast; the stride comes from a reused scalar subquery, not a join.'}

QUERIES = ["j1_ip_range_join", "j1_dense_range_join", "j3_distinct_ip_lookup", "a1_top_regions",
           "a5_upsert_latest", "r3_cells_to_rows", "t4_order_rollup"]


def tree(df) -> str:
    s = df._jdf.queryExecution().executedPlan().treeString()
    lines = []
    for ln in s.splitlines():
        ln = re.sub(r"\[plan_id=\d+\]", "", re.sub(r"#\d+L?", "", ln))
        if "FileScan" in ln:  # keep what was pushed and pruned, drop the path
            ln = re.sub(r"DataFilters: .*?(PartitionFilters:)", r"\1", ln)
            lines.append(ln[:400])
        else:
            lines.append(ln[:160])
    return "\n".join(lines)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    plans = {q: tree(registry.QUERIES[q](spark, sf)) for q in QUERIES}
    from weblens.session import scratch_path
    from weblens.sinks import tables
    path = scratch_path(spark, "plans-wide")
    tables.write_day(registry._wide(spark, sf), path, registry.DAY)
    key = spark.read.parquet(path).select("rowkey").first()[0]
    plans["s3/s7 scan and point read of the stored table"] = tree(
        widetable.get(widetable.scan(spark, path, registry.DAY, ["country", "browsername"]), key))
    cells = widetable.to_cells(registry._wide(spark, sf))
    plans["k3 sorted cells before write"] = tree(
        cells.repartitionByRange(8, "rowkey").sortWithinPartitions("rowkey", "family", "qualifier"))
    out = ["# Physical plans of the headline queries", "",
           "Generated by `python tools/plans.py` with `executedPlan().treeString()` at sf0.01 "
           "(expression ids removed, long lines cut).",
           "AQE re-plans at run time (coalescing partitions, splitting skewed join partitions); "
           "these are the initial plans.", ""]
    for k, v in plans.items():
        out += [f"## {k}", "", NOTES.get(k, ""), "", "```", v, "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
