"""Command-line entry points for the three jobs (use with spark-submit).

    spark-submit weblens/cli.py etl --input '/access/20190130/*' --ranges /dim/ip_ranges \
        --out /warehouse/access --day 20190130
    spark-submit weblens/cli.py report --table /warehouse/access --day 20190130 \
        --stat-out /warehouse/browser_stat
    spark-submit weblens/cli.py stream --format kafka --option subscribe=orders \
        --option kafka.bootstrap.servers=broker:9092 --counters /warehouse/order_counters \
        --checkpoint /checkpoints/order_counters

Every job gets its session from the cluster (``master`` comes from
spark-submit) and writes only through the idempotent sinks. Ship the
package with ``--py-files weblens.zip`` (a zip of the ``weblens`` folder).
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a script by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


def _session(master: str | None) -> SparkSession:
    from weblens.session import build_session
    return build_session(master, "weblens")


def cmd_etl(spark: SparkSession, a: argparse.Namespace) -> None:
    from weblens.operators import geo
    from weblens.plans import etl
    from weblens.sources.files import load_ranges, load_rules
    ranges = geo.RangeTable(load_ranges(spark, a.ranges, a.ranges_format), validate=a.validate_ranges)
    rules = load_rules(spark, a.rules) if a.rules else None
    etl.run_etl(spark, a.input, ranges, a.out, a.day, rules, tz=a.tz, ua_cache=a.ua_cache,
                rejects_path=a.rejects, cells=a.cells)


def cmd_report(spark: SparkSession, a: argparse.Namespace) -> None:
    from weblens.plans.report import run_report
    jdbc = dict(kv.split("=", 1) for kv in a.jdbc)
    run_report(spark, a.table, a.day, a.k, a.stat_out, jdbc=jdbc or None)


def cmd_stream(spark: SparkSession, a: argparse.Namespace) -> None:
    from weblens.streaming import orders as stream
    options = dict(kv.split("=", 1) for kv in a.option)
    messages = stream.read_messages(spark, a.format, options, path=a.path, max_per_trigger=a.max_per_trigger,
                                    with_arrival=bool(a.watermark))
    trigger = ({"availableNow": True} if a.available_now
               else {"processingTime": f"{a.trigger_seconds} seconds"})
    q = stream.start_order_counters(messages, a.counters, a.checkpoint, trigger=trigger,
                                    watermark=a.watermark, name="order_counters", daily=a.daily,
                                    prefix=a.prefix, prefixes=(a.count_prefix, a.fee_prefix),
                                    dead_path=a.dead, late_path=a.late)
    if a.available_now:
        q.awaitTermination()  # ends by itself once the backlog is processed
    elif a.timeout:
        q.awaitTermination(a.timeout)
        q.stop()  # a bounded run ends cleanly; the checkpoint keeps its progress
    else:
        q.awaitTermination()


def parser() -> argparse.ArgumentParser:
    from weblens.operators import orders
    p = argparse.ArgumentParser(prog="weblens")
    p.add_argument("--master", default=None, help="only for local runs; spark-submit sets it")
    sub = p.add_subparsers(dest="cmd", required=True)

    e = sub.add_parser("etl", help="parse, enrich and replace one day of the wide table")
    e.add_argument("--input", required=True, help="log path or day glob")
    e.add_argument("--ranges", required=True)
    e.add_argument("--ranges-format", default="parquet")
    e.add_argument("--validate-ranges", action="store_true")
    e.add_argument("--rules", default=None, help="JSON-lines rule table; default rules if absent")
    e.add_argument("--out", required=True)
    e.add_argument("--day", required=True)
    e.add_argument("--tz", default=None, help="zone of formattime; default: session zone")
    e.add_argument("--rejects", default=None,
                   help="folder of the lines that cannot be parsed; default: OUT_rejects")
    e.add_argument("--cells", action="store_true", help="write sorted cells instead of rows")
    e.add_argument("--ua-cache", default=None, help="user-agent classification cache folder")

    r = sub.add_parser("report", help="top regions and browser counts of one day")
    r.add_argument("--table", required=True)
    r.add_argument("--day", required=True)
    r.add_argument("--k", type=int, default=10)
    r.add_argument("--stat-out", default=None, help="replace the day in this browser-stat table")
    r.add_argument("--jdbc", action="append", default=[],
                   help="key=value connection option (url, driver, user, ...): --stat-out is a table there")

    s = sub.add_parser("stream", help="paid-order counters from a message stream")
    s.add_argument("--format", required=True, help="kafka, text, json, ...")
    s.add_argument("--option", action="append", default=[], help="key=value source option")
    s.add_argument("--path", default=None)
    s.add_argument("--counters", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--trigger-seconds", type=int, default=5)
    s.add_argument("--watermark", default=None,
                   help="how long after its hour or day an order may arrive, e.g. '1 hour'; default: any time")
    s.add_argument("--prefix", default=orders.HASH_PREFIX, help="prefix of the hash counters' keys")
    s.add_argument("--count-prefix", default=orders.COUNT_PREFIX, help="of the daily counts, with --daily")
    s.add_argument("--fee-prefix", default=orders.FEE_PREFIX, help="of the daily amounts, with --daily")
    s.add_argument("--dead", default=None, help="folder of unusable messages; default: COUNTERS_dead")
    s.add_argument("--late", default=None, help="folder of late orders; default: COUNTERS_late")
    s.add_argument("--daily", action="store_true", help="count days only, not hours")
    s.add_argument("--max-per-trigger", type=int, default=None,
                   help="cap on offsets (Kafka) or files per micro-batch")
    s.add_argument("--timeout", type=int, default=None, help="seconds to run (default: forever)")
    s.add_argument("--available-now", action="store_true",
                   help="process what is available (in bounded batches) and stop")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or _session(a.master)
    {"etl": cmd_etl, "report": cmd_report, "stream": cmd_stream}[a.cmd](spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
