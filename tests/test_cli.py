"""The command-line jobs, run in-process against the test session."""

from weblens import cli
from weblens.operators import widetable
from weblens.sources import derived as d

from conftest import SF_SMALL


def test_etl_report_stream(spark, tmp_path, capsys):
    logs = tmp_path / "access" / "20240101"
    d.access_lines(d.read_table(spark, SF_SMALL, "events"), repeat_keys=True).write.text(str(logs))
    ranges = str(tmp_path / "ranges")
    d.ip_ranges(d.read_table(spark, SF_SMALL, "nation")).write.parquet(ranges)
    out, stat = str(tmp_path / "wide"), str(tmp_path / "stat")
    cli.main(["etl", "--input", str(logs / "*"), "--ranges", ranges, "--validate-ranges",
              "--out", out, "--day", "20240101", "--tz", "UTC"], spark)
    wide = widetable.scan(spark, out, "20240101", ["browsername"])
    assert wide.count() > 0
    # the same day again through the agent cache: first run fills it, second uses it
    cached_out = str(tmp_path / "wide-cached")
    for _ in range(2):
        cli.main(["etl", "--input", str(logs / "*"), "--ranges", ranges, "--out", cached_out,
                  "--day", "20240101", "--tz", "UTC", "--ua-cache", str(tmp_path / "ua")], spark)
    again = widetable.scan(spark, cached_out, "20240101", ["browsername"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, wide.collect()))
    cli.main(["report", "--table", out, "--day", "20240101", "--stat-out", stat], spark)
    printed = capsys.readouterr().out
    assert "country" in printed and "browsername" in printed
    assert spark.read.parquet(stat).agg({"cnt": "sum"}).first()[0] == wide.count()
    msgs = str(tmp_path / "msgs")
    d.order_messages(d.read_table(spark, SF_SMALL, "events")).write.text(msgs)
    counters = str(tmp_path / "counters")
    cli.main(["stream", "--format", "text", "--path", msgs, "--counters", counters,
              "--checkpoint", str(tmp_path / "ckpt"), "--available-now", "--max-per-trigger", "1"], spark)
    from weblens.operators import orders as o
    from weblens.streaming import orders as stream
    batch = o.order_rollup(o.parse_orders(spark.read.text(msgs)))
    assert sorted(map(tuple, stream.read_totals(spark, counters).collect())) == \
        sorted(map(tuple, batch.collect()))


def test_run_report_results(spark, tmp_path):
    from weblens.plans import etl
    from weblens.plans.report import run_report
    from weblens.sinks import tables
    ev = d.read_table(spark, SF_SMALL, "events")
    ranges = d.ip_ranges(d.read_table(spark, SF_SMALL, "nation"))
    out = str(tmp_path / "wide")
    wide = etl.wide_rows(d.access_lines(ev, repeat_keys=True), ranges, "20240101", tz="UTC")
    tables.write_day(wide, out, "20240101")
    res = run_report(spark, out, "20240101", 3, str(tmp_path / "stat"), show=False)
    assert len(res["top_regions"]) == 3
    counts = [r.cnt for r in res["browsers"]]
    assert counts == sorted(counts, reverse=True) and sum(counts) == wide.count()
