"""Plan shape of the end-to-end ETL: one plan, no Python, no nested loops,
pruned scans."""

from weblens.plans import registry

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_etl_plan_is_jvm_only(spark):
    plan = _plan(registry.flagship(spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "NestedLoopJoin", "CartesianProduct"):
        assert bad not in plan, bad
    assert "BroadcastHashJoin" in plan


def test_scans_are_pruned(spark):
    plan = _plan(registry.j1_ip_range_join(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan
    top = _plan(registry.a1_top_regions(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in top


def _partial_before_exchange(plan: str, fn: str) -> bool:
    """True when a partial aggregate of ``fn`` sits below the first exchange."""
    lines = plan.splitlines()
    ex = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    part = [i for i, ln in enumerate(lines) if f"partial_{fn}" in ln]
    return bool(ex) and bool(part) and min(part) > min(ex)  # deeper in the tree = later line


def test_hot_keys_are_reduced_map_side(spark):
    # a key holding a third of all rows must be combined before the shuffle
    assert _partial_before_exchange(_plan(registry.a5_upsert_latest(spark, SF_SMALL)), "max")
    assert _partial_before_exchange(_plan(registry.t4_order_rollup(spark, SF_SMALL)), "sum")
    assert _partial_before_exchange(_plan(registry.a2_browser_counts(spark, SF_SMALL)), "count")


def test_fallback_paths_without_broadcast(spark):
    from pyspark.sql import functions as F

    from weblens.operators import agents, geo
    from weblens.sources import derived as d
    ev = d.read_table(spark, SF_SMALL, "events")
    ips = ev.select(d.event_ip().alias("ip_long"))
    rg = d.ip_ranges(d.read_table(spark, SF_SMALL, "nation"))
    small = geo.locate(ips, rg, dedup=True)
    big = geo.locate(ips, rg, dedup=True, broadcast_max_rows=0)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))
    assert "NestedLoopJoin" not in _plan(big)
    uas = d.access_lines(ev).select(F.get(F.split("value", '"'), 7).alias("ua"))
    a = agents.classify(uas, dedup=True, broadcast_max_rows=0)
    b = agents.classify(uas)
    # malformed lines have no agent: nulls are compared too
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_a_line_is_made_once(spark):
    # the test for parsable lines works on the parts, not on the line made again
    plan = _plan(registry.a5_upsert_latest(spark, SF_SMALL))
    tests = [ln for ln in plan.splitlines() if "Filter " in ln and "_toks" in ln]
    assert tests and not any("malformed" in ln for ln in tests)


def test_visits_are_sorted_by_a_hash_first(spark):
    plan = _plan(registry.a5_upsert_latest(spark, SF_SMALL))
    assert "Sort [_hash" in plan


def test_wide_rows_are_compiled(spark):
    # the JVM does not compile methods of more than 8,000 bytes of code
    import re
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # its plans hold no code before they run
    try:
        query = registry._wide(spark, SF_SMALL)._jdf.queryExecution()
        code = spark._jvm.PythonSQLUtils.explainString(query, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_a_replaced_day_is_counted_once(spark, monkeypatch):
    # two writes of one statistic: neither may compute the day's visits again
    plans, real = [], registry.tables.replace_day

    def replace_day(stats, *args, **kw):
        plans.append(_plan(stats))
        real(stats, *args, **kw)
    monkeypatch.setattr(registry.tables, "replace_day", replace_day)
    assert registry.k4_replace_day(spark, SF_SMALL).count() > 0
    assert len(plans) == 2 and not any("Aggregate" in p or "events" in p for p in plans)
