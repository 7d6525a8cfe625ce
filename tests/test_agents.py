"""User-agent rule classification."""

import pytest
from pyspark.sql import functions as F

from weblens.operators import agents, rule_index

from conftest import rows

UAS = {
    "Mozilla/5.0 (Windows NT 6.3; x64) AppleWebKit/600.9 (KHTML, like Gecko) Chrome/88.7.10.20 "
    "Safari/600.9 SE 2.X MetaSr 3.5": ("Sogou Explorer", "3.5", "Windows", "6.3"),
    "Mozilla/5.0 (Windows NT 6.1; Win64; x64) AppleWebKit/601.5 (KHTML, like Gecko) "
    "Chrome/101.2.3.4 Safari/601.5": ("Chrome", "101.2.3.4", "Windows", "6.1"),
    "PhotoSync/12 CFNetwork/1121.2.2 Darwin/19.3.0": ("CFNetwork", "1121.2.2", "Darwin", "19.3.0"),
    "Sogou web spider/5.1 (+https://bots.example.com/)": ("Sogou web spider", "5.1", "unknown", "unknown"),
    "Go-http-client/2.0": ("Go-http-client", "2.0", "unknown", "unknown"),
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_14_2) AppleWebKit/605.1.15 (KHTML, like Gecko) "
    "Version/12.0.2 Safari/605.1.15": ("Safari", "12.0.2", "Mac OS X", "10_14_2"),
    "Mozilla/5.0 (X11; Linux x86_64; rv:64.0) Gecko/20100101 Firefox/64.0": ("Firefox", "64.0", "Linux", "unknown"),
    "Mozilla/5.0 (Linux; Android 9; MI 8) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/71.0.3578.99 "
    "Mobile Safari/537.36": ("Chrome", "71.0.3578.99", "Android", "9"),
    "something else": ("unknown", "unknown", "unknown", "unknown"),
    "": (None, None, None, None),
}


@pytest.mark.parametrize("dedup", [False, True])
def test_classify(spark, dedup):
    df = spark.createDataFrame([(u,) for u in UAS] + [(None,)], "ua string")
    out = agents.classify(df, None, "ua", dedup=dedup)
    got = {r.ua: (r.browsername, r.browserversion, r.osname, r.osversion) for r in out.collect()}
    for ua, expected in UAS.items():
        assert got[ua] == expected, ua
    assert got[None] == (None, None, None, None)
    assert out.count() == len(UAS) + 1


def test_rules_from_table_and_priority(spark):
    rules = spark.createDataFrame([(2, "browser", "Chrome/([0-9]+)", "Chrome", 1),
                                   (1, "browser", "Safari/([0-9.]+)", "Safari", 1)],
                                  "priority int, kind string, pattern string, name string, version_group int")
    df = spark.createDataFrame([("Chrome/70 Safari/537.36",)], "ua string")
    r = agents.classify(df, rules).first()
    assert (r.browsername, r.browserversion, r.osname) == ("Safari", "537.36", "unknown")


def test_no_python_udf_in_plan(spark):
    df = spark.createDataFrame([(u,) for u in UAS], "ua string")
    plan = agents.classify(df)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert rows(agents.default_rules(spark))[0][0] == 10


def test_load_rules_from_json(spark, tmp_path):
    import json

    from weblens.sources.files import load_rules
    path = tmp_path / "rules.json"
    path.write_text("\n".join(json.dumps(dict(zip(
        ["priority", "kind", "pattern", "name", "version_group"], r))) for r in agents.DEFAULT_RULES))
    loaded = load_rules(spark, str(path))
    assert loaded.count() == len(agents.DEFAULT_RULES)
    df = spark.createDataFrame([("curl/7.64.1",)], "ua string")
    r = agents.classify(df, loaded).first()
    assert (r.browsername, r.browserversion) == ("curl", "7.64.1")


def test_classification_cache(spark, tmp_path):
    cache = str(tmp_path / "ua-cache")
    day1 = spark.createDataFrame([(u,) for u in list(UAS)[:5]] + [(None,)], "ua string")
    day2 = spark.createDataFrame([(u,) for u in UAS] + [(None,)], "ua string")
    # no cache yet: plain per-row classification
    assert rows(agents.classify_cached(day2, cache)) == rows(agents.classify(day2))
    assert agents.update_cache(day1, cache) == 5
    assert agents.update_cache(day1, cache) == 0  # already known
    got = agents.classify_cached(day2, cache)  # 5 answers from the cache, the rest by rules
    assert rows(got) == rows(agents.classify(day2))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert agents.update_cache(day2, cache) == len(UAS) - 5  # the empty agent is stored too
    # another rule set never reuses these answers
    other = [(1, "browser", "Chrome/([0-9]+)", "Chromium", 1)]
    assert agents.cache_location(cache, other) != agents.cache_location(cache)


def test_cache_duplicates_do_not_duplicate_rows(spark, tmp_path):
    cache = str(tmp_path / "ua-cache")
    day = spark.createDataFrame([(u,) for u in UAS], "ua string")
    agents.update_cache(day, cache)
    # a second, concurrent-style append of the same answers
    agents._read_cache(spark, agents.cache_location(cache)).write.mode("append").parquet(
        agents.cache_location(cache))
    assert agents.classify_cached(day, cache).count() == day.count()


# --- the rule index ---------------------------------------------------------

RULE_DDL = "priority int, kind string, pattern string, name string, version_group int"

LITERALS = {
    r"Chrome/([0-9.]+)": ["Chrome/"],
    r"Version/([0-9.]+).*Safari/": ["Version/", "Safari/"],
    r"Edge?/x": ["Edg"],
    r"^curl/7\.1[0-9]+": ["curl/7.1"],
    r"ab+cdef": ["cdef"],
    r"abc{2,3}defg*?hij": ["def", "hij"],
    r"one|another": [],
    r"(?:one|two) three": [" three"],
    r"(?i)chrome": [],
    r"\QChrome\E": [],
    r"\x41bcd": [],
    r"a[b[cd]]efg": [],
    r"\(compatible\; bot\)": ["(compatible; bot)"],
    r"back\\slash": ["back\\slash"],
    r"((((((((deep))))))))er than": [],
    r"(?!not)this(?=x)": ["this"],
    r"word\b next\d": ["word", " next"],
    "": [],
}


def test_literal_runs(spark):
    df = spark.createDataFrame([(p,) for p in LITERALS], "pattern string")
    got = {r.pattern: r.runs for r in df.select("pattern", rule_index.literal_runs("pattern").alias("runs")).collect()}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in LITERALS.items()}


def test_literals_are_in_every_match(spark):
    texts = ["curl/7.12", "abccdefhij", "abcccdefgghij", "abbbcdef", "xx three", "one three", "(compatible; bot)",
             "back\\slash", "thisx", "word next5", "Version/1 Safari/", "Chrome/9"]
    df = spark.createDataFrame([(p, t) for p in LITERALS for t in texts], "pattern string, t string")
    runs = rule_index.literal_runs("pattern")
    lost = df.where(F.rlike("t", "pattern")).where(F.exists(runs, lambda r: ~F.contains("t", r)))
    assert lost.count() == 0


def _many_rules(spark, n):
    rows = [(1, "browser", rf"Client{i}/([0-9.]+)", f"client {i}", 1) for i in range(n)]
    rows += [(0, "browser", r"[xyz]{4}", "open rule", 0), (2, "os", r"Sys(?:tem)? ?(\d+)", "Sys", 1),
             (1, "robot", r"Client7/", "hidden by the browser rule", 0)]
    return spark.createDataFrame(rows + agents.DEFAULT_RULES, RULE_DDL)


AGENTS = [*UAS, "Client7/3.1 System 4", "Client123/9 Chrome/1", "Client9999/1", "xyzx Client5/1", "Client", "ab", "é",
          "Client12345/2", "Sys9 " + "long " * 3000, "Client77/1 Client7/2"]


def test_index_equals_the_chain(spark):
    rules = _many_rules(spark, 300)
    df = spark.createDataFrame([(u,) for u in AGENTS * 2] + [(None,)], "ua string")
    chain = agents.classify(df, [tuple(r) for r in rules.collect()])
    assert rows(agents.classify(df, rules)) == rows(chain)
    assert rows(agents.classify(df, rule_index.RuleIndex(rules, broadcast_max_rows=0), broadcast_max_rows=0)) == rows(chain)
    assert agents.classify(df.limit(0), rules).count() == 0


def test_work_for_an_agent_does_not_grow_with_the_rules(spark):
    df = spark.createDataFrame([(u,) for u in AGENTS], "ua string")
    few, many = (rule_index.RuleIndex(_many_rules(spark, n)) for n in (1000, 10_000))
    assert many.keyed.count() > 10_000
    tested = [i.candidates(df).count() for i in (few, many)]
    assert tested[1] <= len(AGENTS) * 8 and tested[1] <= tested[0] + len(AGENTS)
    plan = many.first_rules(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert not any(x in plan for x in ("CartesianProduct", "NestedLoop", "Python"))


def test_cache_with_a_large_rule_table(spark, tmp_path):
    cache, rules = str(tmp_path / "ua-cache"), _many_rules(spark, 300)
    day1 = spark.createDataFrame([(u,) for u in AGENTS[:8]] + [(None,)], "ua string")
    day2 = spark.createDataFrame([(u,) for u in AGENTS * 2] + [(None,)], "ua string")
    assert agents.update_cache(day1, cache, rules) == 8
    assert agents.update_cache(day1, cache, rules.orderBy("pattern")) == 0
    stored = agents.cache_location(cache, rules)
    # an answer that only the cache has shows that it is read
    spark.createDataFrame([("ab", "from the cache", "1", "x", "y")], "ua string, browsername string, "
                          "browserversion string, osname string, osversion string").write.mode("append").parquet(stored)
    got = {r.ua: r.browsername for r in agents.classify_cached(day2, cache, rules).collect()}
    assert got["ab"] == "from the cache"
    want = {r.ua: r.browsername for r in agents.classify(day2, rules).collect()}
    assert {**got, "ab": None} == {**want, "ab": None}
    assert agents.classify_cached(day2, cache, rules).count() == day2.count()
