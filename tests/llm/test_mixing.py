"""Mixing by pivotal rounding: targets against plain water filling, the rounding's laws."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF_SMALL, no_docs, odd_docs  # noqa: F401
from weblens.llm import mixing, queries

SCHEMA = "doc_id long, source string, text string, nth int, open string, target int"


def make(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def filled(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by resharing the excess, one round after the other."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    excess, free = share * sum(sizes.values()), list(names)
    while excess > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += excess * weight[s] / total
        excess = 0.0
        for s in list(free):
            if target[s] >= most * sizes[s]:
                excess += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                free.remove(s)
    return target


def sums(df):
    return {r["source"]: r for r in df.groupBy("source").agg(
        F.sum("size").alias("size"), F.sum("taken").alias("taken"), F.max("target").alias("target"),
        F.max("size").alias("largest")).collect()}


@pytest.mark.parametrize("group,fan", [(1000, 1000), (7, 3)])
def test_targets_and_words(spark, group, fan):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 > 0, "hot").when(F.col("source") != "src7", F.col("source")))
    got = mixing.mix(docs, group=group, fan=fan)
    assert got.count() == docs.count() and got.select("doc_id").distinct().count() == docs.count()
    by = sums(got.join(docs.select("doc_id", "source"), "doc_id"))
    wanted = filled({s: r["size"] for s, r in by.items()})
    for s, r in by.items():
        assert r["target"] == pytest.approx(wanted[s])
        # words are kept but for the last open document
        assert abs(r["taken"] - r["target"]) <= r["largest"] / 2 + 1e-6
    assert got.where("taken > 2 * size OR taken < 0 OR copies NOT IN (0, 1, 2)").count() == 0
    assert got.where("taken <> copies * size").count() == 0


def test_reruns_agree_on_other_partitions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    a = mixing.mix(docs, group=10).select("doc_id", "taken").collect()
    b = mixing.mix(docs.repartition(7, "text").orderBy(F.col("doc_id").desc()), group=10).select("doc_id", "taken").collect()
    assert sorted(a) == sorted(b)


def test_pivot_keeps_words_and_odds():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 500, 40)
    parts = np.full(40, 0.3)
    total = np.zeros(40)
    for _ in range(3000):
        done = mixing.pivot(sizes, parts, rng.random(40), last=False)
        assert ((done > 0) & (done < 1)).sum() <= 1
        assert (done * sizes).sum() == pytest.approx((parts * sizes).sum())
        total += done
    assert np.abs(total / 3000 - 0.3).max() < 0.05  # expected copies do not change
    assert set(mixing.pivot(sizes, parts, rng.random(40), last=True)) <= {0.0, 1.0}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(1, None, "a b c"), (2, "", "a\x1cb c\x0bd"), (3, "b", None), (4, "b", ""), (5, "b", "\t\n "), (None, "b", "x y"),
            (None, "b", "x y"), (6, "c", "w " * 30000), (7, "é", "one"), (7, "é", "one"), (8, "empty", "  ")]
    docs = make(spark, rows)
    got = mixing.mix(docs)
    assert sorted((str(r["doc_id"]), r["size"]) for r in got.collect()) == sorted(
        [("1", 3), ("2", 3), ("3", 0), ("4", 0), ("5", 0), ("None", 2), ("None", 2), ("6", 30000), ("7", 1), ("7", 1), ("8", 0)])
    wanted = filled({None: 3, "": 3, "b": 4, "c": 30000, "é": 2, "empty": 0})
    targets = {r["source"]: r["target"] for r in mixing.targets(
        docs.select("source", mixing.n_words(F.col("text")).alias("n")).groupBy("source")
        .agg(F.sum("n").alias("source_size"))).collect()}
    assert targets == pytest.approx(wanted)
    assert mixing.mix(odd_docs.withColumn("source", F.lit(None).cast("string"))).count() == odd_docs.count()
    empty = no_docs.withColumn("source", F.lit("s"))
    assert mixing.mix(empty).collect() == []
    assert mixing.mix(docs.where("source = 'empty'")).collect()[0]["taken"] == 0


def test_query_columns(spark):
    assert {"doc_id", "size", "source_size", "target", "taken"} <= set(queries.op12_source_mix(spark, SF_SMALL).columns)
