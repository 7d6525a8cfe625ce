"""Decontamination, language, quality, nearest vectors and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weblens.llm import ann, decontam, langid, quality
from weblens.llm.common import read_table, written

from llm_fixtures import SF_CHECK, SF_SMALL, no_docs, odd_docs  # noqa: F401


def edit_distance_within(item, text):
    """Least edit distance of ``item`` to a substring of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
    return min(row)


def test_myers_distance():
    rng = random.Random(2)
    for _ in range(200):
        item = "".join(rng.choice("ab") for _ in range(rng.randint(1, 12)))
        text = "".join(rng.choice("ab") for _ in range(rng.randint(1, 20)))
        masks = {c: sum(1 << i for i, x in enumerate(item) if x == c) for c in set(item)}
        assert min(decontam.myers(masks, len(item), text)) == min(len(item), edit_distance_within(item, text))


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_BYTES, 150])
def test_edited_items_are_found(spark, odd_docs, no_docs, block_bytes):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(25)) for i in range(6)] + [(6, None), (7, ""), (8, "short one")]
    docs = []
    for i, item in items[:6]:
        for edits in (0, 3, 5, 9, 14):
            chars = list(item)
            for _ in range(edits):
                at = rng.randrange(len(chars))
                chars[at:at + 1] = rng.choice([[], ["z"], [chars[at], "y"]])
            docs.append((len(docs), f"{text(20).upper()}\n{''.join(chars)}  {text(30)}"))
    docs += [(900, "a short one here"), (901, "ashort one"), (902, None), (903, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {(900, 8): 0}
    for d, t in docs[:30]:
        for i, item in items[:6]:
            n = decontam.normalise(item)
            distance = edit_distance_within(n, decontam.normalise(t))
            if distance <= decontam.budget(n):
                want[d, i] = distance
    got = {(r["doc_id"], r["item_id"]): r["distance"]
           for r in decontam.matches(frame, bench, block_bytes=block_bytes).collect()}
    assert got == want and len(want) > 10
    kept = {r["doc_id"] for r in decontam.clean(frame, bench, block_bytes=block_bytes).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}
    assert decontam.clean(odd_docs, bench).columns == odd_docs.columns
    assert decontam.matches(no_docs, bench).count() == 0
    assert decontam.matches(frame, bench.limit(0)).count() == 0


def test_language_accuracy_and_odd_rows(spark, odd_docs, no_docs):
    docs = read_table(spark, SF_CHECK, "documents")
    model = langid.fit(docs)
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    odd = langid.predict(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert {r["lang_pred"] for r in odd if r["doc_id"] in (3, 4, 5)} == {"und"}
    assert langid.identified(odd_docs, model).columns == odd_docs.columns
    assert langid.predict(no_docs, langid.fit(no_docs)).count() == 0
    alone = langid.predict(odd_docs, langid.fit(odd_docs)).collect()  # one language only
    assert {r["lang_pred"] for r in alone} == {"en", "und"}


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 6, 20):
        code = langid.codewords(n)
        gaps = (code[:, None] != code[None]).sum(axis=2)[~np.eye(n, dtype=bool)]
        assert gaps.min() >= max(1, code.shape[1] // 4)


def test_quality_accuracy_and_odd_rows(spark, odd_docs, no_docs):
    docs, labels = read_table(spark, SF_CHECK, "documents"), read_table(spark, SF_CHECK, "labels")
    network = quality.fit(docs, labels)
    got = quality.score(docs, network).join(labels, "doc_id").where("held_out").collect()
    assert sum((r["score"] >= 0.3) == (r["quality"] == 1) for r in got) >= 0.95 * len(got)
    odd = quality.score(odd_docs, network).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert quality.accepted(odd_docs, network).columns == odd_docs.columns
    assert quality.fit(no_docs, labels) is None
    assert [r["score"] for r in quality.score(odd_docs, None).collect()] == [0.5] * odd_docs.count()


def test_gradients():
    rng = np.random.default_rng(0)
    x, sizes = rng.normal(size=(7, quality.FEATURES)), np.array([2, 1, 4])
    y, net = np.array([1.0, 0.0, 1.0]), quality.Network()
    net.p["a"] = rng.normal(size=quality.GATE)
    loss = lambda: -np.log(np.where(y > 0, s := net.forward(x, sizes)[0], 1 - s)).mean()
    score, state = net.forward(x, sizes)
    for k, g in net._gradients(y, sizes, score, state).items():
        at = tuple(rng.integers(0, n) for n in net.p[k].shape)
        net.p[k][at] += 1e-5
        up = loss()
        net.p[k][at] -= 2e-5
        down = loss()
        net.p[k][at] += 1e-5
        assert abs((up - down) / 2e-5 - g[at]) < 1e-6


def test_nearest_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16)) * rng.choice([0.2, 1], (3000, 1))
    x[::3] = x[0]  # one vector of a third of all rows
    rows = [(i, [float(v) for v in r], "c", 1) for i, r in enumerate(x)]
    rows += [(3000, None, "c", 1), (3100, [0.0] * 16, "c", 1), (3200, [1.0, None] * 8, "c", 1),
             (3300, [float("nan")] * 16, "c", 1), (3400, [1.0], "c", 1), (None, [1.0] * 16, "c", 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell string, rank int")
    exact = np.array([r[1] for r in rows[:3000]], np.float32).astype(np.float64)
    got = ann.nearest(vectors, centroids=16, candidates=600, share=0.35).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by_query.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(by_query) == set(range(0, 3000, 100))
    hits = 0
    for q, found in by_query.items():
        d = np.sqrt(((exact - exact[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(3000), d))[:10]
        hits += len(set(best) & {i for i, _ in found})
        assert len(found) == 10 and all(abs(d[i] - s) < 1e-9 for i, s in found)
        if q % 3 == 0:  # ties go to the smaller id
            assert [i for i, _ in found] == list(best)
    assert hits >= 0.9 * 10 * len(by_query)
    assert ann.nearest(vectors.limit(0)).count() == 0


def test_repeated_rows_and_ids_of_several_vectors(spark):
    """Against brute force over all rows, in several groups of queries."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += rows[:1] * 30 + rows[7:9] * 20  # a query and two candidates again
    rows += [(i % 40, [float(v) for v in r]) for i, r in enumerate(rng.normal(size=(80, 8)).astype(np.float32))]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"),
                      centroids=4, candidates=10_000, group=2).collect()
    found = {q: [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
             for q in range(0, 400, 100)}
    assert len(got) == 40
    for q, pairs in found.items():
        own = [np.array(v, np.float64) for i, v in rows if i == q]
        least = {}
        for i, v in rows:
            if i != q:
                d = min(float(np.sqrt(((o - np.array(v)) ** 2).sum())) for o in own)
                least[i] = min(d, least.get(i, d))
        want = sorted((d, i) for i, d in least.items())[:10]
        assert [p[0] for p in pairs] == [i for _, i in want]
        assert all(abs(p[1] - d) < 1e-9 for p, (d, _) in zip(pairs, want))


def test_recall_on_the_given_vectors(spark):
    """The index at work: a share of the table is ranked, whatever its size."""
    table = read_table(spark, "/root/testdata/sf0.1", "embeddings").select("vec_id", "embedding").cache()
    data = table.toArrow()
    ids = np.array(data["vec_id"])
    x = np.stack([np.asarray(v, np.float64) for v in data["embedding"].to_pylist()])
    recall = {}
    for share in (0.1, ann.SHARE, 1.0):
        got = ann.nearest(table, candidates=0, share=share).collect()
        hits = n = 0
        for q in np.flatnonzero(ids % 100 == 0):
            d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
            d[q] = np.inf
            best = set(ids[np.lexsort((ids, d))[:10]].tolist())
            hits += len(best & {r["vec_id"] for r in got if r["query_id"] == ids[q]})
            n += 10
        recall[share] = hits / n
    table.unpersist()
    print(recall)
    assert recall[0.1] < recall[ann.SHARE] < recall[1.0] == 1 and recall[ann.SHARE] >= 0.9


def test_pipeline(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF_SMALL), name)
        left = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and left <= ids
        ids = left
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert {r["doc_id"] for r in out.collect()} == ids


def test_pipeline_stages_on_odd_rows(spark, odd_docs):
    """Each stage really runs on nulls, empty and long texts and repeats."""
    good = read_table(spark, SF_SMALL, "documents")
    odd = odd_docs.select(*[F.col(c).cast(t) if c in odd_docs.columns else F.lit(None).cast(t).alias(c)
                            for c, t in good.dtypes]).withColumn("doc_id", F.col("doc_id") + 10**9)
    docs = written(good.unionByName(odd), "odd-documents")
    rows = {name: stage(spark, docs, SF_SMALL).collect() for name, stage in corpus_pipeline.STAGES}
    shift = {name: sorted((-1 if r["doc_id"] is None else r["doc_id"] - 10**9) for r in found
                          if r["doc_id"] is None or r["doc_id"] >= 10**9) for name, found in rows.items()}
    every = [-1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9]
    assert not {3, 4, 5} & set(shift["language_filter"])  # no letter, no language
    assert shift["near_duplicates"] == [i for i in every if i != 2]  # the copy of 1
    assert shift["decontamination"] == every
    assert shift["bpe_encoding"] == every
    assert set(shift["quality_filter"]) <= set(every)
    assert all(r["n_tokens"] == 0 for r in rows["bpe_encoding"] if (r["doc_id"] or 0) in (10**9 + 3, 10**9 + 4))


def test_pipeline_stages_on_no_rows(spark):
    none = written(read_table(spark, SF_SMALL, "documents").limit(0), "no-documents")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, none, SF_SMALL)
        assert found.count() == 0, name
        assert name == "bpe_encoding" or found.columns == none.columns
