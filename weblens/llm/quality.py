"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` characters that cover its whole
text. Each passage becomes a vector (shares of character classes and of their
bigrams, repeated neighbours and distinct words) and is encoded by one dense
layer; gated attention, learned from document labels alone, weights the
encoded passages, and their weighted mean is scored by logistic regression.

The network is fitted on a bounded sample, ``PER_CLASS`` expected documents
for each label, taken by a hash of the id from all labelled training rows.

Defined results: null and empty texts are one empty passage and get its score;
without labelled rows every score is 0.5; rows with a null label are scored but
not learned from; a document with several labels counts with each; rows repeat
with equal results; other columns are ignored; an empty table gives an empty
table.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_arrow
from .langid import slices

PASSAGE = 500
PER_CLASS = 1500
HIDDEN, GATE = 24, 12
THRESHOLD = 0.3
_CLASSES = 10
FEATURES = _CLASSES + _CLASSES * _CLASSES + 3
_SPACE = 3  # classes 3 (space) and 4 (line end) part words


@lru_cache(maxsize=1)
def _class_of() -> np.ndarray:
    """Class of each code point of the basic plane: lower, upper, digit, space,
    line end, stop, exclamation, other ASCII sign, other letter, rest."""
    def kind(c: str) -> int:
        if c.islower():
            return 0
        if c.isupper():
            return 1
        if c.isdigit():
            return 2
        if c == "\n":
            return 4
        if c.isspace():
            return 3
        if c in ".,;:'\"?-()":
            return 5
        if c == "!":
            return 6
        if c.isascii():
            return 7
        return 8 if c.isalpha() else 9
    return np.fromiter((kind(chr(i)) for i in range(0x10000)), np.uint8, 0x10000)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, 0x9E3779B97F4A7C15, np.uint64))


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(passages x FEATURES, passages of each text); an empty text has one."""
    sizes = np.array([len(t or "") for t in texts])
    of_text = np.maximum(1, -(-sizes // PASSAGE))
    joined = "".join([t or "" for t in texts])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _class_of()[np.minimum(points, 0xFFFF)].astype(np.int64)
    first = np.cumsum(of_text) - of_text
    start = np.cumsum(sizes) - sizes
    place = np.arange(len(points)) - np.repeat(start, sizes)
    bag = np.repeat(first, sizes) + place // PASSAGE
    n = int(of_text.sum())
    one = np.bincount(bag * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, _CLASSES)
    same = bag[1:] == bag[:-1] if len(bag) else np.zeros(0, bool)
    pair = kind[:-1] * _CLASSES + kind[1:] if len(bag) else np.zeros(0, np.int64)
    two = np.bincount((bag[:-1] * _CLASSES ** 2 + pair)[same], minlength=n * _CLASSES ** 2
                      ).reshape(n, _CLASSES ** 2)
    length = np.maximum(1, one.sum(axis=1, keepdims=True))
    x = [one / length, two / length]
    # words: hashes from prefix sums, which make a word's sum independent of place
    is_space = (kind == 3) | (kind == 4)
    inner = ~is_space
    edge = np.concatenate([[False], is_space]) if len(kind) else np.zeros(1, bool)
    fresh = np.concatenate([[True], place[1:] == 0]) if len(kind) else np.zeros(0, bool)
    begins = np.flatnonzero(inner & (edge[:-1] | fresh)) if len(kind) else np.zeros(0, np.int64)
    words = np.zeros((n, 3))
    if len(begins):
        after = np.concatenate([is_space[1:] | fresh[1:], [True]])
        ends = np.flatnonzero(inner & after) + 1
        with np.errstate(over="ignore"):
            terms = np.cumsum((points.astype(np.uint64) + np.uint64(1)) * _powers(len(points)))
            total = terms[ends - 1] - np.where(begins > 0, terms[begins - 1], np.uint64(0))
            # times p**(longest - begin): equal words get equal values
            total *= _powers(len(points))[len(points) - 1 - begins]
        word_bag = bag[begins]
        count = np.bincount(word_bag, minlength=n)
        again = (total[1:] == total[:-1]) & (word_bag[1:] == word_bag[:-1])
        order = np.lexsort((total, word_bag))
        new = np.ones(len(order), bool)
        new[1:] = (total[order][1:] != total[order][:-1]) | (word_bag[order][1:] != word_bag[order][:-1])
        many = np.maximum(1, count)
        words[:, 0] = np.bincount(word_bag[1:][again], minlength=n) / many
        words[:, 1] = np.bincount(word_bag[order][new], minlength=n) / many
        words[:, 2] = np.bincount(word_bag, ends - begins, n) / many / 10
    return np.hstack([*x, words]).astype(np.float32), of_text


class Network:
    """Encoder, gated attention and scorer over bags of passages."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.p = {"W": rng.normal(0, FEATURES ** -0.5, (FEATURES, HIDDEN)), "b": np.zeros(HIDDEN),
                  "V": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
                  "U": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
                  "a": np.zeros(GATE), "c": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "o": np.zeros(1)}
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, dict]:
        p, starts = self.p, np.cumsum(sizes) - sizes
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["W"] + p["b"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (v * u) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        w = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(w[:, None] * h, starts)
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["o"], -30, 30)))
        return score, {"x": x, "h": h, "v": v, "u": u, "w": w, "z": z}

    def _gradients(self, y, sizes, score, s):
        p, starts = self.p, np.cumsum(sizes) - sizes
        d = (score - y) / len(y)
        g = {"c": s["z"].T @ d, "o": np.array([d.sum()])}
        dz = np.repeat(d[:, None] * p["c"], sizes, axis=0)
        dw = (dz * s["h"]).sum(axis=1)
        de = s["w"] * (dw - np.repeat(np.add.reduceat(s["w"] * dw, starts), sizes))
        gate = s["v"] * s["u"]
        g["a"] = gate.T @ de
        dv = de[:, None] * p["a"] * s["u"] * (1 - s["v"] ** 2)
        du = de[:, None] * p["a"] * gate * (1 - s["u"])
        g["V"], g["U"] = s["h"].T @ dv, s["h"].T @ du
        dh = (dz * s["w"][:, None] + dv @ p["V"].T + du @ p["U"].T) * (1 - s["h"] ** 2)
        g["W"], g["b"] = s["x"].T @ dh, dh.sum(axis=0)
        return g

    def fit(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, steps: int = 200) -> "Network":
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        for t in range(1, steps + 1):
            score, state = self.forward(x, sizes)
            for k, g in self._gradients(y, sizes, score, state).items():
                g = g + 1e-4 * self.p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.p[k] = self.p[k] - 0.02 * (m[k] / (1 - 0.9 ** t)) / (
                    np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
        return self


def _bags(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in slices(texts, lambda t: len(t or "")):
            x, sizes = passages(texts[a:b])
            cuts = np.cumsum(sizes)[:-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), batch.column("label").slice(a, b - a),
                 pa.array([p.astype(np.float16).tobytes() for p in np.split(x, cuts)], pa.binary())],
                ["doc_id", "label", "x"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", per_class: int = PER_CLASS) -> Network | None:
    """The network, from labelled documents outside the held-out fold."""
    train = labels.select(F.col(id_col).cast("long").alias("doc_id"),
                          F.col(label_col).cast("int").alias("label")) \
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    counts = {r["label"]: r["n"] for r in
              train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = F.when(F.col("label") == 1, min(1.0, per_class / max(1, counts.get(1, 0)))) \
        .otherwise(min(1.0, per_class / max(1, counts.get(0, 0))))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    # about 2 * per_class ids: a bounded side
    sample = F.broadcast(train.where(place < share))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, label int, x binary"
    rows = map_arrow(texts.join(sample, "doc_id").select("doc_id", "label", "text"), _bags, schema)
    table = rows.toArrow().sort_by("doc_id")
    if not len(table):
        return None
    bags = [np.frombuffer(r, np.float16).reshape(-1, FEATURES) for r in table["x"].to_pylist()]
    sizes = np.array([len(b) for b in bags])
    return Network().fit(np.concatenate(bags).astype(np.float64), sizes,
                         table["label"].to_numpy().astype(np.float64))


def _scorer(spark, network: Network | None):
    """texts -> scores, for use in tasks."""
    shared = spark.sparkContext.broadcast(network and (network.p, network.mean, network.scale))

    def scores(texts: list[str | None]) -> np.ndarray:
        if not shared.value or not texts:
            return np.full(len(texts), 0.5)
        net = Network()
        net.p, net.mean, net.scale = shared.value
        return np.concatenate([net.forward(*passages(texts[a:b]))[0]
                               for a, b in slices(texts, lambda t: len(t or ""))])
    return scores


def score(docs: DataFrame, network: Network | None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score) per row."""
    scores = _scorer(docs.sparkSession, network)
    base = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            s = scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s.astype(np.float64))],
                ["doc_id", "held_out", "score"])
    return map_arrow(base, run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, "
                                "held_out boolean, score double")


def accepted(docs: DataFrame, network: Network | None, threshold: float = THRESHOLD,
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``threshold`` or more."""
    scores = _scorer(docs.sparkSession, network)

    def run(batches):
        for batch in batches:
            s = scores(batch.column(text_col).to_pylist())
            yield batch.filter(pa.array(s >= threshold))
    return map_arrow(docs, run, docs.schema)
