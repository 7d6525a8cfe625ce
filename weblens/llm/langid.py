"""Language identification by error-correcting output codes.

Every language gets a codeword of bits; a binary logistic classifier for each
bit reads hashed character n-grams (letters, and trigrams around a letter) of
the whole text. Decoding weights each bit by its classifier's margin: the
language with the least total logistic loss against its codeword wins, and a
lead below ``AMBIGUOUS`` over the next one is flagged.

The classifiers are fitted on a bounded sample, ``PER_LANGUAGE`` expected rows
of each language, taken by a hash of the id from all labelled training rows.

Defined results: a text that is null or has no letter is ``und`` with score 0,
as is every text when no labelled row exists; rows with a null language are
predicted but not learned from; rows repeat with equal results; ties of loss
go to the language first in order; other columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_arrow

PER_LANGUAGE = 400
BUCKETS = 1 << 12
MAX_BITS = 31
AMBIGUOUS = 0.2
SLICE_ROWS, SLICE_CHARS = 256, 200_000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def slices(rows: list, size) -> list[tuple[int, int]]:
    """(start, end) of slices of ``SLICE_ROWS`` rows and ``SLICE_CHARS``
    characters at most, but one row at least."""
    out, start, chars = [], 0, 0
    for i, row in enumerate(rows):
        n = size(row)
        if i > start and (i - start >= SLICE_ROWS or chars + n > SLICE_CHARS):
            out.append((start, i))
            start, chars = i, 0
        chars += n
    if len(rows) > start:
        out.append((start, len(rows)))
    return out


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(texts x BUCKETS matrix of unit rows, whether each text has a letter)."""
    joined = " ".join([(t or "").lower() for t in texts])
    points = np.frombuffer(f" {joined} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len((t or "").lower()) + 1 for t in texts])
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)  # of points[1:-1] and a space
    doc = doc[:len(points) - 2]
    letter = _letters()[points]
    c = np.where(letter, points, np.uint32(32))
    middle = np.flatnonzero(letter[1:-1])
    with np.errstate(over="ignore"):
        one = c[1:-1] * np.uint32(0x9E3779B1)
        three = (c[:-2] * np.uint32(0x85EBCA6B) + one) * np.uint32(0xC2B2AE35) \
            + c[2:] * np.uint32(0x27D4EB2F)
        three = (three ^ (three >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    base = doc[middle] * BUCKETS
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    counts = np.bincount(base + (one[middle] >> shift), minlength=len(texts) * BUCKETS)
    counts += np.bincount(base + (three[middle] >> shift), minlength=len(texts) * BUCKETS)
    x = np.sqrt(counts.reshape(len(texts), BUCKETS).astype(np.float32))
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-9), norm[:, 0] > 0


def codewords(languages: int) -> np.ndarray:
    """languages x bits of +1 and -1: all ways to part up to five languages,
    else the random code with the largest least distance of 200 drawn."""
    if languages <= 5:
        ways = range(1, 1 << (languages - 1))
        return np.array([[1 if w >> i & 1 else -1 for w in ways] for i in range(languages)])
    best, most = None, -1
    rng = np.random.default_rng(7)
    for _ in range(200):
        code = rng.choice([-1, 1], (languages, MAX_BITS))
        gaps = (code[:, None] != code[None]).sum(axis=2) + np.eye(languages, dtype=int) * MAX_BITS
        if gaps.min() > most and (abs(code.sum(axis=0)) < languages).all():
            best, most = code, gaps.min()
    return best


def fit_bits(x: np.ndarray, y: np.ndarray, steps: int = 120, ridge: float = 1e-5) -> np.ndarray:
    """Logistic regression of each column of ``y`` (+1, -1) on ``x`` and a
    constant, by Adam over all rows."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = x.T @ (-y / (1 + np.exp(np.clip(y * (x @ w), -30, 30)))).astype(np.float32) / len(x)
        g += ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.3 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> dict:
    """The model, from the labelled documents outside the held-out fold."""
    train = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).cast("string").alias("lang")) \
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    counts = {r["lang"]: r["n"] for r in
              train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return {"languages": [], "code": None, "weights": None}
    share = F.lit(1.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / counts[lang]))).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30)) / (1 << 30)

    def vectors(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts, len):
                x, _ = features(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").slice(a, b - a),
                     pa.array([r.astype(np.float16).tobytes() for r in x], pa.binary())], ["lang", "x"])

    # about per_language rows of BUCKETS half floats for each language
    rows = map_arrow(train.where(place < share).select("text", "lang"), vectors,
                     "lang string, x binary").toArrow()
    lang = np.array([languages.index(s) for s in rows["lang"].to_pylist()], np.int64)
    if not len(lang):
        return {"languages": [], "code": None, "weights": None}
    x = np.stack([np.frombuffer(r, np.float16) for r in rows["x"].to_pylist()]).astype(np.float32)
    order = np.lexsort((x @ np.arange(BUCKETS, dtype=np.float32), lang))  # as rows come in any order
    code = codewords(len(languages))
    weights = fit_bits(x[order], code[lang[order]].astype(np.float32)) if code.shape[1] else None
    return {"languages": languages, "code": code, "weights": weights}


def decode(margins: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best language, its score, its lead over the next) for each row."""
    loss = np.logaddexp(0, -margins[:, None, :] * code[None]).sum(axis=2)
    p = np.exp(loss.min(axis=1, keepdims=True) - loss)
    p /= p.sum(axis=1, keepdims=True)
    best = loss.argmin(axis=1)
    top = np.sort(p, axis=1)
    lead = top[:, -1] - (top[:, -2] if p.shape[1] > 1 else 0)
    return best, top[:, -1], lead


def _predictor(spark, model: dict):
    """texts -> (language, score, ambiguous) arrays, for use in tasks."""
    shared = spark.sparkContext.broadcast(model)

    def some(texts):
        m = shared.value
        x, known = features(texts)
        if m["weights"] is None:
            only = m["languages"][0] if m["languages"] else "und"
            known = known & (only != "und")
            names, score, lead = np.full(len(x), only, object), np.ones(len(x)), np.ones(len(x))
        else:
            best, score, lead = decode(x @ m["weights"][:-1] + m["weights"][-1], m["code"])
            names = np.array(m["languages"], object)[best]
        return (np.where(known, names, "und"), np.where(known, score, 0.0).astype(np.float64),
                ~known | (lead < AMBIGUOUS))

    def predicted(texts: list[str | None]):
        if not texts:
            return np.zeros(0, object), np.zeros(0), np.zeros(0, bool)
        parts = [some(texts[a:b]) for a, b in slices(texts, lambda t: len(t or ""))]
        return tuple(np.concatenate(p) for p in zip(*parts))
    return predicted


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) per row."""
    predicted = _predictor(docs.sparkSession, model)
    base = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            names, score, ambiguous = predicted(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(score), pa.array(ambiguous)],
                ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])
    return map_arrow(base, run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, "
                                "held_out boolean, lang_pred string, score double, ambiguous boolean")


def identified(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is clear: not ``und``
    and not ambiguous."""
    predicted = _predictor(docs.sparkSession, model)

    def run(batches):
        for batch in batches:
            _, _, ambiguous = predicted(batch.column(text_col).to_pylist())
            yield batch.filter(pa.array(~ambiguous))
    return map_arrow(docs, run, docs.schema)
