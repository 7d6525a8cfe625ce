"""Near-duplicate documents by circulant MinHash.

A document's set holds its distinct ``words``-word shingles as 64-bit hashes.
One permutation (sigma) places the shingles in a universe of 2**32, and one
second permutation (pi), shifted circularly by 0, 1, 2, ..., gives all
signature coordinates: coordinate k is the least pi(sigma(x) + k mod 2**32).

1. One pass over the texts gives each document's set digest, the keys of its
   ``BANDS`` bands of ``ROWS`` coordinates, and a sketch of one bit for each
   coordinate. Documents with equal sets become one class.
2. Classes that share a band key are candidates. Each is compared with the
   smallest class of its key (a star, not all pairs). Where a key's classes
   then still fall into several components, each is compared with ``HUBS``
   others, and what is still apart after that with whatever a prefix filter
   on the differences to the key's hub leaves (see ``_cross_pairs``). So every
   candidate pair is either confirmed, refuted or already joined.
3. Candidates whose sizes and sketches allow the similarity are compared on
   their full sets, which are rebuilt once from the texts; one class with many
   candidates is split over salted groups.
4. Components of the confirmed links give the result.

A pair of similarity s shares no key with probability (1 - s**4)**32: 5e-8 at
0.8, less above; the sketch refuses a pair at 0.8 with probability under 1e-8.

Defined results: a null, empty or white-space text has an empty set, is linked
with nothing and kept; a text with fewer words than a shingle has one shingle,
its whole sequence; rows that share a ``doc_id`` are one document, whose pairs are
compared by its least text; a row with
a null ``doc_id`` is linked with nothing, has a null component and is kept;
the kept document of a component is the one with the smallest id, so ties do
not arise; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, written
from .components import components

BANDS, ROWS = 32, 4
COORDINATES = BANDS * ROWS
#: Sketch bits that may differ: 12.8 of 128 do at 0.8 on average.
SKETCH_LIMIT = 35
#: Classes of a key that all others meet in the second round.
HUBS = 6
#: Groups over which the members of one hub are dealt for the prefix filter.
SALTS = 32
#: Comparisons with one class that one task group holds.
GROUP = 256
#: Characters that a task shingles at once (one document at least).
SLICE_CHARS = 1_000_000
_CHUNK = 1024


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text. Words part at ASCII
    white space and only A-Z is lower-cased."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    of_word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()),
                          np.uint64, len(coded.dictionary))
    hashes = of_word[coded.indices.to_numpy()][real]
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    bounds = np.concatenate([[0], np.cumsum(real)])[offsets]
    out = []
    with np.errstate(over="ignore"):
        for a, b in zip(bounds, bounds[1:]):
            h, n = hashes[a:b], min(words, int(b - a))
            if not n:
                out.append(h)
                continue
            s = np.full(len(h) - n + 1, n, np.uint64)
            for i in range(n):
                s = _mix64(s * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - n + 1 + i])
            out.append(np.unique(s))
    return out


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Circulant MinHash coordinates of a non-empty set."""
    low = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    shift = np.arange(coordinates, dtype=np.uint32)
    with np.errstate(over="ignore"):
        sigma = (_mix64(shingles) >> np.uint64(32)).astype(np.uint32)
        for start in range(0, len(sigma), _CHUNK):
            x = sigma[start:start + _CHUNK, None] + shift
            x ^= x >> np.uint32(16)
            x *= np.uint32(0x85EBCA6B)
            x ^= x >> np.uint32(13)
            x *= np.uint32(0xC2B2AE35)
            x ^= x >> np.uint32(16)
            np.minimum(low, x.min(axis=0), out=low)
    return low


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; equal coordinates in different bands
    give different keys."""
    with np.errstate(over="ignore"):
        key = np.arange(1, BANDS + 1, dtype=np.uint64)
        for r in range(ROWS):
            key = _mix64(key * np.uint64(0x9E3779B97F4A7C15) + sig.reshape(BANDS, ROWS)[:, r])
    return key.view(np.int64)


def _slices(batches):
    for batch in batches:
        chars = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(chars) // SLICE_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _sketches(words):
    def run(batches):
        for batch in _slices(batches):
            digests, counts, bits, keys = [], [], ([], []), []
            for s in shingle_sets(batch.column("text"), words):
                counts.append(len(s))
                if not len(s):
                    for column in (digests, keys, *bits):
                        column.append(None)
                    continue
                sig = signature(s)
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                halves = np.packbits(sig & np.uint32(1)).view(np.int64)
                bits[0].append(halves[0])
                bits[1].append(halves[1])
                keys.append(band_keys(sig))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bits[0], pa.int64()), pa.array(bits[1], pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "bits0", "bits1", "bands"])
    return run


def _sets(words):
    """(rep, shingles): the sorted shingle hashes, 8 bytes each."""
    def run(batches):
        for batch in _slices(batches):
            sets = [s.tobytes() for s in shingle_sets(batch.column("text"), words)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())],
                                             ["rep", "shingles"])
    return run


def _confirm(percent):
    """Streams rows sorted so that a group's hub comes before its members."""
    def run(batches):
        at, hub_set = None, None
        for batch in batches:
            hubs, docs = [], []
            for hub, salt, member, doc, raw in zip(*(c.to_pylist() for c in batch.columns)):
                shingles = np.frombuffer(raw, np.uint64)
                if not member:
                    at, hub_set = (hub, salt), shingles
                elif (hub, salt) == at:
                    both = len(np.intersect1d(hub_set, shingles, assume_unique=True))
                    if both and 100 * both >= percent * (len(hub_set) + len(shingles) - both):
                        hubs.append(hub)
                        docs.append(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hubs, pa.int64()), pa.array(docs, pa.int64())], ["a", "b"])
    return run


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and sketches allow the similarity."""
    side = lambda p: classes.select(*(F.col(c).alias(p + c) for c in
                                      ("rep", "n_shingles", "bits0", "bits1")))
    both = (pairs.join(side("a_"), F.col("a") == F.col("a_rep"))
            .join(side("b_"), F.col("b") == F.col("b_rep")))
    return both.where(_may_link("a_", "b_", percent)).select("a", "b")


def _may_link(p: str, q: str, percent: int) -> Column:
    low = F.least(p + "n_shingles", q + "n_shingles")
    high = F.greatest(p + "n_shingles", q + "n_shingles")
    differ = (F.bit_count(F.col(p + "bits0").bitwiseXOR(F.col(q + "bits0")))
              + F.bit_count(F.col(p + "bits1").bitwiseXOR(F.col(q + "bits1"))))
    return (100 * low >= percent * high) & (differ <= SKETCH_LIMIT)


def _with_hub(members: DataFrame, sets: DataFrame, *extra: str) -> DataFrame:
    """(hub, salt, member, rep, extra, shingles) for rows (hub, rep, salt,
    extra), sorted so that in each group the hub's own set comes first."""
    hub = members.select("hub", F.col("hub").alias("rep"), "salt", F.lit(0).alias("member"),
                         *(F.lit(None).cast("long").alias(c) for c in extra)).distinct()
    roles = members.where("rep != hub").select("hub", "rep", "salt", F.lit(1).alias("member"),
                                               *extra).union(hub)
    return (sets.join(roles, "rep").select("hub", "salt", "member", "rep", *extra, "shingles")
            .repartition("hub", "salt").sortWithinPartitions("hub", "salt", "member"))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar. The sets of a's partners
    meet a's own, about ``GROUP`` of them to a group."""
    salted = written(_salted(pairs), "minhash-pairs").select(
        F.col("a").alias("hub"), F.col("b").alias("rep"), "salt")
    return written(map_arrow(_with_hub(salted, sets), _confirm(percent), "a long, b long"),
                   "minhash-links", let_go=True)


def _salted(pairs: DataFrame) -> DataFrame:
    groups = (pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
              .select("a", F.ceil(F.col("n") / GROUP).alias("groups")))
    return pairs.join(groups, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("salt"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``: documents
    are linked when 100 * intersection >= percent * union of their sets."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    sketches = written(map_arrow(docs, _sketches(words),
                                 "doc_id long, n_shingles long, digest binary, bits0 long, "
                                 "bits1 long, bands array<long>"), "minhash-sketches")
    known = sketches.where("digest is not null and doc_id is not null")
    classes = written(known.groupBy("digest").agg(F.min_by(
        F.struct("doc_id", "n_shingles", "bits0", "bits1", "bands"), "doc_id").alias("c"))
        .select("digest", F.col("c.doc_id").alias("rep"), "c.n_shingles", "c.bits0", "c.bits1",
                "c.bands"), "minhash-classes")

    keys = classes.select("rep", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("hub")) \
        .where("n > 1")
    members = written(keys.join(shared, "key").select("key", "rep", "hub"), "minhash-buckets", let_go=True)
    involved = written(members.select(F.col("rep").alias("doc_id")).distinct(), "minhash-involved")
    texts = docs.join(involved, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    sets = written(map_arrow(texts, _sets(words), "rep long, shingles binary"), "minhash-sets", let_go=True)

    star = (members.where("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
            .distinct())
    tested = written(_plausible(star, classes, percent), "minhash-star")
    links = confirm(tested, sets, percent)
    found = written(components(links, "a", "b"), "minhash-components")
    for further in (_other_hubs, _cross_pairs):
        pairs = _plausible(further(_mixed(members, found), sets, percent), classes, percent)
        pairs = written(pairs.join(tested, ["a", "b"], "left_anti"), "minhash-candidates")
        if not pairs.isEmpty():
            tested = tested.union(pairs)
            links = links.union(confirm(pairs, sets, percent))
            found = written(components(links, "a", "b"), "minhash-components")

    of_class = (classes.select("digest", "rep")
                .join(found, F.col("rep") == F.col("node"), "left")
                .select("digest", F.coalesce("component", "rep").alias("component")))
    own = F.coalesce(F.col("component"), F.col("doc_id"))
    return (sketches.select("doc_id", "n_shingles",
                            F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
            .join(of_class, "digest", "left")
            .select("doc_id", "n_shingles", own.alias("component_id"),
                    own.eqNullSafe(F.col("doc_id")).alias("kept")))


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members of those keys whose classes are in several components."""
    labelled = (members.join(found, F.col("rep") == F.col("node"), "left")
                .select("key", "rep", "hub", F.coalesce("component", "rep").alias("component")))
    mixed = (labelled.groupBy("key").agg(F.min("component").alias("low"),
                                         F.max("component").alias("high"))
             .where("low < high").select("key"))
    return written(labelled.join(mixed, "key"), "minhash-mixed")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a_rep", "b_rep").alias("a"),
                        F.greatest("a_rep", "b_rep").alias("b")).distinct()


def _other_hubs(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class of a mixed key and ``HUBS`` of the key's classes in
    other components, the same ones for keys with the same classes."""
    hubs = mixed.groupBy("key").agg(F.array_distinct(F.array(*(
        F.min_by(F.struct("rep", "component"), F.xxhash64("rep", F.lit(i))) for i in range(HUBS))))
        .alias("hubs"))
    hubs = hubs.select("key", F.explode("hubs").alias("h")).select(
        "key", F.col("h.rep").alias("a_rep"), F.col("h.component").alias("a_component"))
    members = mixed.select("key", F.col("rep").alias("b_rep"), F.col("component").alias("b_component"))
    return _ordered(members.join(hubs, "key").where("a_component != b_component"))


def _cross_pairs(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs with a common key in different components that can be
    similar, found by a prefix filter on differences to the key's hub.

    Let D be the symmetric difference of a set and the hub's. Two sets of a
    similarity of ``percent`` have D's with t elements in common, where t grows
    with the D's sizes. Linked to the hub are those with a small D; these are
    in one component, so one of a pair is a stray with a large D. Under one
    order of all elements, D's with t common elements share one of the first
    |D| - t + 1 of each; the order puts elements first that few D's of the hub
    hold. So the strays of a group meet few others, and the group's pairs are
    never listed."""
    members = mixed.select("hub", "rep", "component").distinct()
    rows = map_arrow(_with_hub(members.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS))),
                               sets, "component"),
                     _differences(percent), "hub long, rep long, component long, element long, "
                                            "wide long, narrow long, d long, n long")
    rows = written(rows, "minhash-differences", let_go=True)
    held = rows.groupBy("hub", "element").agg(F.count(F.lit(1)).alias("held"))
    rarest = Window.partitionBy("hub", "rep").orderBy("held", "element")  # one document's elements
    rows = (rows.join(held, ["hub", "element"])
            .withColumn("place", (F.row_number().over(rarest) - 1).cast("long"))
            .where(F.col("place") < F.greatest("wide", "narrow")))
    rows = written(rows.withColumn("wide", F.col("place") < F.col("wide"))
                   .withColumn("narrow", F.col("place") < F.col("narrow")), "minhash-prefixes",
                   let_go=True)
    side = lambda p, kind: rows.where(kind).select("hub", "element", *(
        F.col(c).alias(p + c) for c in ("rep", "component", "place", "d", "n")))
    # what the D's can have in common if this element is the first
    common = F.least(F.expr("a_d - a_place"), F.expr("b_d - b_place"))
    a, b = _ratio(percent)
    enough = 2 * b * common >= F.expr(f"{b} * (a_d + b_d) - {a} * (a_n + b_n)")
    return _ordered(side("a_", "wide").join(side("b_", "narrow"), ["hub", "element"])
                    .where((F.col("a_component") != F.col("b_component")) & enough))


def _ratio(percent: int) -> tuple[int, int]:
    """(a, b): sets of sizes m and n are similar when their symmetric
    difference is at most (m + n) * a / b."""
    a, b = 100 - percent, 100 + percent
    return a // math.gcd(a, b), b // math.gcd(a, b)


def _differences(percent):
    """The elements of each D with the lengths of the prefixes by which it is
    found: ``wide`` as a stray (0: it is none), ``narrow`` as the partner of one."""
    a, b = _ratio(percent)

    def run(batches):
        at, hub_set = None, None
        for batch in batches:
            out, elements = [[] for _ in range(7)], []
            for hub, salt, member, rep, component, raw in zip(*(c.to_pylist() for c in batch.columns)):
                shingles = np.frombuffer(raw, np.uint64)
                if not member:
                    at, hub_set = (hub, salt), shingles
                    continue
                if (hub, salt) != at:
                    continue
                diff = np.setxor1d(shingles, hub_set, assume_unique=True)
                d, n, h = len(diff), len(shingles), len(hub_set)
                is_stray = b * d > a * (n + h)
                narrow = d + 1 - -(-(b * d + a * (h - n) + 1) // (2 * b))
                wide = d + 1 - max(1, -(-(b * d - a * (n + 100 * n // percent)) // (2 * b)))
                elements.append(diff.view(np.int64))
                for column, value in zip(out, (hub, rep, component, wide if is_stray else 0, narrow, d, n)):
                    column.append(np.full(d, value))
            if elements:
                hub, rep, component, *rest = (pa.array(np.concatenate(c)) for c in out)
                yield pa.RecordBatch.from_arrays(
                    [hub, rep, component, pa.array(np.concatenate(elements)), *rest],
                    ["hub", "rep", "component", "element", "wide", "narrow", "d", "n"])
    return run
