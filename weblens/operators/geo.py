"""IP location as a range (point-in-interval) join.

Spark has no interval join: a plain ``ip BETWEEN begin AND end`` left join
plans as a nested-loop join. Instead each range is exploded to the ``/16``
buckets it covers and the lookup becomes an equi-join on the bucket with the
``between`` test as a residual condition in the ON clause (so the left join
keeps misses). For disjoint ranges the exploded table has at most
``2^16 + N`` rows, which bounds the broadcast side independently of the fact
data; its actual size is checked before broadcasting, and beyond the limit
the join shuffles on the bucket (AQE splits a hot bucket).

Real tables crowd: one ``/16`` may hold thousands of ranges, and every address in
it would be compared with all of them. A bucket with more than ``MOST_RANGES``
ranges is split into ``/24`` blocks, and these into ``/28`` blocks of 16 addresses,
so an address is compared with that many ranges at most. Which blocks are
split is a small table that addresses meet first; a table without crowded
buckets has none.

A prepared ``RangeTable`` first rewrites the ranges so the answer is the
original lookup's for any table, overlapping or not: the range with the
greatest begin not after the address answers, if the address is not past
its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.ip import address, ip_to_long, long_to_ip
from ..functions.parse import is_not_blank
from ..functions.region import normalize_region
from ..session import BROADCAST_MAX_BYTES, materialize_sized

# What a lookup answers for an address outside every range.
NOT_FOUND_COUNTRY = "未知国家"
NOT_FOUND_AREA = "未知地区"
UNKNOWN = "unknown"

BUCKET_BITS = 16
# Ranges of a block that is not split, and the steps of splitting (bits below
# the block's prefix; 2^4 addresses hold 16 disjoint ranges at most).
MOST_RANGES = 32
FINER_BITS = (8, 4)
# Numbers of IPv4 addresses run from 0 to below this.
ADDRESSES = 1 << 32
# Exploded range rows allowed on the broadcast side (bytes are bounded too,
# by session.BROADCAST_MAX_BYTES).
BROADCAST_MAX_ROWS = 2_000_000


def bucket_ranges(ranges: DataFrame, bits: int = BUCKET_BITS) -> DataFrame:
    """One row per (range, bucket it overlaps).

    The region of a range depends only on its location text, so it is
    normalised here, once per range, instead of once per looked-up row."""
    region = normalize_region(F.col("country"))
    begin, end = F.col("begin_ip").cast("long"), F.col("end_ip").cast("long")
    some = (begin <= end) & (end >= 0) & (begin < ADDRESSES)
    return ranges.where(some).select(
        F.explode(F.sequence(F.shiftright(F.greatest(begin, F.lit(0).cast("long")), bits),
                             F.shiftright(F.least(end, F.lit(ADDRESSES - 1)), bits))).alias("_bucket"),
        F.col("begin_ip").alias("_begin"), F.col("end_ip").alias("_end"),
        F.col("country").alias("_country"), F.col("area").alias("_area"),
        region["country"].alias("_r_country"), region["province"].alias("_r_province"),
        region["city"].alias("_r_city"))


def check_disjoint(ranges: DataFrame, bits: int = BUCKET_BITS) -> DataFrame:
    """Pairs of overlapping neighbour ranges (empty when the table is valid).

    Two ranges that overlap share a bucket, so comparing neighbours inside
    each bucket finds every overlap without a global sort."""
    w = Window.partitionBy("_bucket").orderBy("_begin", "_end")
    b = bucket_ranges(ranges, bits)
    return (b.withColumn("_prev_end", F.lag("_end").over(w))
             .where(F.col("_prev_end") >= F.col("_begin"))
             .select("_bucket", "_begin", "_end", "_prev_end"))


def effective_ranges(ranges: DataFrame, bits: int = BUCKET_BITS) -> DataFrame:
    """Rewrite any range table into disjoint ranges with the lookup's exact
    answer: the range with the greatest ``begin <= ip`` answers, and only if
    ``ip <= end``. So each range really covers ``[begin, min(end, next
    begin - 1)]``. Ranges with equal begins keep the greatest end; inverted
    ranges still block their predecessors but cover nothing; ends outside the
    address space are cut to it, and of the ranges that begin before it only
    the last can answer.

    The next begin needs no global sort and no explode of the (possibly
    overlapping) ranges: it is the next one in the bucket of ``begin``, else
    the first of the next bucket of the same group of 256 buckets, else the
    first of the next group. Groups are at most ``2^(24 - bits)``, a bounded
    array. Runs on the dimension only, never on the looked-up rows."""
    valid = ranges.where(F.col("begin_ip").isNotNull() & F.col("end_ip").isNotNull()
                         & (F.col("begin_ip") < ADDRESSES))
    one = (valid.groupBy(F.greatest(F.col("begin_ip").cast("long"), F.lit(0).cast("long")).alias("_at"))
                .agg(F.max(F.struct("begin_ip", "end_ip", "country", "area")).alias("_r"))
                .select(F.col("_at").alias("begin_ip"),
                        F.least(F.col("_r.end_ip").cast("long"), F.lit(ADDRESSES - 1)).alias("end_ip"),
                        "_r.country", "_r.area",
                        F.shiftright("_at", bits).alias("_bucket"),
                        F.shiftright("_at", bits + 8).alias("_group")))
    firsts = (one.groupBy("_group", "_bucket").agg(F.min("begin_ip").alias("_first"))
                 .withColumn("_after", F.lead("_first").over(
                     Window.partitionBy("_group").orderBy("_bucket")))
                 .select("_bucket", "_after"))
    heads = (one.groupBy("_group").agg(F.min("begin_ip").alias("_head"))
                .agg(F.sort_array(F.collect_list("_head")).alias("heads")))
    w = Window.partitionBy("_bucket").orderBy("begin_ip")
    staged = (one.withColumn("_inside", F.lead("begin_ip").over(w))
                 .join(firsts, "_bucket")
                 .withColumn("_heads", heads.scalar()))
    later = F.get(F.filter("_heads", lambda h: F.shiftright(h, bits + 8) > F.col("_group")), 0)
    nxt = F.coalesce("_inside", "_after", later)
    end = F.when(nxt.isNull(), F.col("end_ip")).otherwise(F.least(F.col("end_ip"), nxt - 1))
    return (staged.select("begin_ip", end.alias("end_ip"), "country", "area")
                  .where(F.col("end_ip") >= F.col("begin_ip")))


def _block_key(prefix, bits: int):
    """A block's key: the bits below its prefix, and the prefix."""
    return F.lit(bits << 40).cast("long") + prefix


def _split_blocks(blocks: DataFrame, bits: int, finer: int) -> DataFrame:
    """Rows of crowded blocks, one for each finer block that the range overlaps."""
    start = F.shiftleft(F.col("_bucket"), bits)
    first = F.shiftright(F.greatest("_begin", start), finer)
    last = F.shiftright(F.least(F.col("_end"), start + ((1 << bits) - 1)), finer)
    return blocks.withColumn("_bucket", F.explode(F.sequence(first, last)))


class RangeTable:
    """A range dimension prepared for repeated lookups: the bucket explode,
    the split of crowded buckets, the broadcast decision and, optionally, the
    disjointness check. The tables are written once, sized by the job that
    writes them. ``exact=True`` (the default) first rewrites the table with
    ``effective_ranges`` so overlapping or duplicate ranges answer like the
    original binary search and can never duplicate a looked-up row; only
    such a table is split."""

    def __init__(self, ranges: DataFrame, bits: int = BUCKET_BITS,
                 broadcast_max_rows: int = BROADCAST_MAX_ROWS, validate: bool = False,
                 exact: bool = True, most_ranges: int = MOST_RANGES):
        self.bits = bits
        if validate:
            bad = check_disjoint(ranges, bits).limit(1).collect()
            if bad:
                raise ValueError(f"overlapping IP ranges, e.g. {bad[0].asDict()}")
        if exact:
            ranges = effective_ranges(ranges, bits)
        # computed once (at most 2^16 + N rows); every lookup then reads it
        # instead of redoing the rewrite
        blocks, rows, size = materialize_sized(bucket_ranges(ranges, bits))
        self.crowded: list[tuple[int, DataFrame]] = []  # finer bits, blocks that have them
        kept, at = [], bits
        for finer in [b for b in FINER_BITS if exact and b < bits]:
            dense = blocks.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_ranges)
            dense, n, dense_size = materialize_sized(dense.select("_bucket"))
            if not n:
                break
            if n <= broadcast_max_rows and dense_size <= BROADCAST_MAX_BYTES:
                dense = F.broadcast(dense)
            kept.append(blocks.join(dense, "_bucket", "left_anti").withColumn("_block", _block_key(F.col("_bucket"), at)))
            self.crowded.append((finer, dense.select(_block_key(F.col("_bucket"), at).alias("_split"))))
            blocks = _split_blocks(blocks.join(dense, "_bucket", "left_semi"), at, finer)
            at = finer
        out = blocks.withColumn("_block", _block_key(F.col("_bucket"), at))
        for part in kept:
            out = out.unionByName(part)
        out = out.drop("_bucket")
        if kept:
            out, rows, size = materialize_sized(out)
        self.blocks = out
        self.broadcast = rows <= broadcast_max_rows and size <= BROADCAST_MAX_BYTES

    def side(self) -> DataFrame:
        return F.broadcast(self.blocks) if self.broadcast else self.blocks


def _range_join(df: DataFrame, ip_col: str, table: RangeTable) -> DataFrame:
    ip = F.col(ip_col)
    probe = df.withColumn("_probe", _block_key(F.shiftright(ip, table.bits), table.bits))
    for finer, split in table.crowded:
        probe = (probe.join(split, F.col("_probe") == F.col("_split"), "left")
                 .withColumn("_probe", F.when(F.col("_split").isNotNull(), _block_key(F.shiftright(ip, finer), finer))
                             .otherwise(F.col("_probe"))).drop("_split"))
    b = table.side()
    cond = ((probe["_probe"] == b["_block"])
            & (ip >= b["_begin"]) & (ip <= b["_end"]))
    return probe.join(b, cond, "left").drop("_probe", "_block")


def locate(df: DataFrame, ranges: DataFrame | RangeTable, ip_col: str = "ip_long", *,
           bits: int = BUCKET_BITS, dedup: bool = False,
           broadcast_max_rows: int = BROADCAST_MAX_ROWS,
           not_found: tuple[str, str] = (NOT_FOUND_COUNTRY, NOT_FOUND_AREA),
           keep_range: bool = False, with_region: bool = False) -> DataFrame:
    """Add ``geo_country, geo_area`` (and optionally ``range_begin/range_end``)
    for the numeric address in ``ip_col`` (J1).

    A null address gives null location; an address outside every range gets
    the ``not_found`` texts. ``dedup=True`` looks up each distinct address
    once and joins the answers back (J3) - worthwhile when addresses repeat
    heavily and the distinct set is small enough to broadcast back.
    Pass a ``RangeTable`` to reuse one prepared dimension across lookups.
    ``with_region`` also adds ``region_country/province/city`` (P11) taken
    from the prepared dimension (a miss gets the region of the not-found
    text, folded to a constant by the optimizer)."""
    ip = F.col(ip_col)
    table = (ranges if isinstance(ranges, RangeTable)
             else RangeTable(ranges, bits, broadcast_max_rows))

    def finish(joined: DataFrame) -> DataFrame:
        hit = F.col("_begin").isNotNull()
        out = joined.withColumn(
            "geo_country", F.when(ip.isNull(), None).when(hit, F.col("_country"))
            .otherwise(F.lit(not_found[0]))
        ).withColumn(
            "geo_area", F.when(ip.isNull(), None).when(hit, F.col("_area"))
            .otherwise(F.lit(not_found[1])))
        if with_region:
            miss = normalize_region(F.lit(not_found[0]))
            out = out.withColumns({
                f"region_{k}": F.when(ip.isNull(), None).when(hit, F.col(f"_r_{k}"))
                .otherwise(miss[k]) for k in ("country", "province", "city")})
        if keep_range:
            out = out.withColumnRenamed("_begin", "range_begin").withColumnRenamed("_end", "range_end")
        return out.drop("_begin", "_end", "_country", "_area", "_r_country", "_r_province", "_r_city")

    if not dedup:
        return finish(_range_join(df, ip_col, table))

    keys = df.select(ip).where(ip.isNotNull()).distinct()
    # written once, with the size that decides about the broadcast
    answers, rows, size = materialize_sized(finish(_range_join(keys, ip_col, table)))
    if rows <= broadcast_max_rows and size <= BROADCAST_MAX_BYTES:
        answers = F.broadcast(answers)
    return df.join(answers, on=ip_col, how="left")


def area_of(df: DataFrame, ranges: DataFrame, ip_col: str = "ip_long", **kw) -> DataFrame:
    """Area-only lookup."""
    return locate(df, ranges, ip_col, **kw).drop("geo_country")


def find_ranges(ranges: DataFrame, text: str) -> DataFrame:
    """Ranges whose country or area contains ``text`` (F1), as dotted text."""
    hit = (F.coalesce(F.col("country").contains(text), F.lit(False))
           | F.coalesce(F.col("area").contains(text), F.lit(False)))
    return ranges.where(hit).select(
        long_to_ip("begin_ip").alias("begin_ip"), long_to_ip("end_ip").alias("end_ip"),
        "country", "area")


def range_end_ips(ranges: DataFrame) -> DataFrame:
    """The end address of every range, dotted (F2)."""
    return ranges.select(long_to_ip("end_ip").alias("end_ip"))


def enrich_geo(df: DataFrame, ranges: DataFrame, ip_text: str = "ip", *,
               fill: bool = True, **kw) -> DataFrame:
    """Add ``country, province, city`` for the dotted address in ``ip_text``.

    Blank or invalid addresses skip the lookup; with ``fill`` every null
    becomes ``unknown`` (P7), as the ETL does."""
    # blank or malformed text has no dotted form, so ip_to_long gives null
    with_ip = df.withColumn("_ip_long", ip_to_long(F.col(ip_text)))
    located = locate(with_ip, ranges, "_ip_long", with_region=True, **kw)
    # a null address means the lookup was skipped: all three stay null
    cols = {k: F.col(f"region_{k}") for k in ("country", "province", "city")}
    if fill:
        cols = {k: F.coalesce(v, F.lit(UNKNOWN)) for k, v in cols.items()}
    return located.withColumns(cols).drop(
        "_ip_long", "geo_country", "geo_area", "region_country", "region_province", "region_city")


def locate_address(df: DataFrame, ranges: DataFrame, ip_col: str = "ip_long", **kw) -> DataFrame:
    """``address`` text (country + area) of each address."""
    located = locate(df, ranges, ip_col, **kw)
    return located.withColumn("address", address("geo_country", "geo_area")).drop("geo_country", "geo_area")


def line_geo_map(lines: DataFrame, ranges: DataFrame, line_col: str = "value", **kw) -> DataFrame:
    """One map ``{ip, country, province, city}`` per line (P19); a blank line
    gives an empty map, a non-blank one leaves the lookup fields as found."""
    line = F.col(line_col)
    ip = F.get(F.split(line, " "), 0)
    staged = lines.withColumn("_blank", ~is_not_blank(line)).withColumn("_ip", ip)
    geo = enrich_geo(staged, ranges, "_ip", fill=False, **kw)
    m = F.create_map(F.lit("ip"), F.col("_ip"), F.lit("country"), F.col("country"),
                     F.lit("province"), F.col("province"), F.lit("city"), F.col("city"))
    empty = F.create_map().cast("map<string,string>")
    return geo.withColumn("geo", F.when(F.col("_blank"), empty).otherwise(m)).drop(
        "_blank", "_ip", "country", "province", "city")
