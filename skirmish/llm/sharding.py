"""Sharding by histogram sort: exact byte counts below probe keys, refined until splitters stand, one exchange.

Documents are ordered by (hash of the text, doc_id) and cut into ``shards`` ranges of nearly equal bytes.
Equal texts are neighbours in this order.  The splitters are found on a narrow table (hash, doc_id, size): each round
spreads probes over the interval of every splitter and counts the exact bytes between probes, one
partially aggregated row per probe; the bin that holds the target becomes the next interval.  When an interval has
come down to one text, a group of copies that takes at most ``tolerance`` of a shard is left whole (it
stays below the splitter); a larger group is cut inside, by the same rounds over doc_id.  Probes shrink every
interval by ``PROBES`` per round, so the rounds depend on the key width, not on the data.

Then the documents cross the network once, to (shard, part), get a gapless slot in the order (part, hash, doc_id), and are
written as files, one folder per shard.  A part holds about ``PART`` bytes of its shard: part = CRC-32 of ``<hash>:<doc_id>``
modulo their number, so a group of copies is spread over the parts as well.

Size of a document: UTF-8 bytes of its text plus 1.  With ``start`` the bytes before a document (before its group
of copies, if that is left whole), its shard is floor(shards * start / total).

Defined results: a null text has size 1 and shares its group with the empty text; a null doc_id sorts before all
others; rows that repeat (text, doc_id), rows without both among them, are never cut apart, so a shard may exceed its share by their
bytes; an empty table gives empty shards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

SHARDS = 16
PROBES = 64
TOLERANCE = 100  # a group of copies of at most 1 / TOLERANCE of a shard is left whole
PART = 64 << 20  # bytes of documents in a part of a shard
LEAST = -(1 << 63)


def key_of(text: str = "text") -> Column:
    """60 bits of the MD5 of the text."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(text), F.lit(""))), 1, 15), 16, 10).cast("bigint")


def size_of(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


@dataclass(frozen=True)
class Splitter:
    """Rows up to (key, doc_id) lie below; doc_id None means all rows of the key."""

    key: int
    doc_id: int | None


@dataclass
class Search:
    """Interval of ``column`` that holds the last value starting before the target; ``below``: bytes before it."""

    low: int
    high: int
    below: int
    size: int = 0


def refine(rows: DataFrame, column: str, searches: list[Search], targets: list[tuple[int, int]], probes: int = PROBES) -> None:
    """Narrow each search to one value of ``column``: the last one with factor * bytes before it < goal.

    ``targets`` has (factor, goal) of each search.  Every round is one aggregation; the driver gets at most
    searches * probes rows.
    """
    while any(s.low < s.high for s in searches):
        spans = sorted({(s.low, s.high) for s in searches if s.low < s.high})
        bin_ = F.lit(None).cast("struct<span:bigint,bin:bigint>")
        for n, (low, high) in enumerate(spans):  # intervals are equal or disjoint
            width = -(-(high - low + 1) // probes)
            place = F.struct(F.lit(n).cast("bigint").alias("span"),
                             F.expr(f"(({column} - ({low}L)) div {width}L)").alias("bin")) if high - low < 1 << 63 else F.struct(
                F.lit(n).cast("bigint").alias("span"),
                F.expr(f"cast(floor((cast({column} as decimal(20,0)) - ({low})) / {width}) as bigint)").alias("bin"))
            bin_ = F.when(F.col(column).between(low, high), place).otherwise(bin_)
        counted = (rows.select(column, "size", bin_.alias("b")).filter("b is not null").groupBy("b.span", "b.bin")
                   .agg(F.min(column).alias("low"), F.max(column).alias("high"), F.sum("size").alias("size")).collect())
        bins = {}
        for r in sorted(counted, key=lambda r: (r.span, r.bin)):
            bins.setdefault(spans[r.span], []).append(r)
        for s, (factor, goal) in zip(searches, targets):
            if s.low == s.high:
                continue
            below = s.below
            for r in bins[(s.low, s.high)]:
                if factor * below >= goal:
                    break
                s.low, s.high, s.below, s.size = r.low, r.high, below, r.size
                below += r.size


def splitters(sizes: DataFrame, shards: int = SHARDS, tolerance: int = TOLERANCE) -> list[Splitter]:
    """Splitters of (key, doc_id, size) rows; ``shards - 1`` of them, none for an empty table."""
    total, low, high = sizes.agg(F.sum("size"), F.min("key"), F.max("key")).first()
    if not total:
        return []
    goals = [(shards, i * total) for i in range(1, shards)]
    found = [Search(low, high, 0, total) for _ in goals]
    refine(sizes, "key", found, goals)
    out = [Splitter(s.low, None) for s in found]
    big = [i for i, s in enumerate(found) if s.size * shards * tolerance > total]
    for key in sorted({found[i].low for i in big}):  # at most shards - 1 groups are cut
        inside = [i for i in big if found[i].low == key]
        group = sizes.filter(F.col("key") == key).select(F.coalesce("doc_id", F.lit(LEAST)).alias("doc_id"), "size")
        ends = group.agg(F.min("doc_id"), F.max("doc_id")).first()
        searches = [Search(ends[0], ends[1], found[i].below, found[i].size) for i in inside]
        refine(group, "doc_id", searches, [goals[i] for i in inside])
        for i, s in zip(inside, searches):
            out[i] = Splitter(key, s.low)
    return out


def shard_of(cuts: list[Splitter], key: str, doc_id: str) -> Column:
    """Number of splitters below the row."""
    total = F.lit(0)
    for c in cuts:
        above = F.col(key) > c.key
        if c.doc_id is not None:
            above = above | ((F.col(key) == c.key) & (F.coalesce(F.col(doc_id), F.lit(LEAST)) > c.doc_id))
        total = total + above.cast("int")
    return total


def part_of(key: str, doc_id: str, parts: int) -> Column:
    return (F.crc32(F.concat(F.col(key).cast("string"), F.lit(":"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary")) % parts).cast("int")


def write(docs: DataFrame, path: str, shards: int = SHARDS, tolerance: int = TOLERANCE, part: int = PART) -> DataFrame:
    """Write ``docs`` as Parquet files in folders ``path/__shard=<n>`` with a column ``__slot``; returns a read of them.

    All columns of ``docs`` are kept.  Each part of a shard is a file sorted by (hash of the text, doc_id).
    """
    spark = docs.sparkSession
    keyed = docs.withColumn("__key", key_of())
    sizes = materialize(keyed.select(F.col("__key").alias("key"), "doc_id", size_of().alias("size")), "shard-sizes")
    cuts = splitters(sizes, shards, tolerance)
    parts = max(1, -(-(sizes.agg(F.sum("size")).first()[0] or 0) // (shards * part)))
    place = lambda key: [shard_of(cuts, key, "doc_id").alias("__shard"), part_of(key, "doc_id", parts).alias("__part")]
    counts = sizes.select(*place("key")).groupBy("__shard", "__part").agg(F.count("*").alias("n"))  # shards * parts rows
    before = F.coalesce(F.sum("n").over(Window.partitionBy("__shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__shard", "__part", before.alias("__before"))
    within = F.row_number().over(Window.partitionBy("__shard", "__part").orderBy("__key", "doc_id"))
    dealt = keyed.select("*", *place("__key"))
    if shards * parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        dealt = dealt.repartition(shards * parts, "__shard", "__part")
    dealt = dealt.withColumn("__slot", within).join(offsets, ["__shard", "__part"])  # offsets: a row per part, on the keys of the window
    dealt = dealt.withColumn("__slot", (F.col("__slot") - 1 + F.col("__before")).cast("bigint"))
    dealt.select(*docs.columns, "__slot", "__shard").write.partitionBy("__shard").parquet(path)
    return read(spark, path, dealt.select(*docs.columns, "__slot", "__shard").schema)


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    """The documents of the shards below ``path``."""
    return spark.read.schema(schema).parquet(path)
