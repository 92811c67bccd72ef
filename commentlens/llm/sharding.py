"""Minimax contiguous shards over groups of equal texts."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import lookup
from ..spark_env import materialize
from .common import inputs, running_sums, table

SHARDS = 16
# Capacities tried at once; each costs one comparison for each group near a cut.
WIDTH = 128


class Line:
    """Group sizes laid end to end: ``start`` and ``end`` of each group, in a table."""

    def __init__(self, groups: DataFrame, total: int):
        self.groups, self.total = groups, total

    def holding(self, points: list[int]) -> dict[int, tuple[int, int]]:
        """For each point inside the line, the group that holds it. One scan for all points."""
        inner = sorted({p for p in points if 0 <= p < self.total})
        if not inner:
            return {}
        wanted = F.array(*(F.lit(p) for p in inner))
        rows = (
            self.groups.filter((F.col("start") <= inner[-1]) & (F.col("end") > inner[0]))
            .filter(F.exists(wanted, lambda p: (F.col("start") <= p) & (p < F.col("end"))))
            .select("start", "end")
            .collect()  # a row for each point at most
        )
        spans = sorted((r["start"], r["end"]) for r in rows)
        starts = [s for s, _ in spans]
        return {p: spans[bisect_right(starts, p) - 1] for p in inner}

    def floors(self, points: list[int]) -> list[int]:
        """The largest group border at or before each point."""
        held = self.holding(points)
        return [self.total if p >= self.total else held[p][0] for p in points]


def smallest_capacity(line: Line, largest: int, shards: int = SHARDS, width: int = WIDTH) -> int:
    """The least capacity with which a greedy pass needs at most ``shards`` shards."""
    low = max(-(-line.total // shards), largest)
    high = max(-(-line.total // shards) + largest, low)  # a full shard then always passes the mean
    while low < high:
        tries = sorted({low + (high - low) * i // (width + 1) for i in range(width + 1)})
        at = [0] * len(tries)
        for _ in range(shards):
            at = line.floors([a + c for a, c in zip(at, tries)])
        fits = [a >= line.total for a in at]
        first = fits.index(True) if any(fits) else len(tries)
        high = tries[first] if first < len(tries) else high
        low = tries[first - 1] + 1 if first else high
    return high


def cuts(line: Line, capacity: int, shards: int = SHARDS) -> list[int]:
    """``shards - 1`` borders; no shard passes ``capacity`` and all lie near the mean.

    A greedy pass from the end gives the earliest place of each cut, one from the start the
    latest. Between them the border nearest to an even share of the rest is taken, so that one
    huge group does not leave other shards empty.
    """
    earliest = [line.total]
    for _ in range(shards - 1):
        p = earliest[-1] - capacity
        held = line.holding([p]) if p > 0 else {}
        earliest.append(0 if p <= 0 else p if held[p][0] == p else held[p][1])
    earliest = earliest[:0:-1]
    found, at = [], 0
    for k, least in enumerate(earliest):
        even = at + (line.total - at) // (shards - k)
        limit = min(at + capacity, line.total)
        held = line.holding([even, limit])
        near = [b for b in held.get(even, (line.total,)) if least <= b <= limit]
        at = min(near, key=lambda b: (abs(b - even), b)) if near else held.get(limit, (line.total,))[0]
        found.append(at)
    return found


def shard_documents(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Law ``bytes``: documents in ``shards`` shards of nearly equal size, equal texts together.

    Groups of equal texts are atoms, ordered by their smallest id (nulls first). The smallest
    feasible capacity is found by searching over greedy passes; a pass asks the sorted table of
    running sizes for a few borders and never holds the groups. Rows get slots by id within a
    shard. A missing text counts as an empty one, a missing id sorts first, repeated rows get
    slots of their own, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    content = F.coalesce(F.col("text"), F.lit(""))
    base = materialize(
        inputs(docs, doc_id, text).select(
            "doc_id",
            (F.octet_length(content) + 1).cast("long").alias("size"),
            F.crc32(content.cast("binary")).alias("text_crc32"),
            F.md5(content.cast("binary")).alias("key"),
        ),
        "shard-rows",
    )
    atoms = base.groupBy("key").agg(F.min("doc_id").alias("first"), F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    laid = running_sums(atoms, ["first", "key"], {"start": F.col("bytes")}, "shard-atoms")
    laid = materialize(laid.withColumn("end", F.col("start") + F.col("bytes")), "shard-line")
    found = laid.agg(F.sum("bytes").alias("total"), F.max("bytes").alias("largest")).first()
    line = Line(laid, found["total"] or 0)
    borders = cuts(line, smallest_capacity(line, found["largest"], shards), shards) if line.total else [0] * (shards - 1)
    shard = sum(((F.col("start") >= F.lit(b)).cast("int") for b in borders), F.lit(0))
    placed = laid.select("key", "n", shard.alias("shard"))
    rows = lookup(base, placed, "key", "n", F.xxhash64("doc_id"))
    slotted = running_sums(
        rows.select("doc_id", "size", "text_crc32", "shard"), ["doc_id", "text_crc32"], {"slot": F.lit(1)}, "shard-slots", "shard"
    )
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op4_sharding": (op4_sharding, None)}
