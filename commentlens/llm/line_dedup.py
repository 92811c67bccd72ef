"""Drops lines that many documents share, over levelled sorted runs of line hashes."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import let
from ..operators.skew import lookup
from ..spark_env import materialize, scratch_path
from .common import UPPER, WHITE_SPACE, inputs, lower_ascii, table, text_hash

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 3
# Least number of buckets, and lines that a bucket is meant for: some 50 MB of keys.
BUCKETS, BUCKET_LINES = 16, 1_000_000


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(WHITE_SPACE)))


class LineRuns:
    """Runs ``key, n_docs, keep`` in levels; ``keep`` is set in the run that met the key first.

    A run is a table bucketed and sorted by the key, so joining a batch to it shuffles the batch
    only. ``fanout`` runs of a level are merged into one of the next.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int = BUCKETS):
        self.spark, self.fanout, self.buckets = spark, fanout, buckets
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key")
        writer.option("path", scratch_path(self.spark, f"line-run-{level}")).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def add(self, batch: DataFrame) -> None:
        """``batch``: ``key, n_docs, keep``, one row per key. Keys the runs hold keep their first
        document and only add to the count; the others are the batch's own."""
        fresh = batch
        for name in (n for level in self.levels for n in level):
            known = self.spark.table(name).filter(F.col("keep").isNotNull()).select("key")
            fresh = fresh.join(known.hint("merge"), "key", "left_anti")
        if self.levels:
            fresh = materialize(fresh, "line-fresh")
            rest = batch.join(fresh.select("key").hint("merge"), "key", "left_anti")
            fresh = fresh.unionByName(rest.withColumn("keep", F.lit(None).cast("long")))
        self._write(fresh, 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        names, self.levels[level] = self.levels[level], []
        self._write(self._merged(names), level + 1)
        self._drop(names)

    def totals(self) -> DataFrame:
        return self._merged([n for level in self.levels for n in level])

    def _merged(self, names: list[str]) -> DataFrame:
        """A merge of sorted runs, bucket by bucket: no run is shuffled or sorted again."""
        out = self.spark.table(names[0])
        for n in names[1:]:
            other = self.spark.table(n).select("key", F.col("n_docs").alias("n2"), F.col("keep").alias("keep2"))
            out = out.join(other.hint("merge"), "key", "full").select(
                "key",
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n_docs"),
                F.coalesce("keep", "keep2").alias("keep"),
            )
        return out

    def _drop(self, names: list[str]) -> None:
        for n in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {n}")

    def close(self) -> None:
        self._drop([n for level in self.levels for n in level])
        self.levels = []


def buckets_for(spark: SparkSession, n_lines: int) -> int:
    """Buckets of every run over ``n_lines``: they grow with the lines, up to what the session allows."""
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    return min(most, max(BUCKETS, math.ceil(n_lines / BUCKET_LINES)))


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``id, row, at, key`` for every line long enough: its document, row, place and key hash."""
    lines = docs.select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("id"),
        text_hash(F.col("text")).alias("row"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("at", "line"),
    )
    keyed = lines.select("id", "row", "at", line_key(F.col("line")).alias("line"))
    return keyed.filter(F.length("line") >= min_chars).select("id", "row", "at", F.md5(F.col("line").cast("binary")).alias("key"))


def shared_lines(lines: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``key, n_docs, keep`` of the keys in at least ``min_docs`` documents; the largest id keeps.

    Documents come in batches of falling ids, so the first run that meets a key has its keeper.
    """
    edges = lines.approxQuantile("id", [i / batches for i in range(1, batches)], 0.02)
    edges = sorted({int(e) for e in edges})
    runs = LineRuns(lines.sparkSession, buckets=buckets_for(lines.sparkSession, lines.count()))
    try:
        for low, high in reversed(list(zip([None, *edges], [*edges, None]))):
            batch = lines
            if low is not None:
                batch = batch.filter(F.col("id") >= low)
            if high is not None:
                batch = batch.filter(F.col("id") < high)
            once = batch.groupBy("key", "id").agg(F.lit(1).alias("one"))
            counted = once.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keep"))
            runs.add(materialize(counted, "line-batch"))
        return materialize(runs.totals().filter(F.col("n_docs") >= min_docs), "line-shared")
    finally:
        runs.close()


def drop_shared_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` and the columns to ``carry``: documents without the
    lines that many share.

    A document is an id: rows that repeat an id count once, and a missing id is one document that
    sorts before all others. A missing or empty text is one empty line, which is too short to be
    dropped. Line ends other than ``\\n`` are white space of their line.
    """
    carry = carry or []
    docs = inputs(docs, doc_id, text, F.struct(F.lit(0).alias("none"), *carry).alias("_carried"))
    lines = materialize(keyed_lines(docs, min_chars), "lines")
    shared = shared_lines(lines, min_docs)
    met = lookup(lines, shared, "key", "n_docs", F.xxhash64("id", "at"))
    gone = met.filter(F.col("id") != F.col("keep")).groupBy("id", "row").agg(F.collect_set("at").alias("gone"))
    joined = docs.select(
        "doc_id", "text", "_carried", F.coalesce("doc_id", F.lit(-(2**63))).alias("id"), text_hash(F.col("text")).alias("row")
    ).join(gone.hint("merge"), ["id", "row"], "left")
    split = F.split(F.coalesce("text", F.lit("")), "\n")

    def without(all_lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(all_lines, i)), "\n")

    return joined.select(
        "doc_id",
        F.size(split).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(let(split, without)).alias("text"),
        *(F.col("_carried")[c].alias(c) for c in carry),
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL = f"""
with cut as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
lines as (select doc_id, unnest(range(1, len(ls) + 1)) as place, unnest(ls) as line from cut),
keyed as (select *, translate(trim(line, {_SPACE}), '{UPPER}', '{UPPER.lower()}') as key from lines),
hot as (select key, max(doc_id) as keep from keyed where length(key) >= {MIN_CHARS}
  group by key having count(distinct doc_id) >= {MIN_DOCS}),
marked as (select k.doc_id, place, line, keep is not null and k.doc_id <> keep as gone from keyed k left join hot using (key))
select doc_id, count(*) as n_lines, cast(sum(gone::int) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""

QUERIES = {"op10_line_dedup": (op10_line_dedup, SQL)}
