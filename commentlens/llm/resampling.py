"""Drawing documents that look like a target corpus: hashed n-gram importance weights.

Each text is scanned once, with running CRCs over its words joined by single spaces; the CRC of every
n-gram follows from two of them (``crc``). Bucket counts of both corpora give each bucket a gain, a
document's weight is the sum of its features' gains, and noise that only depends on the id turns
the weights into a draw without replacement.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spark_env import discard, materialize
from .common import inputs, running_sums, ship, table
from .crc import running_crcs, shift

LONGEST = 1
BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20
SEED = "2024"
# Words that one step of a task looks at together.
LOT = 1_000_000

# Bytes of words stay (A-Z in lower case), all others become spaces. Bytes of non-ASCII letters are words.
_SEPARATED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_SEPARATED).split() if text else []


def feature_buckets(texts: list[list[bytes]], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of 1 to ``longest`` words, text after text, and how many each text has."""
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    starts, ends, lengths = [], [], []
    for words in texts:
        before, after = running_crcs(words)
        starts += before
        ends += after
        lengths += map(len, words)
    before, after = np.array(starts, np.uint32), np.array(ends, np.uint32)
    # Places of words in the joined texts; texts follow each other, which cancels out within one.
    place = np.cumsum(np.array(lengths, np.int64) + 1)
    first = place - np.array(lengths, np.int64) - 1
    owner = np.repeat(np.arange(len(texts)), counts)
    stop = np.repeat(np.cumsum(counts), counts)
    found, of = [], []
    for n in range(1, longest + 1):
        at = np.flatnonzero(np.arange(len(owner)) + n <= stop)
        last = at + n - 1
        found.append((after[last] ^ shift(before[at], place[last] - 1 - first[at])) % np.uint32(buckets))
        of.append(owner[at])
    owners = np.concatenate(of)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order].astype(np.int32), np.bincount(owners, minlength=len(texts))


def features(docs: DataFrame, longest: int, buckets: int) -> DataFrame:
    """``doc_id, n_words, buckets`` for each row of ``doc_id, text``: one scan of each text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            held: list[list[bytes]] = []
            size = begin = 0
            for i in range(len(texts)):
                held.append(words_of(texts[i].as_py()))
                size += len(held[-1])
                if size >= LOT or i + 1 == len(texts):
                    values, counts = feature_buckets(held, longest, buckets)
                    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [ids[begin : i + 1], pa.array([len(w) for w in held], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                        names=["doc_id", "n_words", "buckets"],
                    )
                    held, size, begin = [], 0, i + 1

    return docs.mapInArrow(scan, "doc_id long, n_words long, buckets array<int>")


def bucket_counts(found: DataFrame, buckets: int) -> list[int]:
    """Features in each bucket: at most ``buckets`` rows come to the driver."""
    counts = [0] * buckets
    for row in found.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(source: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    held, wanted, size = sum(source), sum(target), len(source)
    return [
        math.floor(1000 * math.log((float(t + 1) * float(held + size)) / (float(s + 1) * float(wanted + size))))
        for s, t in zip(source, target)
    ]


def weigh(found: DataFrame, gains: list[int]) -> DataFrame:
    """``found`` with ``n_features`` and ``weight`` in place of its buckets."""
    held = found.sparkSession.sparkContext.broadcast(np.array(gains, np.int64))  # 8 bytes a bucket

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            counts = np.diff(lists.offsets.to_numpy())
            sums = np.concatenate([[0], np.cumsum(held.value[lists.flatten().to_numpy()])])
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts.astype(np.int64)), pa.array(sums[ends] - sums[ends - counts])],
                names=["doc_id", "row", "n_words", "n_features", "weight"],
            )

    return found.select("doc_id", "row", "n_words", "buckets").mapInArrow(
        add, "doc_id long, row long, n_words long, n_features long, weight long"
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document; ``rank`` is null unless drawn.

    Of the ``N`` documents with ``least_words`` words, ``floor(percent * N / 100)`` are drawn, best
    scores first, ties by id. Null and empty texts have no features and weight 0. Rows that repeat
    an id are rows of their own: they share the noise, and the order among equal scores is any.
    A missing id counts as an empty name and sorts first. An empty target gives every bucket the
    smoothed share; an empty table gives no rows. Long texts are read whole, one at a time.
    """
    ship(docs.sparkSession)
    numbered = features(inputs(docs, doc_id, text), longest, buckets).withColumn("row", F.monotonically_increasing_id())
    found = materialize(numbered, "features")
    wanted = features(target.select(F.lit(0).cast("long").alias("doc_id"), F.col(text).alias("text")), longest, buckets)
    gains = bucket_gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))

    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0))))
    scored = materialize(weigh(found, gains).withColumn("score", (F.col("weight") + noise).cast("long")), "scores")
    discard(found)

    eligible = scored.filter(F.col("n_words") >= least_words).withColumn("_falling", -F.col("score"))
    size = eligible.count() * percent // 100
    placed = running_sums(eligible, ["_falling", "doc_id", "row"], {"_before": F.lit(1)}, "ranked")
    rank = F.when(F.col("_before") < size, F.col("_before") + 1).cast("long").alias("rank")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    rest = scored.filter(F.col("n_words") < least_words)
    return placed.select(*columns, rank).unionByName(rest.select(*columns, F.lit(None).cast("long").alias("rank")))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# DuckDB has no CRC-32: the tests compare with a plain loop instead.
QUERIES = {"op11_resampling": (op11_resampling, None)}
