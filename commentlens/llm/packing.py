"""Packs tokenized documents into sequences: first-fit decreasing in randomised groups."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spark_env import materialize
from .common import inputs, ship, table
from .tokens import encoder, in_lots, public_tokenizer

LENGTH = 1024
# Documents of a group on average. A group is packed in one task: 4,000 rows of a few numbers.
GROUP = 4_000
SEED = 11


class FirstFit:
    """A tournament tree over bins: every node holds the most room below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.room = [capacity] * (2 * self.leaves)
        self.capacity = capacity

    def put(self, size: int) -> tuple[int, int]:
        """The first bin with room for ``size``, and where in it the item goes."""
        node, room = 1, self.room
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        place = self.capacity - room[node]
        room[node] -= size
        bin_no = node - self.leaves
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
        return bin_no, place


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """``bin, place`` of each item; ties go in the given order."""
    tree, out = FirstFit(len(sizes), capacity), [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        out[i] = tree.put(sizes[i])
    return out


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Documents cut at multiples of ``length``; only a document's last piece can be shorter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in in_lots(texts):
                rows: list[tuple] = []
                for doc, tokens in zip(ids[a:b], encode.texts(texts[a:b].to_pylist())):
                    wide = tokens.astype("<u4")
                    for s in range(0, len(wide), length):
                        piece = wide[s : s + length]
                        rows.append((doc, s, len(piece), zlib.crc32(piece.tobytes()), len(wide)))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=NAMES)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, group: int = GROUP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its ids and the end id. Full pieces are sequences of their own. The rest of
    each document joins a random group of about ``group`` documents, drawn by a hash of its row,
    and each group is packed first-fit decreasing by itself. A missing text is an empty one (its
    end id only), rows that repeat are packed as documents of their own, and an empty table gives
    no rows. ``sequence_id`` is the group and the bin; full pieces are numbered in their task.
    """
    ship(docs.sparkSession)
    cut = materialize(pieces(inputs(docs, doc_id, text), tokenizer, length), "pieces")
    full = cut.filter(F.col("length") == length).select(
        "*", (F.monotonically_increasing_id() + F.lit(2**61)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = cut.filter(F.col("length") < length)
    groups = max(1, -(-rest.count() // group))
    dealt = rest.withColumn("_group", F.pmod(F.xxhash64("doc_id", "ids_crc32", "doc_tokens", F.monotonically_increasing_id(), F.lit(SEED)), F.lit(groups)))

    def place(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("ids_crc32", "ascending"), ("doc_tokens", "ascending")])
        at = np.array(first_fit_decreasing(rows.column("length").to_pylist(), length), dtype=np.int64).reshape(-1, 2)
        own = rows.select(NAMES)
        own = own.append_column("sequence_id", pa.array((key[0].as_py() << 32) + at[:, 0]))
        return own.append_column("offset", pa.array(at[:, 1]))

    packed = dealt.groupBy("_group").applyInArrow(place, PIECES + ", sequence_id long, offset long")
    return full.unionByName(packed)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizer())


QUERIES = {"op2_packing": (op2_packing, None)}
