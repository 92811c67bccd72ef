"""Token ids in segments of raw payload, each with a minimal perfect hash index over its documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spark_env import scratch_path
from .common import inputs, running_sums, ship, table
from .tokens import encoder, in_lots, public_tokenizer

SEGMENT_IDS = 1_000_000
SEGMENT_DOCS = 10_000
MAX_KEYS = 100_000
_GAMMA = 2
_MISSING = 0x5BD1E9955BD1E995

SCHEMA = (
    "segment int, first_key long, last_key long, n_ids long, width int, "
    "keys binary, missing binary, levels binary, fingerprints binary, offsets binary, lengths binary, payload binary"
)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose outputs look random (the splitmix finalizer)."""
    x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_keys(keys: np.ndarray, missing: np.ndarray) -> np.ndarray:
    """A number for each row: its key, and which of the equal keys before it in order it is."""
    order = np.lexsort((keys, missing))
    k, m = keys[order], missing[order]
    new = np.r_[True, (k[1:] != k[:-1]) | (m[1:] != m[:-1])] if len(k) else np.zeros(0, bool)
    at = np.arange(len(k))
    nth = np.empty(len(k), np.int64)
    nth[order] = at - np.maximum.accumulate(np.where(new, at, 0)) if len(k) else at
    return numbered(keys, missing, nth)


def numbered(keys: np.ndarray, missing: np.ndarray, nth: np.ndarray) -> np.ndarray:
    base = np.where(missing, np.uint64(_MISSING), keys.astype(np.int64).view(np.uint64))
    again = nth.astype(np.uint64) + missing.astype(np.uint64) * np.uint64(2**40)
    return mix(base + mix(again, 5) * (again > 0).astype(np.uint64), 1)


class PerfectHash:
    """Levels of bits: a key lies in the first level where no other key fell on its bit.

    Its slot is the number of set bits before it, so ``n`` keys get the slots 0 to ``n - 1``.
    Keys that were never added get some slot or none; stored fingerprints tell them apart.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.rank, base = [], 0
        for bits in levels:
            counts = np.cumsum(bits, dtype=np.int64)
            self.rank.append(base + counts - bits)
            base += int(counts[-1])

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            if len(levels) == 64:
                raise ValueError("two keys have the same hash")
            size = max(64, _GAMMA * len(left))
            places = (mix(left, len(levels) + 2) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(places, minlength=size) == 1
            levels.append(alone.astype(np.uint8))
            left = left[~alone[places]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for a key that is on no level."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for i, bits in enumerate(self.levels):
            places = (mix(keys[left], i + 2) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[places] == 1
            out[left[hit]] = self.rank[i][places[hit]]
            left = left[~hit]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<u4").tobytes()
        return sizes + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        count = int(np.frombuffer(data, "<u4", 1)[0])
        sizes, at, levels = np.frombuffer(data, "<u4", count, 4), 4 + 4 * count, []
        for size in map(int, sizes):
            length = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, length, at))[:size])
            at += length
        return cls(levels)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 99) >> np.uint64(32)).astype("<u4")


def segment_row(docs: list[tuple[int | None, np.ndarray]], number: int) -> tuple:
    """One stored row: raw ids of the documents in order, and where each key's ids are."""
    keys = np.array([d or 0 for d, _ in docs], np.int64)
    missing = np.array([d is None for d, _ in docs])
    lengths = np.array([len(t) for _, t in docs], np.int64)
    offsets = np.cumsum(lengths) - lengths
    hashed = hashed_keys(keys, missing)
    index = PerfectHash.of(hashed)
    slot = index.slots(hashed)
    prints, at, size = (np.zeros(len(docs), "<u4") for _ in range(3))
    prints[slot], at[slot], size[slot] = fingerprints(hashed), offsets, lengths
    known = keys[~missing]
    ends = (int(known.min()), int(known.max())) if len(known) else (None, None)
    payload = b"".join(t.tobytes() for _, t in docs)
    return (
        number, *ends, int(lengths.sum()), docs[0][1].dtype.itemsize, keys.astype("<i8").tobytes(), np.packbits(missing).tobytes(),
        index.dump(), prints.tobytes(), at.tobytes(), size.tobytes(), payload,
    )


class Segment:
    """A stored row, opened for keyed access."""

    def __init__(self, row: dict):
        self.keys = np.frombuffer(row["keys"], "<i8")
        self.missing = np.unpackbits(np.frombuffer(row["missing"], np.uint8))[: len(self.keys)].astype(bool)
        self.index = PerfectHash.load(row["levels"])
        self.prints, self.at, self.size = (np.frombuffer(row[c], "<u4") for c in ("fingerprints", "offsets", "lengths"))
        self.ids = np.frombuffer(row["payload"], f"<u{row['width']}")

    def find(self, hashed: np.ndarray) -> np.ndarray:
        """Slots of the keys, -1 where the fingerprint says that the key is not here."""
        slots = self.index.slots(hashed)
        here = slots >= 0
        here[here] = self.prints[slots[here]] == fingerprints(hashed[here])
        return np.where(here, slots, -1)

    def tokens(self, slot: int) -> np.ndarray:
        start = int(self.at[slot])
        return self.ids[start : start + int(self.size[slot])]


def write_index(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of all documents at ``path``, in ascending order of their ids.

    Each task takes a range of ids, encodes whole texts and cuts segments of about a million ids.
    The files are Parquet, one binary payload a row, so any store that Spark writes to will do.
    A missing text is an empty one, a missing id sorts first; rows that repeat an id follow each
    other and are told apart by their number.
    """
    ship(docs.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, open_docs, held, number = encoder(tokenizer), [], 0, 0
        kinds = pa.schema([(n, _ARROW[t]) for n, t in (c.split() for c in SCHEMA.split(", "))])

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(segment_row(open_docs, number), kinds)], schema=kinds)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in in_lots(texts):
                for doc, tokens in zip(ids[a:b], encode.texts(texts[a:b].to_pylist())):
                    # Equal ids stay in one segment's numbering unless they alone would fill it.
                    if held >= SEGMENT_IDS or len(open_docs) >= SEGMENT_DOCS:
                        yield row()
                        open_docs, held, number = [], 0, number + 1
                    open_docs.append((doc, tokens))
                    held += len(tokens)
        if open_docs:
            yield row()

    ordered = inputs(docs, doc_id, text).repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    written = ordered.mapInArrow(build, SCHEMA).withColumn("part", F.spark_partition_id())
    written.write.parquet(path)


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, each read through the index."""
    ship(spark)
    stored = spark.read.parquet(path)

    def open_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row)
                slots = segment.find(hashed_keys(segment.keys, segment.missing))
                if (slots < 0).any():
                    raise ValueError("a stored key is not in its index")
                crcs = [zlib.crc32(segment.tokens(s).astype("<u4").tobytes()) for s in slots]
                columns = [
                    pa.array([row["part"]] * len(slots), pa.int32()), pa.array([row["segment"]] * len(slots), pa.int32()),
                    pa.array(segment.keys, pa.int64(), mask=segment.missing), pa.array(segment.at[slots].astype(np.int64)),
                    pa.array(segment.size[slots].astype(np.int64)), pa.array(crcs, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "segment", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = stored.mapInArrow(open_all, "part int, segment int, doc_id long, at long, n_tokens long, ids_crc32 long")
    starts = running_sums(stored.select("part", "segment", "n_ids"), ["part", "segment"], {"before": F.col("n_ids")}, "segments")
    joined = rows.join(starts.select("part", "segment", "before"), ["part", "segment"])
    return joined.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def find_documents(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """``doc_id, ids`` of the first row of each wanted id that is stored. For up to ``MAX_KEYS``
    ids; more are better served by ``read_documents`` and a join."""
    if len(keys) > MAX_KEYS:
        raise ValueError(f"more than {MAX_KEYS} keys")
    ship(spark)
    wanted = np.array(sorted(set(keys)), np.int64)
    stored = spark.read.parquet(path)
    if len(wanted):
        stored = stored.filter((F.col("first_key") <= int(wanted[-1])) & (F.col("last_key") >= int(wanted[0])))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = wanted[(wanted >= row["first_key"]) & (wanted <= row["last_key"])]
                segment = Segment(row)
                slots = segment.find(numbered(own, np.zeros(len(own), bool), np.zeros(len(own), np.int64)))
                found = slots >= 0
                ids = [segment.tokens(s).astype(np.int64) for s in slots[found]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[found]), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"]
                )

    return stored.mapInArrow(search, "doc_id long, ids array<long>").dropDuplicates(["doc_id"])


def op5_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-index")
    write_index(table(spark, sf_dir, "documents"), path, public_tokenizer())
    return read_documents(spark, path)


QUERIES = {"op5_token_index": (op5_token_index, None)}
