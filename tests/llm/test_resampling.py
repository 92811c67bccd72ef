"""Importance resampling against a plain loop over words."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from commentlens.llm import crc, resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, row string, buckets int, rank string, score string"


def _table(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 0, "clash", "clash") for i, t in rows], SCHEMA)


def _features(text, longest, buckets):
    words = WORD.findall((text or "").translate(LOW))
    grams = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]


def _drawn(docs, target, longest, buckets, percent, least, seed):
    found = [(i, *_features(t, longest, buckets)) for i, t in docs]
    held = Counter(b for _, _, f in found for b in f)
    wanted = Counter(b for t in target for b in _features(t, longest, buckets)[1])
    S, T = sum(held.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (S + buckets) / ((held[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for i, words, f in found:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    ready = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], -math.inf if r[0] is None else r[0]))
    for rank, r in enumerate(ready[: percent * len(ready) // 100]):
        r[5] = rank + 1
    return sorted(map(tuple, out), key=str)


DOCS = [
    *((i, f"Shared words of document {i} " + " ".join(f"w{(i * 7 + j) % 31}" for j in range(i % 40))) for i in range(120)),
    (200, None), (201, ""), (202, " \n\t?!"), (203, "Straße 日本語 ÀÉ çà \U0001f600 a1B2 x_y"), (204, "long " * 40_000), (205, "w1 w2"),
    (5, "The same id with other words, and enough of them to be drawn: " + "good words " * 9), (None, "no id but words " * 8),
]
TARGET = ["good words are shared", "w1 w2 w3 W4", None, "", "Straße good"]


@pytest.mark.parametrize("longest,buckets,percent", [(1, 10_000, 10), (3, 50, 35), (2, 1, 100), (1, 7, 0)])
def test_resampling(spark, longest, buckets, percent):
    # Repeated rows share everything but the place, which may be either's.
    target = _table(spark, list(enumerate(TARGET)))
    got = resampling.resample(_table(spark, DOCS), target, longest, buckets, percent, 20, "s").collect()
    assert sorted((tuple(r) for r in got), key=str) == _drawn(DOCS, TARGET, longest, buckets, percent, 20, "s")


def test_resampling_empty_tables(spark):
    none = _table(spark, [])
    assert resampling.resample(none, none).collect() == []
    got = resampling.resample(_table(spark, [(1, "some words"), (1, "some words")]), none, least_words=1, percent=100).collect()
    assert sorted(r["rank"] for r in got) == [1, 2] and len({(r.weight, r.score) for r in got}) == 1


def test_parts_from_running_crcs():
    rng = np.random.default_rng(1)
    for _ in range(50):
        words = [rng.bytes(int(rng.integers(1, 40))) for _ in range(12)]
        starts, ends = crc.running_crcs(words)
        for i, j in ((0, 0), (3, 3), (2, 9), (0, 11)):
            part = b" ".join(words[i : j + 1])
            moved = crc.shift(np.array([starts[i]], np.uint32), np.array([len(part)]))
            assert int(moved[0]) ^ ends[j] == zlib.crc32(part)
    long = rng.bytes(1_000_003)
    assert int(crc.shift(np.array([zlib.crc32(b"ab")], np.uint32), np.array([len(long)]))[0]) ^ zlib.crc32(long) == zlib.crc32(b"ab" + long)


def test_small_lots_change_nothing(spark, monkeypatch):
    texts = [resampling.words_of(t.encode() if t else None) for _, t in DOCS]
    whole = resampling.feature_buckets(texts, 2, 100)
    parts = [resampling.feature_buckets([t], 2, 100) for t in texts]
    assert whole[0].tolist() == [b for p in parts for b in p[0].tolist()]
    assert whole[1].tolist() == [int(p[1][0]) for p in parts]
