"""Sets of word shingles as sorted arrays of 63-bit hashes, computed in tasks with numpy."""

from __future__ import annotations

import numpy as np

from .token_index import mix

_LOW = np.uint64(2**63 - 1)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Distinct ``words``-word shingles of the text in lower case (A-Z only), sorted by hash.

    A text with fewer words is one shingle; one without words has none. Words end at ASCII white
    space, which is what splitting and lowering bytes does.
    """
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return np.zeros(0, np.int64)
    hashed = word_hashes(parts)
    count = max(len(parts) - words + 1, 1)
    width = min(words, len(parts))
    out = np.full(count, width, np.uint64)
    for i in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashed[i : i + count], 3)
    return np.unique((out & _LOW).astype(np.int64))


def word_hashes(parts: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, from two polynomials over its bytes."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join(parts), np.uint8)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    values = mix(data.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8)), 17)
    return mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64), 23)
