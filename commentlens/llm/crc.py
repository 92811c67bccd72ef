"""CRC-32 of any part of a byte string, from running CRCs over the whole string.

For bytes ``AB``, ``crc(AB) = shift(crc(A), len(B)) ^ crc(B)``, where ``shift`` appends zero bytes:
a linear map over GF(2). So ``crc(B)`` is the XOR of the running CRC at the end of ``B`` and the
shifted running CRC at its start; no byte of ``B`` is read again.
"""

from __future__ import annotations

from functools import lru_cache
from zlib import crc32

import numpy as np

POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, reflected


def _append_zero_byte(crc: int) -> int:
    for _ in range(8):
        crc = crc >> 1 ^ (POLYNOMIAL if crc & 1 else 0)
    return crc


@lru_cache(maxsize=None)
def _tables(power: int) -> np.ndarray:
    """The map that appends ``2**power`` zero bytes, as one table for each byte of a CRC."""
    if power:
        half = _tables(power - 1)
        images = _apply(half, _apply(half, np.uint32(1) << np.arange(32, dtype=np.uint32)))
    else:
        images = np.array([_append_zero_byte(1 << i) for i in range(32)], np.uint32)
    values = np.arange(256)
    out = np.zeros((4, 256), np.uint32)
    for bit in range(32):
        out[bit // 8] ^= np.where(values >> bit % 8 & 1, images[bit], np.uint32(0))
    return out


def _apply(tables: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    out = tables[0][crcs & 255]
    for i in (1, 2, 3):
        out ^= tables[i][crcs >> np.uint32(8 * i) & 255]
    return out


def shift(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC after ``lengths`` zero bytes more."""
    out = crcs.astype(np.uint32)
    for power in range(int(lengths.max(initial=0)).bit_length()):
        at = np.flatnonzero(lengths >> power & 1)
        out[at] = _apply(_tables(power), out[at])
    return out


def running_crcs(words: list[bytes]) -> tuple[list[int], list[int]]:
    """One scan over ``words`` joined by single spaces: the CRC before and after each word."""
    starts, ends, crc = [], [], 0
    for word in words:
        starts.append(crc)
        crc = crc32(word, crc)
        ends.append(crc)
        crc = crc32(b" ", crc)
    return starts, ends
