"""Sets of 64-bit keys as bitmaps of a fixed number of bits, small enough to broadcast.

A marked key is found for certain; an unmarked one may be found too, ever more
often as the set outgrows the bitmap. Users only save work with it and must
not need the answer to be exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

CHUNK_BITS = 1 << 15


def slot_of(key: Column, bits: int) -> Column:
    return key.bitwiseAND(bits - 1)


def bitmap(keys: DataFrame, bits: int, key: str = "key") -> bytes:
    """``bits`` (a power of two) bits with the low bits of every key set."""
    slot = slot_of(F.col(key), bits)
    chunks = keys.groupBy(F.shiftright(slot, 15).alias("chunk")).agg(F.bitmap_construct_agg(slot.bitwiseAND(CHUNK_BITS - 1)).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in chunks.collect():  # at most bits / 2**15 rows of 4 KB, in one job
        out[r.chunk * CHUNK_BITS // 8: (r.chunk + 1) * CHUNK_BITS // 8] = np.frombuffer(bytes(r.bits), np.uint8)
    return out.tobytes()


def marked(bits: bytes, keys: np.ndarray) -> np.ndarray:
    """Which keys (uint64) are marked."""
    table = np.frombuffer(bits, np.uint8)
    slot = keys & np.uint64(8 * len(table) - 1)
    return (table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
