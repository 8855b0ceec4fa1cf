"""Vectorised word handling on Arrow text buffers, shared by the operators.

Texts are processed inside ``mapInArrow`` in slices of a bounded number of
bytes (a single longer text makes a slice of its own), directly on their
UTF-8 bytes: all separators used here are ASCII, so byte classes are exact.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

# Words of op8: everything but space and \x09-\x0D.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[9, 10, 11, 12, 13, 32]] = False

# Words of op9: digits, a-z (after lower-casing A-Z) and everything above ASCII.
LOWER_ALNUM = np.zeros(256, bool)
LOWER_ALNUM[0x30:0x3A] = True
LOWER_ALNUM[0x61:0x7B] = True
LOWER_ALNUM[0x80:] = True

# A-Z to a-z, byte by byte.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[0x41:0x5B] += 32

_MULT = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (base is odd)."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)

        def table(b: int) -> np.ndarray:
            out = np.full(size, b, np.uint64)
            out[0] = 1
            with np.errstate(over="ignore"):
                return np.cumprod(out, dtype=np.uint64)

        have = (table(base), table(inverse))
        if n <= 4 * SLICE_BYTES:  # tables for a single huge text are not kept
            _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift multiply)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """64-bit hash of values[s:e] for every range, by one prefix sum."""
    power, inverse = _power_tables(base, len(values) + 1)
    with np.errstate(over="ignore"):
        c = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[: len(values)], out=c[1:])
        return mix((c[ends] - c[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _MULT)


class Words:
    """The words of some texts: byte ranges, and the first word of each text."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        self.buf, self.offsets = buf, offsets
        n = len(buf)
        inside = kind[buf]
        starts, ends = inside.copy(), inside.copy()
        if n:
            before = np.zeros(n, bool)
            before[1:] = inside[:-1]
            cut = offsets[(offsets > 0) & (offsets < n)]
            before[cut] = False
            starts &= ~before
            after = np.zeros(n, bool)
            after[:-1] = inside[1:]
            after[cut - 1] = False
            ends &= ~after
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        return range_hash(self.buf, self.starts, self.ends, 0x2545F4914F6CDD1D)


def ngram_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the word sequences hashes[s:e]."""
    return range_hash(hashes, starts, ends, int(_STEP))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and text offsets of a string array (null counts as empty)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset: texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds at most ``limit`` text bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total, begin = np.cumsum(size), 0
        while begin < batch.num_rows:
            base = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, base + limit, "right")))
            yield batch.slice(begin, end - begin)
            begin = end
    give_back()


def give_back() -> None:
    """Return freed memory to the system: an idle worker process keeps none of its last task's."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
