"""Periodic runs of words, found by block convolution.

A run is a stretch of consecutive words with smallest period q whose length is
at least ``max(least, 3 * q)`` and that no neighbouring word extends with that
period. At each dyadic scale B a document is cut into blocks of B words. The
exact integer number-theoretic transform correlates every block with the 3 B
words that follow its start; a shift d whose sum of squared differences is zero
is an occurrence of the block d words on. Scale 8 answers shifts 1 to 16, scale
B > 8 shifts B + 1 to 2 B: a run of period q has ``length - q >= 2 * q`` words
that recur q words on, so one aligned block of its scale lies among them. The
distances seed extensions, which compare words themselves; so a sum that is
zero only modulo the prime never becomes a run, and no run is lost.

Work is saved exactly: a block is transformed only if each of its words recurs
within 2 B words, and not if it and its window lie in a run already found (all
its matches are multiples of that run's period).

Scale: narrow, one pass, no shuffle. Words are numbered text by text in pieces
of ``PIECE`` bytes, so a long text costs a few bytes per word besides itself;
transforms are done for at most ``CELLS`` cells at a time, or one block.

Edge cases: a null or empty text has no words and no runs; repeated rows and
null ids give one row each; of equal stretches only the smallest period counts;
runs that overlap are all returned, by start, then period; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import io
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from examlytics.llm.text import slices

LEAST = 24
FIRST_BLOCK = 8
PIECE = 1 << 20
CELLS = 1 << 21

PRIME = 998244353  # 119 * 2**23 + 1
ROOT = 3

SPACE = re.compile(rb"[\x20\x09-\x0d]")


def pieces(raw: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, some at a time; a piece ends at white space."""
    at = 0
    while at < len(raw):
        end = len(raw)
        if at + size < end:
            space = SPACE.search(raw, at + size)
            end = space.start() if space else end
        yield raw[at:end].split()
        at = end


def numbered(raw: bytes) -> tuple[np.ndarray, list[bytes]]:
    """A text's words as numbers from 0 in order of first sight, and the word of each number."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    parts = [np.fromiter(map(number.__getitem__, words), np.int32, len(words)) for words in pieces(raw)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int32), list(number)


def _roots(half: int, inverse: bool) -> np.ndarray:
    """Powers 0 .. half - 1 of a root of unity of order 2 * half."""
    step = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
    if inverse:
        step = pow(step, -1, PRIME)
    out = np.ones(1, np.uint64)
    while len(out) < half:
        out = np.concatenate([out, out * np.uint64(pow(step, len(out), PRIME)) % PRIME])
    return out[:half]


def transform(a: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row, in bit-reversed order."""
    rows, n = a.shape
    half = n // 2
    while half:
        a = a.reshape(rows, -1, 2, half)
        low, high = a[:, :, 0], a[:, :, 1]
        a = np.stack([(low + high) % PRIME, (low + PRIME - high) * _roots(half, False) % PRIME], 2)
        half //= 2
    return a.reshape(rows, n)


def restore(a: np.ndarray) -> np.ndarray:
    """Inverse of ``transform``."""
    rows, n = a.shape
    half = 1
    while half < n:
        a = a.reshape(rows, -1, 2, half)
        low, high = a[:, :, 0], a[:, :, 1] * _roots(half, True) % PRIME
        a = np.stack([(low + high) % PRIME, (low + PRIME - high) % PRIME], 2)
        half *= 2
    return a.reshape(rows, n) * np.uint64(pow(n, -1, PRIME)) % PRIME


def squared_differences(x: np.ndarray, starts: np.ndarray, block: int) -> np.ndarray:
    """Row per block, column per shift 0 .. 2 * block: sum of squared differences modulo PRIME.

    Words beyond the end of ``x`` count as 0.
    """
    at = starts[:, None] + np.arange(3 * block)
    window = np.where(at < len(x), x[np.minimum(at, len(x) - 1)], 0).astype(np.uint64) % PRIME
    a = np.zeros((len(starts), 4 * block), np.uint64)
    b = np.zeros_like(a)
    a[:, :block] = window[:, block - 1::-1] if block > 1 else window[:, :1]
    b[:, : 3 * block] = window
    product = restore(transform(a) * transform(b) % PRIME)[:, block - 1: 3 * block]
    square = np.zeros((len(starts), 3 * block + 1), np.uint64)
    np.cumsum(window * window % PRIME, axis=1, out=square[:, 1:])
    sums = (square[:, block:] - square[:, : 2 * block + 1]) % PRIME
    return (sums[:, :1] + sums + 2 * (PRIME - product)) % PRIME


def _recurrence(x: np.ndarray) -> np.ndarray:
    """Distance from each word to its next occurrence (the length of ``x`` where there is none)."""
    order = np.argsort(x, kind="stable")
    out = np.full(len(x), len(x), np.int64)
    same = x[order[1:]] == x[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def _agree(x: np.ndarray, i: int, j: int, step: int) -> int:
    """How far x[i], x[i + step], ... equals x[j], x[j + step], ... (i < j, step 1 or -1)."""
    most, have, size = (len(x) - j if step > 0 else i + 1), 0, 32
    while have < most:
        m = min(size, most - have)
        if step > 0:
            differ = x[i + have: i + have + m] != x[j + have: j + have + m]
        else:
            differ = (x[i - have - m + 1: i - have + 1] != x[j - have - m + 1: j - have + 1])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return have + first
        have, size = have + m, min(2 * size, 1 << 16)
    return most


def runs(x: np.ndarray, longest: int | None = None, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in the numbers ``x``, by start, then period.

    ``x`` may hold several texts one after another if they share no number;
    ``longest`` is then the length of the longest.
    """
    x = x + 1  # 0 is the filling
    n, longest = len(x), len(x) if longest is None else longest
    found: dict[tuple[int, int], int] = {}
    if longest < least:
        return []
    recurs = _recurrence(x)
    cover_end, cover_period = np.zeros(n, np.int64), np.ones(n, np.int64)
    block = FIRST_BLOCK
    while block == FIRST_BLOCK or 3 * (block + 1) <= longest:
        lowest = 1 if block == FIRST_BLOCK else block + 1
        count = n // block
        starts = np.flatnonzero((recurs[: count * block] <= 2 * block).reshape(count, block).all(1)) * block
        starts = starts[cover_end[starts] < np.minimum(starts + 3 * block, n)]
        seeds = []
        some = max(1, CELLS // (4 * block))
        for k in range(0, len(starts), some):
            part = starts[k: k + some]
            row, shift = np.nonzero(squared_differences(x, part, block)[:, lowest:] == 0)
            pos, shift = part[row], shift + lowest
            own = pos + block + shift <= n
            own &= ~((cover_end[pos] >= pos + block + shift) & (shift % cover_period[pos] == 0))
            seeds.append(np.stack([shift[own], pos[own]], 1))
        new, done, last = [], 0, 0
        seeds = np.concatenate(seeds) if seeds else np.zeros((0, 2), np.int64)
        for d, pos in seeds[np.lexsort((seeds[:, 1], seeds[:, 0]))].tolist():
            if d == last and pos < done:
                continue  # in the stretch extended last
            right = _agree(x, pos, pos + d, 1)
            if right < block:
                continue
            left = _agree(x, pos - 1, pos + d - 1, -1) if pos else 0
            last, done = d, pos + right
            start, end = pos - left, pos + d + right
            if end - start >= max(least, 3 * d) and found.get((start, end), d + 1) > d:
                found[start, end] = d
                new.append((start, end))
        for start, end in new:
            longer = cover_end[start:end] < end
            cover_end[start:end][longer] = end
            cover_period[start:end][longer] = found[start, end]
        block *= 2
    return sorted((s, e - s, d) for (s, e), d in found.items())


def dropped(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words follow the first period of a run."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def _joined(numbers: np.ndarray, words: list[bytes]) -> bytes:
    out = io.BytesIO()
    for k in range(0, len(numbers), 1 << 16):
        out.write(b" " if k else b"")
        out.write(b" ".join(map(words.__getitem__, numbers[k: k + (1 << 16)].tolist())))
    return out.getvalue()


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def collapsed(docs: DataFrame, rewrite: Callable[[int | None, np.ndarray], np.ndarray] | None = None, least: int = LEAST) -> DataFrame:
    """Per document: doc_id, n_words, its runs, and the words left when each run keeps its first period, joined by one space.

    ``rewrite`` may give other word numbers for a document (from its id and its
    own numbers) before runs are looked for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            ids = b.column("doc_id").to_pylist()
            texts = []
            for doc_id, text in zip(ids, b.column("text").cast(pa.large_binary()).to_pylist(), strict=True):
                x, words = numbered(text or b"")
                texts.append((rewrite(doc_id, x) if rewrite else x, words))
            first = np.cumsum([0] + [len(x) for x, _ in texts])
            apart = np.cumsum([0] + [len(w) for _, w in texts])
            longest = max((len(x) for x, _ in texts), default=0)
            found = runs(np.concatenate([x + np.int64(k) for (x, _), k in zip(texts, apart, strict=False)]), longest, least)
            start, length, period = np.array(found, np.int64).reshape(-1, 3).T
            of = np.searchsorted(first, start, "right") - 1
            cut = np.searchsorted(of, np.arange(len(texts) + 1))
            start = start - first[of]
            kept = []
            for i, (x, words) in enumerate(texts):
                own = slice(cut[i], cut[i + 1])
                if cut[i] < cut[i + 1]:
                    x = x[~dropped(len(x), list(zip(start[own].tolist(), length[own].tolist(), period[own].tolist(), strict=True)))]
                kept.append(_joined(x, words))
            struct = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(RUN))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(np.diff(first), pa.int64()), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), struct),
                pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
