"""External induced sorting of the suffixes of one text, with common-prefix values.

Suffixes are sorted, and prefixes compared, by their first ``cap`` symbols
(ties beyond stay in any order). A text is an integer array whose last symbol,
0, occurs nowhere else. The steps, recursive:

1. The suffixes that start where the order of neighbouring symbols turns from
   falling to rising (S*) cut the text into overlapping pieces. The pieces are
   sorted by distribution and packed words, and named by their rank.
2. The string of names is sorted: by prefix doubling if it has at most ``base``
   symbols, else by this procedure. That orders the S* suffixes; common
   prefixes of names become common prefixes of symbols.
3. Two scans induce all others: rising symbols give every suffix that is larger
   than its successor, falling symbols the rest. A suffix at the front of the
   scan puts the suffix before it, a tuple of position and common prefix with
   the one put there last, into a priority queue. That value is one more than
   the least common prefix scanned in between.

Queues, seeds and results are ``Tape`` objects: blocks of tuples that a pool
moves to one scratch file of the task when it holds more than ``memory`` bytes;
texts, names and piece starts above that size are memory-mapped files. The
scratch is part of a running task, like Spark's own spill files: it has no name
in the file system, ends with the task, and a lost executor's task starts anew.
"""

from __future__ import annotations

import heapq
import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 16
MEMORY = 1 << 26
BASE = 1 << 22


def scratch(n: int, dtype, memory: int) -> np.ndarray:
    """An array of n zeros, in a scratch file if it is large."""
    if n * np.dtype(dtype).itemsize <= memory:
        return np.zeros(n, dtype)
    return np.memmap(tempfile.TemporaryFile(), dtype, "w+", shape=n)


class Pool:
    """Holds the blocks of some tapes, and writes the largest tape's to a scratch file when they exceed ``memory``."""

    def __init__(self, memory: int):
        self.memory, self.total, self.held, self.file, self.spilled = memory, 0, {}, None, 0

    def note(self, tape: Tape, size: int) -> None:
        self.held[tape] = self.held.get(tape, 0) + size
        self.total += size
        if not self.held[tape]:
            del self.held[tape]
        if size > 0:
            while self.total > self.memory:
                max(self.held, key=self.held.get).spill()

    def write(self, block: tuple) -> tuple:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        at = self.file.seek(0, 2)
        for column in block:
            self.file.write(np.ascontiguousarray(column).data)
            self.spilled += column.nbytes
        return at, len(block[0]), [c.dtype for c in block]

    def read(self, stored: tuple) -> tuple:
        at, n, kinds = stored
        self.file.seek(at)
        return tuple(np.frombuffer(self.file.read(n * k.itemsize), k) for k in kinds)


class Tape:
    """Tuples of one sequence, put at its end in blocks and taken from either end."""

    def __init__(self, pool: Pool):
        self.pool, self.blocks = pool, deque()

    def put(self, *block: np.ndarray) -> None:
        if len(block[0]):
            self.blocks.append(block)
            self.pool.note(self, sum(c.nbytes for c in block))

    def take(self, last: bool = False) -> tuple:
        block = self.blocks.pop() if last else self.blocks.popleft()
        if isinstance(block[0], int):
            return self.pool.read(block)
        self.pool.note(self, -sum(c.nbytes for c in block))
        return block

    def some(self) -> tuple:
        """Blocks from the front, together, up to about BLOCK tuples."""
        got, n = [], 0
        while self.blocks and n < BLOCK:
            got.append(self.take())
            n += len(got[-1][0])
        return got[0] if len(got) == 1 else tuple(np.concatenate(c) for c in zip(*got, strict=True))

    def spill(self) -> None:
        """All blocks go to the scratch file; those there already come first."""
        held = []
        while self.blocks and not isinstance(self.blocks[-1][0], int):
            held.append(self.blocks.pop())
        self.blocks.extend(self.pool.write(b) for b in reversed(held))
        self.pool.note(self, -sum(c.nbytes for b in held for c in b))


class Queue:
    """Priority queue of (symbol, position, common prefix): smallest symbol first (largest if ``down``), then first in, first out.

    Symbols share a tape in areas, at most 4,096; the area at the front is held symbol by symbol.
    """

    def __init__(self, pool: Pool, sigma: int, down: bool):
        self.pool, self.top, self.down = pool, sigma - 1, down
        self.shift = max(0, self.top.bit_length() - 12)
        self.tapes: dict[int, Tape] = {}
        self.first: dict[int, int] = {}
        self.areas: list[int] = []
        self.live: dict[int, Tape] = {}
        self.symbols: list[int] = []
        self.area = -1

    def put(self, symbol: np.ndarray, pos: np.ndarray, lcp: np.ndarray) -> None:
        key = self.top - symbol if self.down else symbol
        order = np.argsort(key, kind="stable")
        key, pos, lcp = key[order], pos[order], lcp[order]
        area = key >> self.shift if self.shift else key
        cuts = [0, *(np.flatnonzero(area[1:] != area[:-1]) + 1).tolist(), len(key)]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            a = int(area[s])
            if not self.shift:
                self._live(a, pos[s:e], lcp[s:e])
            elif a == self.area:
                self._split(key[s:e], pos[s:e], lcp[s:e])
            else:
                if a not in self.tapes:
                    self.tapes[a], self.first[a] = Tape(self.pool), int(key[s])
                    heapq.heappush(self.areas, a)
                self.first[a] = min(self.first[a], int(key[s]))
                self.tapes[a].put(pos[s:e], lcp[s:e], key[s:e])

    def _live(self, key: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        if key not in self.live:
            self.live[key] = Tape(self.pool)
            heapq.heappush(self.symbols, key)
        self.live[key].put(pos, lcp)

    def _split(self, key: np.ndarray, pos: np.ndarray, lcp: np.ndarray) -> None:
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            self._live(int(key[s]), pos[s:e], lcp[s:e])

    def front(self) -> int | None:
        """The symbol at the front."""
        keys = [*self.symbols[:1], *(self.first[a] for a in self.areas[:1])]
        return None if not keys else self.top - min(keys) if self.down else min(keys)

    def pop(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples of a symbol no larger than the front's, also those put meanwhile."""
        key = self.top - symbol if self.down else symbol
        if self.shift and self.area != key >> self.shift:
            self.area = key >> self.shift
            tape = self.tapes.pop(self.area, None)
            if tape is not None:
                heapq.heappop(self.areas)
                del self.first[self.area]
                blocks = []
                while tape.blocks:
                    blocks.append(tape.take())
                pos, lcp, keys = (np.concatenate(c) for c in zip(*blocks, strict=True))
                order = np.argsort(keys, kind="stable")
                self._split(keys[order], pos[order], lcp[order])
        begun = True
        while key in self.live and self.live[key].blocks:
            pos, lcp = self.live[key].some()
            if begun:  # the symbol before it differs
                lcp = lcp.copy()
                lcp[0], begun = 0, False
            yield pos, lcp
        if key in self.live:
            del self.live[key]
            heapq.heappop(self.symbols)


def range_least(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(x[low .. high]) for every pair, from minima over powers of two."""
    width = high - low + 1
    level = np.frexp(width.astype(np.float64))[1] - 1
    table = np.empty((int(level.max(initial=0)) + 1, len(x)), x.dtype)
    table[0] = x
    for k in range(1, len(table)):
        half, n = 1 << (k - 1), len(x) - (1 << k) + 1
        np.minimum(table[k - 1, :n], table[k - 1, half: half + n], out=table[k, :n])
    flat, base = table.ravel(), level * len(x)
    return np.minimum(flat[base + low], flat[base + high + 1 - (1 << level)])


class Scan:
    """One direction of induction: what is scanned puts its predecessors into the queue."""

    def __init__(self, text: np.ndarray, queue: Queue, sigma: int, cap: int):
        self.text, self.queue, self.cap = text, queue, cap
        self.since = np.zeros(sigma, np.int16)  # least common prefix since the symbol was put last, within one group
        self.seen: list[np.ndarray] = []

    def begin(self) -> None:
        """A group of another first symbol starts."""
        for s in self.seen:
            self.since[s] = 0
        self.seen = []

    def _passed(self, lcp: np.ndarray) -> None:
        least = lcp.min()
        for s in self.seen:
            self.since[s] = np.minimum(self.since[s], least)

    def push(self, pos: np.ndarray, lcp: np.ndarray, wanted) -> None:
        """Put the predecessors whose symbol is wanted; ``lcp`` is the common prefix with the one scanned before."""
        before = self.text[pos - 1]
        at = np.flatnonzero(wanted(before) & (pos > 0))
        if not len(at):
            self._passed(lcp)
            return
        symbol = before[at]
        order = np.argsort(symbol, kind="stable")
        a, s = at[order], symbol[order]
        same = np.zeros(len(a), bool)
        same[1:] = s[1:] == s[:-1]
        low = np.where(same, np.concatenate([a[:1], a[:-1]]) + 1, 0)
        value = range_least(lcp, low, a)
        first = ~same
        value[first] = np.minimum(value[first], self.since[s[first]])
        self._passed(lcp)
        end = np.ones(len(a), bool)
        end[:-1] = first[1:]
        rest = np.full(len(lcp) + 1, self.cap, np.int16)
        rest[:-1] = np.minimum.accumulate(lcp[::-1])[::-1]
        self.since[s[end]] = rest[a[end] + 1]
        self.seen.append(s[end])
        if len(self.seen) > 64:
            self.seen = [np.unique(np.concatenate(self.seen))]
        self.queue.put(s, pos[a].astype(pos.dtype) - 1, np.minimum(value + 1, self.cap).astype(np.int16))


def _run(text: np.ndarray, pos: int, cap: int) -> int:
    """Equal symbols from a position on."""
    part = np.asarray(text[pos: pos + cap])
    differ = part != part[0]
    first = int(differ.argmax())
    return first if differ[first] else len(part)


def star_starts(text: np.ndarray, memory: int, block: int = 1 << 20) -> np.ndarray:
    """Positions smaller than their successor and after a larger symbol; the last one is the end symbol's."""
    n, parts, rising, found = len(text), [], True, 0
    for e in range(n, 0, -block):
        s = max(0, e - block)
        here = np.asarray(text[s:e])
        after = np.append(here[1:], text[e] if e < n else here[-1])
        less, differ = here < after, here != after
        # Equal neighbours are of the same kind as the next that differ.
        place = np.where(differ, np.arange(e - s), e - s)
        nxt = np.minimum.accumulate(place[::-1])[::-1]
        rises = np.append(less, rising)[nxt]
        if e == n:
            rises[-1] = True
        prior = np.append(text[s - 1: s] if s else here[:1], here[:-1])
        parts.append(np.flatnonzero(rises & (prior > here)) + s)
        found += len(parts[-1])
        rising = bool(rises[0])
    out = scratch(found, np.int64, memory)
    for p in parts:
        out[found - len(p): found] = p
        found -= len(p)
    return out


def piece_names(text: np.ndarray, sigma: int, star: np.ndarray, pool: Pool, base: int) -> tuple[np.ndarray, int]:
    """Rank of each piece text[star[i] .. star[i + 1]] among all, from 0, and the number of ranks.

    If one piece begins another, the longer is smaller (it goes on falling where
    the other turns).
    """
    n, m = len(text), len(star)
    bits = sigma.bit_length()
    per = 63 // bits

    def length(i: np.ndarray) -> np.ndarray:
        return np.where(i + 1 < m, star[np.minimum(i + 1, m - 1)] - star[i] + 1, 1)

    def word(i: np.ndarray, size: np.ndarray, depth: int) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        begin = star[i] + depth
        for k in range(per):
            symbol = text[np.minimum(begin + k, n - 1)].astype(np.int64)
            out = out << bits | np.where(depth + k < size, symbol, sigma)
        return out

    names = scratch(m, np.int32, pool.memory)
    splits, tapes = np.zeros(0, np.int64), [Tape(pool)]
    if m > base:
        i = np.arange(0, m, max(1, m // (64 * (1 + m // base))))
        sample = np.sort(word(i, length(i), 0))
        splits = np.unique(sample[:: 64][1:])
        tapes = [Tape(pool) for _ in range(len(splits) + 1)]
    for s in range(0, m, 1 << 18):
        i = np.arange(s, min(m, s + (1 << 18)))
        w = word(i, length(i), 0)
        area = np.searchsorted(splits, w, "right")
        for a in np.unique(area):
            tapes[a].put(w[area == a], i[area == a])
    count = 0
    for tape in tapes:
        blocks = []
        while tape.blocks:
            blocks.append(tape.take())
        if not blocks:
            continue
        w, i = (np.concatenate(c) for c in zip(*blocks, strict=True))
        order = np.argsort(w, kind="stable")
        w, i = w[order], i[order]
        new = np.ones(len(i), bool)
        new[1:] = w[1:] != w[:-1]
        where, depth = np.arange(len(i)), per  # places not yet decided, group by group
        while True:
            begin = np.flatnonzero(new[where])
            size = np.diff(np.append(begin, len(where)))
            long = np.maximum.reduceat(length(i[where]), begin) > depth
            where = where[np.repeat((size > 1) & long, size)]
            if not len(where):
                break
            group, own = np.cumsum(new[where]), i[where]
            w = word(own, length(own), depth)
            order = np.lexsort((w, group))
            w, i[where] = w[order], own[order]
            change = np.zeros(len(where), bool)
            change[1:] = w[1:] != w[:-1]
            new[where] |= change
            depth += per
        names[i] = count + np.cumsum(new) - 1
        count += int(new.sum())
    return names, count


def doubled(names: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first ``cap`` symbols or more, and the common prefix with the one before; in memory."""
    n = len(names)
    start = np.cumsum(np.bincount(names)) - np.bincount(names)
    rank = start[names].astype(np.int32)
    levels, h = [rank], 1
    while h < cap:
        many = np.bincount(rank, minlength=n)
        own = np.flatnonzero(many[rank] > 1)
        if not len(own):
            break
        key = rank[own].astype(np.int64) << 32 | rank[np.minimum(own + h, n - 1)]
        order = np.argsort(key, kind="stable")
        own, key = own[order], key[order]
        at, group = np.arange(len(own)), key >> 32
        change = np.ones(len(own), bool)
        change[1:] = key[1:] != key[:-1]
        head = np.ones(len(own), bool)
        head[1:] = group[1:] != group[:-1]
        offset = np.maximum.accumulate(np.where(change, at, 0)) - np.maximum.accumulate(np.where(head, at, 0))
        rank = rank.copy()
        rank[own] = group + offset
        levels.append(rank)
        h *= 2
    order = np.argsort(rank, kind="stable")
    i, j = order[1:].copy(), order[:-1].copy()
    common = np.zeros(n, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        equal = levels[k][np.minimum(i, n - 1)] == levels[k][np.minimum(j, n - 1)]
        equal &= common[1:] < cap
        step = equal.astype(np.int64) << k
        common[1:] += step
        i += step
        j += step
    return order, np.minimum(common, cap)


def _star_order(text: np.ndarray, sigma: int, cap: int, pool: Pool, base: int) -> Tape:
    """The S* suffixes in order: position, and common prefix with the one before."""
    star = star_starts(text, pool.memory)
    names, count = piece_names(text, sigma, star, pool, base)
    within = (cap + 1) // 2 + 1  # a piece adds two symbols at least

    def ordered() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(names) <= base or count == 1:
            order, common = doubled(np.asarray(names), within)
            for s in range(0, len(order), BLOCK):
                yield order[s: s + BLOCK], common[s: s + BLOCK]
            return
        down = suffixes(names, count, within, pool, base)
        yield np.array([len(names) - 1]), np.zeros(1, np.int64)  # the end symbol
        carry = 0
        while down.blocks:
            pos, common = down.take(last=True)
            pos, common = pos[::-1].astype(np.int64), common[::-1].astype(np.int64)
            # What goes with the next larger belongs to that one here.
            yield pos, np.append(carry, common[:-1])
            carry = common[-1]

    out, before = Tape(pool), None
    for i, common in ordered():
        other = np.append(i[:1] if before is None else before, i[:-1])
        before = i[-1]
        pos, prior = star[i], star[other]
        lcp = np.minimum(star[np.minimum(i + common, len(star) - 1)] - pos, cap)
        lcp[common >= within] = cap
        active = np.flatnonzero((lcp < cap) & (pos != prior))
        while len(active):
            active = active[text[pos[active] + lcp[active]] == text[prior[active] + lcp[active]]]
            lcp[active] += 1
            active = active[lcp[active] < cap]
        lcp[pos == prior] = 0
        out.put(pos, lcp.astype(np.int16))
    return out


def suffixes(text: np.ndarray, sigma: int, cap: int, pool: Pool, base: int = BASE) -> Tape:
    """All suffixes but the end symbol's, largest first: position, and common prefix with the one scanned before (the next larger)."""
    seeds = _star_order(text, sigma, cap, pool, base)
    queue = Queue(pool, sigma, False)
    scan = Scan(text, queue, sigma, cap)
    larger, groups = Tape(pool), []  # suffixes larger than their successor; blocks of each first symbol
    held = seeds.take()
    while held is not None or queue.front() is not None:
        front = queue.front()
        seed = int(text[held[0][0]]) if held is not None else None
        c = min(x for x in (front, seed) if x is not None)
        scan.begin()
        last = None
        if front == c:
            blocks = len(larger.blocks)
            for pos, lcp in queue.pop(c):
                larger.put(pos, lcp)
                scan.push(pos, lcp, lambda s, c=c: s >= c)
                last = int(pos[-1])
            groups.append((c, len(larger.blocks) - blocks))
        while held is not None:
            pos, lcp = held
            n = int(np.searchsorted(text[pos], c, "right"))
            if not n:
                break
            part, common = pos[:n], lcp[:n]
            if last is not None:
                common = common.copy()
                common[0] = min(_run(text, last, cap), _run(text, int(part[0]), cap))
                last = None
            scan.push(part, common, lambda s, c=c: s > c)
            held = (pos[n:], lcp[n:]) if n < len(pos) else seeds.take() if seeds.blocks else None
    queue = Queue(pool, sigma, True)
    scan = Scan(text, queue, sigma, cap)
    out = Tape(pool)
    while groups or queue.front() is not None:
        front = queue.front()
        c = max(x for x in (front, groups[-1][0] if groups else None) if x is not None)
        scan.begin()
        last = None
        if front == c:
            for pos, lcp in queue.pop(c):
                out.put(pos, lcp)
                scan.push(pos, lcp, lambda s, c=c: s <= c)
                last = int(pos[-1])
        if groups and groups[-1][0] == c:
            carry = None
            for _ in range(groups.pop()[1]):
                pos, lcp = larger.take(last=True)
                pos, up = pos[::-1], lcp[::-1]
                if carry is None:
                    carry = 0 if last is None else min(_run(text, last, cap), _run(text, int(pos[0]), cap))
                lcp, carry = np.append(np.int16(carry), up[:-1]), up[-1]
                out.put(pos, lcp)
                scan.push(pos, lcp, lambda s, c=c: s < c)
    return out
