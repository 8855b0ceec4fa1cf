"""Byte-pair merging with a heap of candidate pairs over a linked list of symbols."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

UNRANKED = float("inf")


def merge(symbols: list, rank: dict) -> list:
    """Merge adjacent symbols, lowest rank first (leftmost among equals), until no pair has a rank.

    ``symbols`` are str or bytes; ``rank`` gives the rank of a merged symbol.
    O(n log n): each merge pops one heap entry and pushes at most two; an entry
    whose symbols have changed since is stale and skipped.
    """
    n = len(symbols)
    symbol, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    get = rank.get
    heap = []
    for i in range(n - 1):
        pair = symbol[i] + symbol[i + 1]
        r = get(pair)
        if r is not None:
            heap.append((r, i, pair))
    heapify(heap)
    while heap:
        _, i, pair = heappop(heap)
        j = after[i]
        if symbol[i] is None or j >= n or symbol[i] + symbol[j] != pair:
            continue
        symbol[i], symbol[j] = pair, None
        k = after[i] = after[j]
        h = before[i]
        if h >= 0:
            grown = symbol[h] + pair
            r = get(grown)
            if r is not None:
                heappush(heap, (r, h, grown))
        if k < n:
            before[k] = i
            grown = pair + symbol[k]
            r = get(grown)
            if r is not None:
                heappush(heap, (r, i, grown))
    return [s for s in symbol if s is not None]


def merge_short(symbols: list, rank: dict) -> list:
    """As :func:`merge`, by a scan for the lowest rank before each merge: faster for few symbols, O(n^2) for many."""
    symbol, get = list(symbols), rank.get
    ranks = [get(a + b, UNRANKED) for a, b in zip(symbol, symbol[1:])]
    while ranks:
        lowest = min(ranks)
        if lowest == UNRANKED:
            break
        i = ranks.index(lowest)
        symbol[i] += symbol.pop(i + 1)
        del ranks[i]
        if i:
            ranks[i - 1] = get(symbol[i - 1] + symbol[i], UNRANKED)
        if i < len(ranks):
            ranks[i] = get(symbol[i] + symbol[i + 1], UNRANKED)
    return symbol


class Memo(dict):
    """A dictionary that computes missing values.

    When it is full its values become the older generation, and the one before
    is forgotten: at most ``2 * limit`` values are held, and one that is asked
    for again in time is not computed again.
    """

    def __init__(self, compute, limit: int = 200_000, longest: int = 48):
        super().__init__()
        self.compute, self.limit, self.longest, self.older = compute, limit, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value
