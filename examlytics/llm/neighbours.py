"""Approximate nearest neighbours by a block matrix product on int8 tiles, made exact.

Queries and candidates meet in a grid: a candidate has one column and is copied
to each row, a query has one row and is copied to each column, and one shuffle
by grid cell brings both together. In a cell the queries stay and the
candidates stream past, both packed into tiles of ``tile`` rows, quantised to
int8 with one scale per vector and the exact norm of its quantisation error.
The product of two tiles gives all distances of the quantised vectors at once;
the error norms bound the true distances from below. Only pairs whose lower
bound does not exceed the query's current k-th distance are recomputed on the
original vectors in double precision and merged into the k best of the query.
The bounds never exclude a true neighbour, so the result equals brute force.

Scale: the grid follows the numbers of queries and candidates. It has as many
rows as keep the queries of a cell and their k best in ``QUERY_BYTES``, and as
many columns as keep its candidates, which pass through the task in batches,
below ``CANDIDATE_ROWS``. Further columns only spread the work, while the
copies of the queries stay below a quarter of the candidates. No vector is broadcast
or passes through the driver. The last merge reads k rows per query and
column. The products grow with queries times candidates.

Edge cases: null or empty vectors, zero vectors and vectors with a null or
non-finite component take no part, neither do null ids; repeated rows of an id
count once (the smallest vector if they differ); vectors of different length
are never compared; with fewer candidates than k all are returned; ties go to
the smaller id; further columns are ignored. Of equal vectors in one tile only
the k + 1 with the smallest ids are compared, since no query can have others
among its k nearest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from examlytics.llm.store import keep

TILE = 2048
#: Rows of a query tile that are multiplied at once: their products stay in a core's cache.
STRIPE = 256
#: Candidates that all queries of a tile are compared with at once, until each has its k; pairs that are compared exactly at once.
FIRST = 64
PAIRS = 16_384
#: What the queries of a grid cell take in memory, and its candidates.
QUERY_BYTES = 128 << 20
CANDIDATE_ROWS = 524_288
#: Candidates for which another column is worth its copies of the queries.
COLUMN_ROWS = 1024
SLACK = 1e-9
QUERY, CANDIDATE = 0, 1


def valid_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, embedding): usable vectors, one row per id."""
    v = F.col("embedding")
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<float>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    rows = rows.filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def grid(queries: int, query_bytes: int, candidates: int, parallel: int) -> tuple[int, int]:
    """Rows and columns of the grid; ``parallel`` cells suffice to spread the work."""
    rows = max(1, -(-query_bytes // QUERY_BYTES))
    spread = min(-(-parallel // rows), candidates // COLUMN_ROWS + 1, rows * candidates // (4 * max(1, queries)) + 1)
    return rows, max(spread, -(-candidates // CANDIDATE_ROWS))


class _Tile:
    """Vectors of one length: originals, int8 codes, scales, squared norms of the codes and error norms."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        wide = vectors.astype(np.float64)
        self.scales = np.abs(wide).max(1) / 127
        self.codes = np.rint(wide / self.scales[:, None]).astype(np.int8)
        self.errors = np.sqrt(np.square(wide - self.scales[:, None] * self.codes).sum(1)) * (1 + SLACK)
        whole = self.codes.astype(np.int64)
        self.squares = (whole * whole).sum(1) * self.scales**2


def _candidates(ids: np.ndarray, vectors: np.ndarray, k: int) -> _Tile:
    """A tile by ascending id; of equal vectors it has the k + 1 with the smallest ids."""
    order = np.argsort(ids)
    ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
    like = np.argsort(vectors.view(np.dtype((np.void, vectors.itemsize * vectors.shape[1]))).ravel(), kind="stable")
    bits, at = vectors.view(np.uint32)[like], np.arange(len(like))
    first = np.maximum.accumulate(np.where((bits != np.roll(bits, 1, axis=0)).any(1), at, 0))
    pick = np.sort(like[at - first <= k])
    return _Tile(ids[pick], vectors[pick])


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of rows in double precision, summed in component order."""
    d = a.T.astype(np.float64) - b.T.astype(np.float64)
    d *= d
    total = d[0].copy()
    for x in d[1:]:
        total += x
    return np.sqrt(total)


def _within(q: _Tile, c: _Tile, reach: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, cols) of all pairs whose lower bound does not exceed the ``reach`` of the query, and few others.

    The bound is the distance of the codes less both errors, so a pair counts
    while (reach + q.error + c.error)**2 - |q|**2 - |c|**2 + 2 q.c >= 0: one
    product of the codes, with three more components for the other terms. Both
    sides are widened by what rounding can take from a sum of so many terms.
    """
    scales, errors, squares = c.scales[start:end], c.errors[start:end], c.squares[start:end]
    dim, sizes = q.codes.shape[1], np.concatenate([q.squares, squares, reach[reach > 0]**2])
    kind = np.float32 if 1e-30 < sizes.min() and sizes.max() < 1e30 and dim <= 4096 else np.float64
    rounding = (2 * dim + 32) * float(np.finfo(kind).eps)
    far = reach + q.errors
    left, right = far**2 - q.squares, errors**2 - squares
    left += rounding * (np.abs(left) + q.squares + far**2)
    right += rounding * (np.abs(right) + squares + errors**2)
    a = np.column_stack([q.scales[:, None] * q.codes, left, 2 * far, np.ones(len(far))]).astype(kind)
    b = np.column_stack([2 * scales[:, None] * c.codes[start:end], np.ones(len(right)), errors, right]).astype(kind).T
    product, found = np.empty((STRIPE, b.shape[1]), kind), []
    for s in range(0, len(a), STRIPE):
        part = a[s:s + STRIPE]
        bits = np.packbits(np.matmul(part, b, out=product[:len(part)]) >= 0)
        some = np.flatnonzero(bits)
        at, bit = np.nonzero(np.unpackbits(bits[some, None], axis=1))
        found.append(s * b.shape[1] + some[at] * 8 + bit)
    row, col = np.divmod(np.concatenate(found), b.shape[1])
    return row, col + start


class _Queries(_Tile):
    """A tile of queries and the k best (distance, id) of each, ascending; no candidate has distance inf."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        super().__init__(ids, vectors)
        self.seen = 0
        self.best, self.best_ids = np.full((len(ids), k), np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)

    def meet(self, c: _Tile) -> None:
        """Merge the candidates of a tile; all pairs are compared until each query has k of them."""
        start = 0
        while start < len(c.ids):
            # The fewer a query has seen, the sooner its k-th distance is looked at again.
            end = start + max(FIRST, 3 * self.seen)
            if np.isinf(self.best[:, -1]).any():
                end = start + FIRST
                cols = np.arange(start, min(end, len(c.ids)))
                self._compare(np.repeat(np.arange(len(self.ids)), len(cols)), np.tile(cols, len(self.ids)), c)
            else:
                self._compare(*_within(self, c, self.best[:, -1], start, end), c)
            self.seen += min(end, len(c.ids)) - start
            start = end

    def _compare(self, rows: np.ndarray, cols: np.ndarray, c: _Tile) -> None:
        for s in range(0, len(rows), PAIRS):
            row, col = rows[s:s + PAIRS], cols[s:s + PAIRS]
            other = self.ids[row] != c.ids[col]
            row, col = row[other], col[other]
            exact = np.concatenate([distance(self.vectors[row[i:i + 2048]], c.vectors[col[i:i + 2048]]) for i in range(0, len(row), 2048)] or [np.zeros(0)])
            near = exact <= self.best[row, -1]
            self._merge(row[near], exact[near], c.ids[col[near]])

    def _merge(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        k, (at, row) = self.best.shape[1], np.unique(row, return_inverse=True)
        row = np.concatenate([np.repeat(np.arange(len(at)), k), row])
        score, ids = np.concatenate([self.best[at].ravel(), score]), np.concatenate([self.best_ids[at].ravel(), ids])
        order = np.lexsort((ids, score, row))
        row = row[order]
        order = order[np.arange(len(row)) - np.searchsorted(row, row) < k]
        self.best[at], self.best_ids[at] = score[order].reshape(-1, k), ids[order].reshape(-1, k)


class _Cell:
    """One cell of the grid: its queries come first, then its candidates."""

    def __init__(self, key: list[int], tile: int, k: int):
        self.key, self.tile, self.k = key, tile, k
        self.side, self.waiting, self.queries = QUERY, [], []

    def add(self, side: int, ids: np.ndarray, vectors: np.ndarray) -> None:
        if side != self.side:
            self._pack(0)
            self.side = side
        self.waiting.append((ids, vectors))
        if sum(len(x[0]) for x in self.waiting) >= self.tile:
            self._pack(self.tile - 1)

    def _pack(self, rest: int) -> None:
        """Make tiles of what waits, until at most ``rest`` rows are left."""
        if not self.waiting:
            return
        ids, vectors = map(np.concatenate, zip(*self.waiting, strict=True))
        s = 0
        while len(ids) - s > rest:
            part = ids[s:s + self.tile], vectors[s:s + self.tile]
            if self.side == QUERY:
                self.queries.append(_Queries(*part, self.k))
            elif self.queries:
                c = _candidates(*part, self.k)
                for q in self.queries:
                    q.meet(c)
            s += self.tile
        self.waiting = [(ids[s:], vectors[s:])] if s < len(ids) else []

    def result(self) -> Iterator[pa.RecordBatch]:
        self._pack(0)
        for q in self.queries:
            found = np.isfinite(q.best)
            yield pa.RecordBatch.from_pydict({"query_id": np.repeat(q.ids, found.sum(1)), "vec_id": q.best_ids[found], "score": q.best[found]})


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, tile: int = TILE, columns: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows of every row that ``is_query`` (on vec_id) picks."""
    usable = valid_vectors(vectors)
    queries = keep(usable.filter(is_query), "queries")
    n, size = queries.agg(F.count("*"), F.coalesce(F.sum(5 * F.size("embedding") + 32 + 16 * k), F.lit(0))).first()
    n_rows, n_columns = grid(n, size, vectors.count(), int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n_columns = columns or n_columns

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def one(count: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    def cells(rows: DataFrame, side: int, row: Column, col: Column) -> DataFrame:
        return rows.select(F.size("embedding").alias("dim"), row.alias("row"), col.alias("col"), F.lit(side).alias("side"), "vec_id", "embedding")

    both = cells(queries, QUERY, one(n_rows), every(n_columns)).unionByName(cells(usable, CANDIDATE, every(n_rows), one(n_columns)))
    # Three partitions a cell: few cells meet in one.
    both = both.repartition(3 * n_rows * n_columns, "dim", "row", "col").sortWithinPartitions("dim", "row", "col", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = None
        for b in batches:
            keys = np.stack([b.column(x).to_numpy(zero_copy_only=False) for x in ("dim", "row", "col", "side")])
            ids, lists = b.column("vec_id").to_numpy(zero_copy_only=False), b.column("embedding")
            flat, off = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            off = off - off[0]
            cuts = np.unique([0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1), b.num_rows]).tolist()
            for s, e in zip(cuts, cuts[1:]):
                *key, side = keys[:, s].tolist()
                if cell is None or cell.key != key:
                    if cell is not None:
                        yield from cell.result()
                    cell = _Cell(key, tile, k)
                cell.add(side, ids[s:e], flat[off[s]:off[e]].reshape(e - s, -1))
        if cell is not None:
            yield from cell.result()

    found = both.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
