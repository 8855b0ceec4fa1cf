"""Benchmark decontamination by a distributed positional inverted index.

The training texts are cut into shards of bounded size. ``build_index`` stores
for every shard its terms and, per term, the sorted list of token positions;
texts are one position apart, so no phrase spans two of them. The index is a
Parquet table with one row per shard: it is built once and searched by any
number of test sets. ``search`` sends the test items, in blocks of bounded
size, to all shards. Inside a shard a window of consecutive item words is
looked up from its rarest term on: the rarest position list, shifted by the
term's place in the window, is intersected with the next rarest, and so on
until it is empty or all terms have agreed (exact phrase). With ``slop`` the
same lists give proximity matches: all terms, in any order, within a few more
words than the window has.

Scale: building and searching are narrow (no shuffle); a shard never depends
on how often a passage occurs elsewhere, so copies and popular passages do not
gather anywhere. Only one block of test items (``block_bytes``) is broadcast
at a time; results of several blocks are merged per text.

Edge cases: a null or empty text has no words and is never contaminated; null
test items, null item ids and items without words are ignored; items sharing
an id count once; repeated document rows give one result row each; a null
doc_id is kept; further columns of either table are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from examlytics.llm.store import keep
from examlytics.llm.text import ASCII_LOWER, LOWER_ALNUM, Words, buffer_of, slices

WINDOW = 13
#: Words that may stand between the words of a proximity match.
SLOP = 2
SHARD_BYTES = 1 << 20
BLOCK_BYTES = 4 << 20

INDEX_SCHEMA = (
    "shard string, doc_ids array<bigint>, doc_starts binary, terms array<string>, hashes binary,"
    " list_starts binary, positions binary"
)
HITS_SCHEMA = (
    "shard string, ordinal int, doc_id bigint, n_words bigint,"
    " spans array<struct<start:bigint,end:bigint>>, items array<string>, near array<string>"
)


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard: texts, terms and positional postings (see module docstring)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for b in slices(batches, "text", shard_bytes):
            buf, off = buffer_of(b.column("text"))
            words = Words(ASCII_LOWER[buf], off, LOWER_ALNUM)
            owner, hashes = words.owner(), words.hashes()
            position = (np.arange(len(words)) + owner).astype(np.int32)  # one free place between texts
            order = np.argsort(hashes, kind="stable")
            ordered = hashes[order]
            lead = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] ^ np.uint64(1))) if len(ordered) else np.zeros(0, np.int64)
            raw = words.buf.tobytes()
            first = order[lead]
            terms = [raw[s:e].decode() for s, e in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "shard": [f"{part}-{number}"],
                "doc_ids": pa.array([b.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                "doc_starts": [(words.first + np.arange(len(words.first))).astype(np.int64).tobytes()],
                "terms": pa.array([terms], pa.list_(pa.string())),
                "hashes": [ordered[lead].tobytes()],
                "list_starts": [np.append(lead, len(order)).astype(np.int32).tobytes()],
                "positions": [position[order].tobytes()],
            })
            number += 1

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(build, INDEX_SCHEMA)


class TestBlock:
    """Windows of some test items, with item terms numbered once."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.window = window
        texts = pa.array([t for _, t in items], pa.string())
        buf, off = buffer_of(texts)
        words = Words(ASCII_LOWER[buf], off, LOWER_ALNUM)
        raw = words.buf.tobytes()
        strings = [raw[s:e].decode() for s, e in zip(words.starts.tolist(), words.ends.tolist(), strict=True)]
        hashes, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        self.hashes, self.terms, self.sequence = hashes, [strings[i] for i in first], number
        begin, length, item = [], [], []
        for k, (s, e) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            n = e - s
            if n:
                at = np.arange(max(1, n - window + 1))
                begin.append(s + at)
                length.append(np.full(len(at), min(n, window)))
                item.append(np.full(len(at), k))
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        self.begin, self.length, self.item = cat(begin), cat(length), cat(item)
        self.item_ids = [i for i, _ in items]


class Shard:
    """The postings of one shard."""

    def __init__(self, hashes: bytes, terms: list[str], list_starts: bytes, positions: bytes):
        self.hashes = np.frombuffer(hashes, np.uint64)
        self.terms = terms
        self.starts = np.frombuffer(list_starts, np.int32)
        self.positions = np.frombuffer(positions, np.int32)

    def lookup(self, block: TestBlock) -> np.ndarray:
        """Per test term: number of its list here, or -1."""
        at = np.searchsorted(self.hashes, block.hashes)
        at[at == len(self.hashes)] = 0
        found = self.hashes[at] == block.hashes if len(self.hashes) else np.zeros(len(at), bool)
        for i in np.flatnonzero(found):
            if self.terms[at[i]] != block.terms[i]:  # a hash collision is not a match
                found[i] = False
        return np.where(found, at, -1)

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.starts[term]: self.starts[term + 1]]

    def phrase(self, lists: np.ndarray) -> np.ndarray:
        """Start positions where the terms stand one after the other."""
        size = self.starts[lists + 1] - self.starts[lists]
        order = np.argsort(size, kind="stable")
        found = self.postings(lists[order[0]]) - order[0]
        for k in order[1:]:
            if not len(found):
                break
            have = self.postings(lists[k])
            at = np.searchsorted(have, found + k)
            at[at == len(have)] = 0
            found = found[have[at] == found + k]
        return found

    def perhaps_near(self, lists: np.ndarray, length: np.ndarray, slop: int) -> np.ndarray:
        """Windows (rows of ``lists``) whose rarest term has the next rarest close enough somewhere; all others match nowhere."""
        size = self.starts[lists + 1] - self.starts[lists]
        at = np.arange(len(lists))
        rarest = lists[at, size.argmin(1)]
        size = np.where(lists == rarest[:, None], np.iinfo(np.int32).max, size)
        second = lists[at, size.argmin(1)]  # the rarest itself if the window has no other term
        many = self.starts[rarest + 1] - self.starts[rarest]
        window = np.repeat(at, many)
        anchor = self.positions[np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many) + self.starts[rarest][window]].astype(np.int64)
        keys = np.repeat(np.arange(len(self.starts) - 1, dtype=np.int64) << 32, np.diff(self.starts)) + self.positions
        wanted, reach = second[window].astype(np.int64) << 32, length[window] + slop - 1
        found = np.searchsorted(keys, wanted + anchor + reach, "right") > np.searchsorted(keys, wanted + np.maximum(anchor - reach, 0))
        return np.unique(window[found])

    def near(self, lists: np.ndarray, width: int, doc_starts: np.ndarray, known: set[int]) -> list[int]:
        """Texts in which all terms lie within ``width`` words, found around the rarest term; those known already are left out."""
        need, times = np.unique(lists, return_counts=True)
        order = np.argsort(self.starts[need + 1] - self.starts[need], kind="stable")
        need, times = need[order], times[order]
        anchors = self.postings(need[0])
        if known:
            anchors = anchors[[d not in known for d in (np.searchsorted(doc_starts, anchors, "right") - 1).tolist()]]
        for t, n in zip(need[1:], times[1:], strict=True):  # each term often enough on either side, the rarest first
            if not len(anchors):
                return []
            have = self.postings(t)
            around = np.searchsorted(have, anchors + width) - np.searchsorted(have, anchors - width, "right")
            anchors = anchors[around >= n]
        out = []
        for a, d in zip(anchors.tolist(), (np.searchsorted(doc_starts, anchors, "right") - 1).tolist(), strict=True):
            for left in range(max(a - width + 1, int(doc_starts[d])), a + 1):
                right = min(left + width, int(doc_starts[d + 1]))
                inside = [np.subtract(*np.searchsorted(self.postings(t), (right, left))) for t in need]
                if all(i >= n for i, n in zip(inside, times, strict=True)):
                    out.append(d)
                    break
        return out


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _blocks(items: DataFrame, text: str, item_id: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Test items in blocks of bounded size; the driver holds one block at a time."""
    rows = items.select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("string").alias("t")).dropna()
    block, size = [], 0
    for r in rows.toLocalIterator():
        block.append((r.i, r.t))
        size += len(r.t.encode())
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(index: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", window: int = WINDOW,
           slop: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per indexed text: its hit spans (word numbers) and the items that matched.

    ``spans`` are the words inside occurrences of any window, ``items`` the
    ids of items with occurring windows, ``near`` (with ``slop``) the ids of
    items with a proximity match.
    """
    spark = index.sparkSession

    def one(items_block: list[tuple[str, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(items_block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = TestBlock(shared.value, window)
            for batch in batches:
                for row in batch.to_pylist():
                    yield _search_shard(row, block, slop)

        return index.mapInArrow(run, HITS_SCHEMA)

    parts = [one(b) for b in _blocks(items, text, item_id, block_bytes)] or [one([])]
    if len(parts) == 1:
        return parts[0]
    found = keep(parts[0], "hits")
    for p in parts[1:]:
        found = found.unionByName(keep(p, "hits"))
    return found.groupBy("shard", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def _search_shard(row: dict, block: TestBlock, slop: int | None) -> pa.RecordBatch:
    shard = Shard(row["hashes"], row["terms"], row["list_starts"], row["positions"])
    doc_starts = np.frombuffer(row["doc_starts"], np.int64)
    n = len(row["doc_ids"])
    spans: dict[int, list] = {}
    items: dict[int, set] = {}
    near: dict[int, set] = {}
    if len(block.begin):
        lists = shard.lookup(block)[block.sequence]
        missing = np.concatenate([[0], np.cumsum(lists < 0)])
        whole = missing[block.begin + block.length] == missing[block.begin]
        windows = np.flatnonzero(whole)
        close: set[int] = set()
        close_docs: dict[int, set] = {}
        if slop is not None and len(windows):
            place = np.minimum(np.arange(block.window), block.length[windows, None] - 1)
            close = set(windows[shard.perhaps_near(lists[block.begin[windows, None] + place], block.length[windows], slop)].tolist())
        for w in windows:
            s, k = block.begin[w], block.length[w]
            found = shard.phrase(lists[s:s + k])
            doc = np.searchsorted(doc_starts, found, "right") - 1
            for p, d in zip(found.tolist(), doc.tolist(), strict=True):
                base = int(doc_starts[d])
                spans.setdefault(d, []).append((p - base, p - base + int(k)))
                items.setdefault(d, set()).add(block.item_ids[block.item[w]])
            if int(w) in close:
                have = close_docs.setdefault(int(block.item[w]), set())  # an exact phrase is near
                have.update(doc.tolist())
                have.update(shard.near(lists[s:s + k], int(k) + slop, doc_starts, have))
        for i, docs in close_docs.items():
            for d in docs:
                near.setdefault(d, set()).add(block.item_ids[i])
    return pa.RecordBatch.from_pydict({
        "shard": pa.array([row["shard"]] * n, pa.string()),
        "ordinal": pa.array(range(n), pa.int32()),
        "doc_id": pa.array(row["doc_ids"], pa.int64()),
        "n_words": pa.array(np.diff(doc_starts) - 1, pa.int64()),
        "spans": pa.array([[{"start": s, "end": e} for s, e in _merge(spans.get(d, []))] for d in range(n)],
                          pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        "items": pa.array([sorted(items.get(d, ())) for d in range(n)], pa.list_(pa.string())),
        "near": pa.array([sorted(near.get(d, ())) for d in range(n)], pa.list_(pa.string())),
    })


def covered(spans: str = "spans"):
    """Number of words inside the spans (they may overlap after merging blocks)."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto"))

    def step(acc, s):
        begin = F.greatest(acc["upto"], s["start"])
        return F.struct((acc["n"] + F.greatest(F.lit(0).cast("bigint"), s["end"] - begin)).alias("n"),
                        F.greatest(acc["upto"], s["end"]).alias("upto"))

    return F.aggregate(F.col(spans), start, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """One row per document: hit words, matching items, items near by, and the verdict.

    A document is contaminated if it has hit words and they make up at least
    a twentieth of its words. ``near`` are the items with a window whose words
    stand in any order within ``slop`` more words than it has; they do not
    enter the verdict.
    """
    index = keep(build_index(docs), "positional-index")
    hits = search(index, benchmark, window=window, slop=slop)
    return (hits.withColumn("n_hit", covered())
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items", "near", "spans",
                    ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated")))
