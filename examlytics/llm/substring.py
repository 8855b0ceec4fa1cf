"""Substring dedup by super-k-mers: repeated word windows across documents.

A window is ``window`` consecutive words of one document. Words covered by a
window whose word sequence also starts in a document with a smaller id are
removed. Windows meet by their minimiser, the smallest hash among the word
m-grams they contain: consecutive windows of a document that share a
minimiser form one super-k-mer and travel as one packed string (their words,
joined by one space) to the minimiser's bucket, where the windows of all
strings are sorted; equal neighbours give every window its smallest document.

Steps and their cost at scale:

1. One narrow pass computes the minimisers; a pre-aggregated ``groupBy`` finds
   those seen in two documents. They are marked in a bitmap of fixed size
   (``filter_bits``), the only thing broadcast. A minimiser seen in one
   document cannot belong to a repeated window, and false positives of the
   bitmap only cost traffic, so the result stays exact at any size.
2. A second narrow pass packs the marked super-k-mers into a table in the
   shared folder.
3. Equal strings are merged before and after the shuffle (smallest and largest
   document), so a passage that a third of all documents share reaches its
   bucket as one row.
4. Buckets are sorted. A bucket of more than ``bucket_rows`` distinct strings
   (thousands of variants around one minimiser) is not gathered: its windows
   travel one by one as 128-bit hashes and are merged by ``groupBy``.
5. Occurrences look up their string's windows (a join Spark can split where a
   string is frequent), and each document joins its covered word ranges.

Edge cases: a null text has no words; a null doc_id is smaller than none and
larger than none, so such rows keep all their words; rows repeating a doc_id
do not remove one another's words; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from examlytics.llm.marks import bitmap, marked
from examlytics.llm.store import keep
from examlytics.llm.text import NON_SPACE, Words, buffer_of, ngram_hashes, range_hash, slices

WINDOW = 50
GRAM = 8
FILTER_BITS = 1 << 26
BUCKET_ROWS = 20_000


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (doubling)."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:]) if len(x) > have else x[:0]
        have *= 2
    rest = width - have
    if rest:
        x = np.minimum(x[:-rest], x[rest:]) if len(x) > rest else x[:0]
    return x


def super_kmers(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window and number of windows of every super-k-mer (windows are named by their first word)."""
    n = len(words)
    none = np.zeros(0, np.int64)
    if n < window:
        return np.zeros(0, np.uint64), none, none
    at = np.arange(n - gram + 1)
    least = _sliding_min(ngram_hashes(words.hashes(), at, at + gram), window - gram + 1)
    owner = words.owner()
    valid = owner[: n - window + 1] == owner[window - 1:]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    begin = np.flatnonzero(new)
    if not len(begin):
        return np.zeros(0, np.uint64), none, none
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (least[1:] != least[:-1])
    return least[begin], begin, np.flatnonzero(last) - begin + 1


def _minimisers(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            words = Words(*buffer_of(b.column("text")), NON_SPACE)
            least, begin, _ = super_kmers(words, window, gram)
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)[words.owner()[begin]] if len(begin) else np.zeros(0, np.int64)
            order = np.lexsort((ids, least))
            least, ids = least[order], ids[order]
            new = np.ones(len(least), bool)
            new[1:] = (least[1:] != least[:-1]) | (ids[1:] != ids[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(least[new].view(np.int64)), pa.array(ids[new].astype(np.int64))], ["mh", "doc_id"])

    return docs.mapInArrow(run, "mh bigint, doc_id bigint")


def _marks(minimisers: DataFrame, bits: int) -> bytes:
    """Bitmap of the minimisers that two documents have."""
    twice = minimisers.groupBy("mh").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    return bitmap(twice, bits, "mh")


def _occurrences(docs: DataFrame, marks, window: int, gram: int) -> DataFrame:
    """The packed super-k-mers whose minimiser is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            words = Words(*buffer_of(b.column("text")), NON_SPACE)
            least, begin, many = super_kmers(words, window, gram)
            own = marked(marks.value, least)
            least, begin, many = least[own], begin[own], many[own]
            owner = words.owner()[begin] if len(begin) else np.zeros(0, np.int64)
            raw = words.buf.tobytes()
            packed = [b" ".join(raw[s:e].split()) for s, e in zip(words.starts[begin].tolist(), words.ends[begin + many + window - 2].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(least.view(np.int64)), pa.array([hashlib.blake2b(p, digest_size=16).digest() for p in packed], pa.binary()),
                pa.array(packed, pa.binary()), pa.array(b.column("doc_id").to_numpy(zero_copy_only=False)[owner].astype(np.int64)),
                pa.array(b.column("version").to_numpy(zero_copy_only=False)[owner].astype(np.int64)),
                pa.array((begin - words.first[owner]).astype(np.int64)),
            ], ["mh", "key", "packed", "doc_id", "version", "start"])

    return docs.mapInArrow(run, "mh bigint, key binary, packed binary, doc_id bigint, version bigint, start bigint")


def _windows(packed: pa.Array, window: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of packed strings; first word, string and two 64-bit hashes of every window."""
    words = Words(*buffer_of(packed), NON_SPACE)
    owner = words.owner()
    begin = np.flatnonzero(owner[: len(words) - window + 1] == owner[window - 1:]) if len(words) >= window else np.zeros(0, np.int64)
    one = ngram_hashes(words.hashes(), begin, begin + window)
    two = range_hash(words.hashes(), begin, begin + window, 0x9FB21C651E98DF25)
    return words, begin, owner[begin], np.stack([one, two], 1)


def _lowest(mh: np.ndarray, packed: pa.Array, lo: np.ndarray, window: int) -> list[np.ndarray]:
    """Per string the smallest document of each of its windows, by sorting the windows of its bucket."""
    words, begin, of, hashes = _windows(packed, window)
    bucket = mh[of]
    order = np.lexsort((lo[of], hashes[:, 1], hashes[:, 0], bucket))
    same = np.zeros(len(order), bool)
    a, b = order[1:], order[:-1]
    same[1:] = (bucket[a] == bucket[b]) & (hashes[a] == hashes[b]).all(1)
    raw = words.buf.tobytes()
    for i in np.flatnonzero(same):  # equal hashes: the windows themselves must be equal
        x, y = begin[order[i]], begin[order[i - 1]]
        if raw[words.starts[x]:words.ends[x + window - 1]] != raw[words.starts[y]:words.ends[y + window - 1]]:
            raise ValueError("two different windows have one 128-bit hash")
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    low = np.empty(len(order), np.int64)
    low[order] = lo[of][order][lead]
    cut = np.searchsorted(of, np.arange(len(packed) + 1))
    return [low[s:e] for s, e in zip(cut[:-1], cut[1:], strict=True)]


def _sorted_buckets(distinct: DataFrame, window: int, rows: int = 4000) -> DataFrame:
    """Strings with a window that a smaller document has, and the smallest document per window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def work(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            col = {n: table.column(n).combine_chunks() for n in table.column_names}
            col = {n: (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c) for n, c in col.items()}
            lows = _lowest(col["mh"].to_numpy(zero_copy_only=False), col["packed"].cast(pa.string()), col["lo"].to_numpy(zero_copy_only=False), window)
            hi = col["hi"].to_numpy(zero_copy_only=False)
            keys = col["key"].to_pylist()
            out = [(k, x) for k, x, h in zip(keys, lows, hi, strict=True) if len(x) and x.min() < h]
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([x for _, x in out], pa.list_(pa.int64()))], ["key", "lows"])

        for b in batches:
            held.append(b)
            table = pa.Table.from_batches(held)
            if table.num_rows < rows:
                continue
            mh = table.column("mh").to_numpy()
            cut = int(np.searchsorted(mh, mh[-1]))  # the last bucket may go on in the next batch
            if cut:
                yield work(table.slice(0, cut))
                held = table.slice(cut).to_batches()
            else:
                held = table.to_batches()
        if held:
            yield work(pa.Table.from_batches(held))

    return distinct.repartition("mh").sortWithinPartitions("mh").mapInArrow(run, "key binary, lows array<bigint>")


def _single_windows(distinct: DataFrame, window: int) -> DataFrame:
    """The same as ``_sorted_buckets`` for large buckets: windows travel one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, _, of, hashes = _windows(b.column("packed").cast(pa.string()), window)
            first = np.searchsorted(of, np.arange(b.num_rows + 1))
            place = np.arange(len(of)) - first[of]
            yield pa.RecordBatch.from_arrays([
                b.column("mh").take(pa.array(of)), b.column("key").take(pa.array(of)), b.column("lo").take(pa.array(of)), b.column("hi").take(pa.array(of)),
                pa.array(place.astype(np.int32)), pa.array(hashes[:, 0].view(np.int64)), pa.array(hashes[:, 1].view(np.int64))], ["mh", "key", "lo", "hi", "place", "h1", "h2"])

    singles = distinct.mapInArrow(run, "mh bigint, key binary, lo bigint, hi bigint, place int, h1 bigint, h2 bigint")
    least = singles.groupBy("mh", "h1", "h2").agg(F.min("lo").alias("low"))
    return (singles.join(least, ["mh", "h1", "h2"]).groupBy("key")
            .agg(F.max("hi").alias("hi"), F.array_sort(F.collect_list(F.struct("place", "low"))).alias("w"))
            .select("key", "hi", F.col("w.low").alias("lows")).filter(F.array_min("lows") < F.col("hi")).select("key", "lows"))


def _ranges(found: DataFrame, window: int) -> DataFrame:
    """Word ranges that an occurrence loses: runs of windows with a smaller document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lows = b.column("lows")
            flat, off = lows.flatten().to_numpy(zero_copy_only=False), lows.offsets.to_numpy()
            off = off - off[0]
            row = np.repeat(np.arange(b.num_rows), np.diff(off))
            hit = flat < b.column("doc_id").to_numpy(zero_copy_only=False)[row]
            start = hit.copy()
            start[1:] &= ~hit[:-1] | (row[1:] != row[:-1])
            end = hit.copy()
            end[:-1] &= ~hit[1:] | (row[1:] != row[:-1])
            s, e = np.flatnonzero(start), np.flatnonzero(end)
            base = b.column("start").to_numpy(zero_copy_only=False)[row[s]] - off[row[s]]
            of = pa.array(row[s])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(of), b.column("version").take(of), pa.array(s + base), pa.array(e + base + window)],
                                             ["doc_id", "version", "s", "e"])

    return found.select("doc_id", "version", "start", "lows").mapInArrow(run, "doc_id bigint, version bigint, s bigint, e bigint")


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, filter_bits: int = FILTER_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, version, ranges): word ranges [s, e) to remove; version tells rows of one doc_id apart by their text."""
    spark = docs.sparkSession
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    marks = spark.sparkContext.broadcast(_marks(_minimisers(rows.select("doc_id", "text"), window, gram), filter_bits))
    found = keep(_occurrences(rows, marks, window, gram), "super-kmers")
    distinct = keep(found.groupBy("mh", "key", "packed").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")), "distinct-super-kmers")
    large = distinct.groupBy("mh").count().filter(F.col("count") > bucket_rows).select("mh")
    lows = (_sorted_buckets(distinct.join(large, "mh", "left_anti"), window)
            .unionByName(_single_windows(distinct.join(large, "mh", "left_semi"), window)))
    hits = found.select("key", "doc_id", "version", "start").join(lows, "key")
    return (_ranges(hits, window).groupBy("doc_id", "version")
            .agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("ranges")))


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, filter_bits: int = FILTER_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and the kept words, joined by one space."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))
    ranges = keep(repeated_ranges(rows, window, gram, filter_bits, bucket_rows), "repeated-ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            words = Words(*buffer_of(b.column("text")), NON_SPACE)
            total, raw = words.counts(), words.buf.tobytes()
            kept, removed = [], []
            for i, ranges in enumerate(b.column("ranges").to_pylist()):
                s, e = int(words.offsets[i]), int(words.offsets[i + 1])
                tokens = raw[s:e].split()
                n = 0
                if ranges:
                    gone = np.zeros(len(tokens) + 1, np.int64)
                    np.add.at(gone, [r["s"] for r in ranges], 1)
                    np.add.at(gone, [r["e"] for r in ranges], -1)
                    out = np.cumsum(gone)[:-1] > 0
                    n = int(out.sum())
                    tokens = [t for t, x in zip(tokens, out.tolist(), strict=True) if not x]
                removed.append(n)
                kept.append(b" ".join(tokens))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(total.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                                             ["doc_id", "n_words", "n_removed", "kept"])

    joined = rows.join(ranges, ["doc_id", "version"], "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string")
