"""Substring dedup on the suffix arrays of content-keyed shards.

Every byte that a ``window``-byte string covers which also starts elsewhere is
removed. Equal strings have the same minimiser, the smallest hash among their
``gram``-byte substrings; consecutive windows of a text that share a minimiser
travel as one string to its shard. There all suffixes of the shard's strings
are sorted by external induced sorting (``induction``), which yields the common
prefix of neighbours: a window whose common prefix with a neighbour reaches its
length starts elsewhere, too. A shard may be far larger than a task's memory.

Scale:

1. A narrow pass computes minimisers; a pre-aggregated ``groupBy`` finds those
   that occur twice. They are marked in a bitmap of fixed size
   (``filter_bits``); an unmarked one belongs to no repeated window, a false
   mark only costs traffic.
2. A second narrow pass writes the marked strings. Equal strings are counted
   before and after the shuffle, so a passage in a third of all texts reaches
   its shard as one row; a string that occurs twice is repeated in whole. A
   string that shares its minimiser with no other one and does not hold it
   twice needs no sorting.
3. If the distinct strings of one minimiser exceed ``bucket_bytes`` (many
   different surroundings of one line or passage), they are cut again by a
   longer gram, and again only strings of repeated minimisers go on, up to the
   whole window, where one bucket is one string. So a shard's size does not
   follow a hot key's, and there are as many shards as the strings need at
   ``SHARD_BYTES`` each.
4. Found ranges join the texts by SHA-256; copies have the same ranges.

Long texts are handled in overlapping chunks of ``CHUNK`` bytes, and strings
have at most ``LONGEST`` windows.

Edge cases: a null or empty text has 0 bytes; texts shorter than the window
stay whole; rows that repeat a text are copies and go in whole if they hold a
window, also under one doc_id or a null one; removed ranges may split a
character, so ``kept`` is binary; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from examlytics.llm import induction
from examlytics.llm.marks import bitmap, marked
from examlytics.llm.store import discard, keep
from examlytics.llm.text import buffer_of, mix, slices

WINDOW = 400
GRAMS = (32, 200, 320)
FILTER_BITS = 1 << 26
BUCKET_BYTES = 1 << 21
SHARD_BYTES = 1 << 21
CHUNK = 1 << 19
LONGEST = 1024
PLACE_BITS = 20


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from prefix and suffix minima of blocks of that width."""
    n = len(x)
    if n < width:
        return x[:0]
    full = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    full[:n] = x
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1: n])


#: A fixed random number for each byte.
BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(buf: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of every ``gram`` consecutive bytes, composed from those of powers of two."""
    if len(buf) < gram:
        return np.zeros(0, np.uint64)
    whole, size, out, have = BYTE_HASH[buf], 1, None, 0
    factor = np.uint64(0xD1342543DE82EF95)
    while True:
        if gram & size:
            out = whole.copy() if out is None else out[: len(buf) - have - size + 1] * factor + whole[have:]
            have += size
        if have == gram:
            return mix(out)
        whole = whole[:-size] * factor + whole[size:]
        size *= 2
        factor = mix(factor[None])[0] | np.uint64(1)


def strings(buf: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first byte, number of windows and inner repetition of every run of windows that share a minimiser.

    The low bits of a window's least hash are replaced by its place, so the
    leftmost is taken. If two windows of a run are equal, their leftmost places
    differ, which marks an inner repetition.
    """
    none = np.zeros(0, np.int64)
    if len(buf) < window:
        return np.zeros(0, np.uint64), none, none, np.zeros(0, bool)
    hashes = gram_hashes(buf, gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = _sliding_least((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), window - gram + 1)
    n = len(least)
    valid = np.ones(n, bool)
    for e in offsets[1:-1].tolist():  # windows across two texts
        valid[max(0, e - window + 1): e] = False
    value = least >> np.uint64(PLACE_BITS)
    change = np.ones(n, bool)
    change[1:] = (value[1:] != value[:-1]) | ~valid[:-1]
    begin = np.flatnonzero(change & valid)
    stop = np.ones(n, bool)
    stop[:-1] = (value[1:] != value[:-1]) | ~valid[1:]
    end = np.flatnonzero(stop & valid)
    return value[begin], begin, end - begin + 1, least[begin] != least[end]


def _cut(begin: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of more than LONGEST windows in parts: run, first window and number of windows."""
    parts = -(-many // LONGEST)
    run = np.repeat(np.arange(len(many)), parts)
    k = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
    return run, begin[run] + k * LONGEST, np.minimum(many[run] - k * LONGEST, LONGEST)


def _pieces(b: pa.RecordBatch, column: str, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Bytes and text offsets of a slice, the first row and its first byte; a long text in chunks that share window - 1 bytes."""
    col = b.column(column)
    buf, off = buffer_of(col) if pa.types.is_string(col.type) else buffer_of_binary(col)
    if len(buf) <= 2 * CHUNK:
        yield buf, off, 0, 0
        return
    for row in range(b.num_rows):
        for s in range(int(off[row]), int(off[row + 1]), CHUNK):
            part = buf[s: min(int(off[row + 1]), s + CHUNK + window - 1)]
            yield part, np.array([0, len(part)]), row, s - int(off[row])


def buffer_of_binary(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    col = col.cast(pa.large_binary())
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset: col.offset + len(col) + 1]
    return np.frombuffer(data, np.uint8)[off[0]: off[-1]] if data is not None else np.zeros(0, np.uint8), off - off[0]


def _minimisers(rows: DataFrame, column: str, window: int, gram: int) -> DataFrame:
    """(mh, n): minimisers and how often they occur, per slice; twice at least where a run may repeat itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, column):
            for buf, off, _, _ in _pieces(b, column, window):
                value, _, _, inner = strings(buf, off, window, gram)
                mh, of = np.unique(value, return_inverse=True)
                n = np.bincount(of, 1 + inner, len(mh)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(mh.view(np.int64)), pa.array(n)], ["mh", "n"])

    return rows.select(column).mapInArrow(run, "mh bigint, n bigint")


def _marks(rows: DataFrame, column: str, window: int, gram: int, filter_bits: int):
    """A broadcast bitmap of fixed size of the minimisers that occur twice."""
    twice = _minimisers(rows, column, window, gram).groupBy("mh").agg(F.sum("n").alias("n")).filter("n > 1")
    return rows.sparkSession.sparkContext.broadcast(bitmap(twice, filter_bits, "mh"))


FOUND = "owner binary, start bigint, mh bigint, key binary, packed binary, inner boolean, n bigint"


def _strings(rows: DataFrame, column: str, window: int, gram: int, marks) -> DataFrame:
    """The strings of all rows (owner, ``column``, n) with their place, if their minimiser is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, column):
            for buf, off, row, byte in _pieces(b, column, window):
                value, begin, many, inner = strings(buf, off, window, gram)
                own = marked(marks.value, value)
                value, begin, many, inner = value[own], begin[own], many[own], inner[own]
                which, begin, many = _cut(begin, many)
                raw = buf.tobytes()
                packed = [raw[s:e] for s, e in zip(begin.tolist(), (begin + many + window - 1).tolist(), strict=True)]
                of = np.searchsorted(off, begin, "right") - 1
                at = pa.array(of + row)
                yield pa.RecordBatch.from_arrays([
                    b.column("owner").take(at), pa.array(begin - off[of] + byte), pa.array(value[which].view(np.int64)),
                    pa.array([hashlib.blake2b(p, digest_size=16).digest() for p in packed], pa.binary()), pa.array(packed, pa.binary()),
                    pa.array(inner[which]), b.column("n").take(at)], ["owner", "start", "mh", "key", "packed", "inner", "n"])

    return rows.select("owner", column, "n").mapInArrow(run, FOUND)


def shard_hits(packed: list[bytes], window: int, memory: int, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, first byte and end of the bytes that windows cover which start twice among the strings of a shard."""
    n = sum(map(len, packed)) + len(packed) + 1
    text = induction.scratch(n, np.uint16, memory)
    first, at = np.zeros(len(packed) + 1, np.int64), 0
    for k, p in enumerate(packed):
        text[at: at + len(p)] = np.frombuffer(p, np.uint8).astype(np.uint16) + 2
        text[at + len(p)] = 1  # ends a string
        at += len(p) + 1
        first[k + 1] = at
    text[at] = 0
    hit = induction.scratch(n, bool, memory)
    found = induction.suffixes(text, 258, window, induction.Pool(memory), base)
    before = None
    while found.blocks:
        pos, lcp = found.take()
        equal = lcp >= window
        hit[pos[equal]] = True
        hit[pos[:-1][equal[1:]]] = True
        if before is not None and equal[0]:
            hit[before] = True
        before = pos[-1]
    s, of = np.flatnonzero(hit), None
    of = np.searchsorted(first, s, "right") - 1
    inside = s + window < first[of + 1]  # the window ends before its string does
    s, of = s[inside], of[inside]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1] + 1) | (of[1:] != of[:-1])
    b = np.flatnonzero(new)
    e = np.append(b[1:], len(s)) - 1 if len(b) else b
    return of[b], s[b] - first[of[b]], s[e] - first[of[b]] + window


def _sorted_shards(distinct: DataFrame, window: int, memory: int, base: int) -> DataFrame:
    """(key, s, e): repeated bytes of the distinct strings; strings of one minimiser meet in one shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[bytes, bytes]] = []
        last: list[tuple[int, bytes, bytes, int, bool]] = []
        whole: list[tuple[bytes, int]] = []

        def close() -> None:
            """A bucket is complete."""
            for _, key, packed, n, _ in last:
                if n > 1:
                    whole.append((key, len(packed)))
            if len(last) > 1 or any(x[4] and x[3] == 1 for x in last):
                kept.extend((x[1], x[2]) for x in last)
            last.clear()

        for b in batches:
            for x in zip(*(b.column(c).to_pylist() for c in ("mh", "key", "packed", "n", "inner")), strict=True):
                if last and last[-1][0] != x[0]:
                    close()
                last.append(x)
        close()
        of, s, e = shard_hits([p for _, p in kept], window, memory, base) if kept else (np.zeros(0, np.int64),) * 3
        keys = [kept[i][0] for i in of.tolist()]
        yield pa.RecordBatch.from_arrays([
            pa.array(keys + [k for k, _ in whole], pa.binary()), pa.array(np.append(s, np.zeros(len(whole), np.int64))),
            pa.array(np.append(e, np.array([n for _, n in whole], np.int64)))], ["key", "s", "e"])

    size = distinct.agg(F.sum(F.octet_length("packed").cast("bigint"))).first()[0] or 0
    shards = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    return distinct.repartition(shards, "mh").sortWithinPartitions("mh").mapInArrow(run, "key binary, s bigint, e bigint")


def _hits(found: DataFrame, window: int, grams: tuple[int, ...], filter_bits: int, bucket_bytes: int, memory: int, base: int) -> DataFrame:
    """(key, s, e) of all strings; buckets that are too large are cut again by the next gram."""
    distinct = keep(found.groupBy("mh", "key", "packed").agg(F.sum("n").alias("n"), F.max("inner").alias("inner")), "suffix-strings")
    if not grams:
        return _sorted_shards(distinct, window, memory, base)
    large = keep(distinct.groupBy("mh").agg(F.sum(F.octet_length("packed")).alias("size")).filter(F.col("size") > bucket_bytes).select("mh"), "large-buckets")
    if large.isEmpty():
        return _sorted_shards(distinct, window, memory, base)
    hits = _sorted_shards(distinct.join(large, "mh", "left_anti"), window, memory, base)
    crowd = keep(distinct.join(large, "mh", "left_semi").select(F.col("key").alias("owner"), "packed", "n"), "crowded-strings")
    whole = crowd.filter("n > 1").select(F.col("owner").alias("key"), F.lit(0).cast("bigint").alias("s"), F.octet_length("packed").cast("bigint").alias("e"))
    once = crowd.withColumn("n", F.lit(1).cast("bigint"))
    again = keep(_strings(once, "packed", window, grams[0], _marks(once, "packed", window, grams[0], filter_bits)), "longer-grams")
    deeper = keep(_hits(again, window, grams[1:], filter_bits, bucket_bytes, memory, base), "deeper-hits")
    inside = again.select("owner", "start", "key").join(deeper, "key").select(
        F.col("owner").alias("key"), (F.col("start") + F.col("s")).alias("s"), (F.col("start") + F.col("e")).alias("e"))
    return hits.unionByName(whole).unionByName(inside)


def repeated_ranges(rows: DataFrame, window: int = WINDOW, grams: tuple[int, ...] = GRAMS, filter_bits: int = FILTER_BITS,
                    bucket_bytes: int = BUCKET_BYTES, memory: int = induction.MEMORY, base: int = induction.BASE) -> DataFrame:
    """(owner, ranges): byte ranges [s, e) to remove from the texts of each owner (their SHA-256)."""
    rows = rows.filter(F.octet_length("text") >= window).withColumn("n", F.lit(1).cast("bigint"))
    found = keep(_strings(rows, "text", window, grams[0], _marks(rows, "text", window, grams[0], filter_bits)), "suffix-occurrences")
    hits = keep(_hits(found, window, (*grams[1:], window), filter_bits, bucket_bytes, memory, base), "suffix-hits")
    places = found.select("owner", "start", "key").distinct().join(hits, "key")
    ranges = (places.select("owner", (F.col("start") + F.col("s")).alias("s"), (F.col("start") + F.col("e")).alias("e"))
              .groupBy("owner").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("ranges")))
    out = keep(ranges, "repeated-bytes")
    discard(found)
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, **settings) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and the bytes kept."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("owner"))
    ranges = repeated_ranges(rows, window, **settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            buf, off = buffer_of(b.column("text"))
            raw, out = buf.tobytes(), []
            for i, found in enumerate(b.column("ranges").to_pylist()):
                text = raw[off[i]: off[i + 1]]
                kept, spans, end = [], 0, 0
                for r in found or ():
                    if r["s"] > end or not spans:
                        kept.append(text[end: r["s"]])
                        spans += 1
                    end = max(end, r["e"])
                kept = b"".join([*kept, text[end:]])
                out.append((len(text), len(text) - len(kept), spans, kept))
            total, gone, spans, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = rows.join(ranges, "owner", "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
