"""Near duplicates by ProbMinHash: weighted shingles, banding and exact verification.

A document is the multiset of its word 5-grams (one shingle of all words if it
has fewer); the weight of a shingle is its number of occurrences. Every
shingle sends a Poisson process of arrivals, with its weight as rate, to
random registers; a register keeps its earliest arrival. Shingles stop as soon
as their next arrival is later than the document's latest register (early
termination), so most send one arrival. Two registers agree with the
probability Jaccard similarity of the documents. Registers are banded; documents
that share a band are candidates, and candidates are verified by the exact
similarity of their shingles.

Work on groups of copies:

* Documents with the same shingles and weights form one class with one
  representative (a pre-aggregated ``groupBy``); only representatives go on.
* First each representative is verified against one head only: the most
  central member (in the largest band groups) that it shares most bands with.
  This joins nearly all of a group of near copies in one comparison each.
* Then every band group that still holds two components yields the pairs
  between them, each once, not those within one (members outside the group's
  largest component are compared with the others), and only pairs that can
  reach the threshold: the shingles that no other node of these groups has,
  those of a head that only one of two nodes has which were both compared with
  it (a bit for each shingle of the head), and the slots of ``SLOTS`` that only
  one of the two fills, bound the similarity of the two from above. Pairs of a node and its head are known already. What is left is compared by registers, and
  pairs within ``MARGIN`` below the threshold (over six standard deviations) or
  above are verified. The bounds give up no link; the registers give up a pair
  at the threshold with probability 2e-8.
* The shingles of a head travel in as many copies as it has parts of
  ``FAN`` partners, so a head with very many partners is spread out.

With 30 bands of 5 registers a pair at the threshold 0.8 shares a band with
probability 0.99999.

Edge cases: null, empty and wordless texts are never linked (each is its own
class); rows with a null doc_id keep a null class; rows that repeat a doc_id
count as versions of one document; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from examlytics.llm.components import components
from examlytics.llm.marks import bitmap, marked
from examlytics.llm.store import keep
from examlytics.llm.text import NON_SPACE, Words, buffer_of, mix, ngram_hashes, slices

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 5
MARGIN = 0.2
FAN = 500
NODE_BITS = 1 << 25
BAND_BITS = 1 << 26
SHINGLE_BITS = 1 << 26
SLOTS = 1 << 11

PROFILE = "doc_id bigint, n_shingles bigint, profile binary, registers binary, bands array<bigint>"


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of some texts: first shingle of each text, hashes (sorted per text), occurrences."""
    words = Words(*buffer_of(texts), NON_SPACE)
    n = words.counts()
    many = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    of = np.repeat(np.arange(len(n)), many)
    begin = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + words.first[:-1][of]
    h = ngram_hashes(words.hashes(), begin, np.minimum(begin + size, words.first[1:][of])) if len(of) else np.zeros(0, np.uint64)
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    lead = np.flatnonzero(new)
    return np.searchsorted(of[lead], np.arange(len(n) + 1)), h[lead], np.diff(np.append(lead, len(h)))


def _uniform(h: np.ndarray, seed: int) -> np.ndarray:
    """Uniform numbers in (0, 1) per hash."""
    return ((mix(h + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def registers(first: np.ndarray, hashes: np.ndarray, weight: np.ndarray, m: int) -> np.ndarray:
    """ProbMinHash registers (texts x m): the shingle of the earliest arrival in each."""
    texts = len(first) - 1
    earliest = np.full(texts * m, np.inf)
    holder = np.zeros(texts * m, np.uint64)
    of = np.repeat(np.arange(texts), np.diff(first))
    h, rate, time, turn = hashes, weight.astype(np.float64), np.zeros(len(hashes)), 0
    lone = np.diff(first) == 1  # a single shingle holds every register
    if lone.any():
        holder.reshape(texts, m)[lone] = hashes[first[:-1][lone]][:, None]
        go = ~lone[of]
        of, h, rate, time = of[go], h[go], rate[go], time[go]
    while len(h):
        time = time - np.log(_uniform(h, 2 * turn + 1)) / rate
        slot = of * m + (_uniform(h, 2 * turn + 2) * m).astype(np.int64)
        np.minimum.at(earliest, slot, time)
        won = time == earliest[slot]
        holder[slot[won]] = h[won]
        go = time < earliest.reshape(texts, m).max(1)[of]
        of, h, rate, time, turn = of[go], h[go], rate[go], time[go], turn + 1
    return holder.reshape(texts, m)


def similarity(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Probability Jaccard similarity of two weighted sets (sorted hashes and weights)."""
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = x.astype(np.float64), y.astype(np.float64)
    p, q = x[i], y[j]
    lone_x, lone_y = x.sum() - p.sum(), y.sum() - q.sum()
    pairs, times = np.unique(np.stack([p, q], 1), axis=0, return_counts=True)
    # sum over d' of max(x'/x, y'/y), once per distinct pair of weights
    total = [np.maximum(pairs[:, 0] / u, pairs[:, 1] / v) @ times + lone_x / u + lone_y / v for u, v in pairs]
    return float((times / np.array(total)).sum())


def profiles(docs: DataFrame, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: number of distinct shingles, a 128-bit profile of the weighted shingles, registers and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            first, h, count = shingles(b.column("text"), size)
            held = registers(first, h, count, bands * rows)
            some = np.flatnonzero(np.diff(first))
            with np.errstate(over="ignore"):
                weighted = mix(h) * count.astype(np.uint64)
                print_ = np.zeros((len(first) - 1, 2), np.uint64)
                if len(some):
                    print_[some, 0] = np.add.reduceat(mix(weighted), first[:-1][some])
                    print_[some, 1] = np.add.reduceat(mix(weighted ^ np.uint64(0x5851F42D4C957F2D)), first[:-1][some])
                key = np.full((len(held), bands), 0, np.uint64)
                for r in range(rows):
                    key = mix(key ^ held.reshape(-1, bands, rows)[:, :, r])
                key = mix(key + np.arange(bands, dtype=np.uint64))
            short = (mix(held) & np.uint64(0xFFFF)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(np.diff(first).astype(np.int64)), pa.array([p.tobytes() for p in print_], pa.binary()),
                pa.array([s.tobytes() for s in short], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(0, bands * (len(key) + 1), bands, dtype=np.int32)), pa.array(key.view(np.int64).ravel()))],
                ["doc_id", "n_shingles", "profile", "registers", "bands"])

    return docs.mapInArrow(run, PROFILE)


def _marks_of(nodes: DataFrame):
    """A broadcast bitmap of fixed size of the nodes."""
    return nodes.sparkSession.sparkContext.broadcast(bitmap(nodes.select(F.xxhash64("node").alias("key")), NODE_BITS))


def _only(df: DataFrame, marks) -> DataFrame:
    """Rows of the marked nodes (and of few others) without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = pa.array(marked(marks.value, b.column("key").to_numpy(zero_copy_only=False).view(np.uint64)))
            yield b.drop_columns(["key"]).filter(own)

    return df.withColumn("key", F.xxhash64("node")).mapInArrow(run, df.schema)


def _shingle_sets(docs: DataFrame, shared, size: int) -> DataFrame:
    """(node, hashes, counts): the shingles of the marked documents (and of few others, which join nothing)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = marked(shared.value, batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64))
            for b in slices(iter([batch.filter(pa.array(own))]), "text"):
                first, h, count = shingles(b.column("text"), size)
                cut = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id"), pa.array([h[s:e].tobytes() for s, e in cut], pa.binary()),
                    pa.array([b"" if (count[s:e] == 1).all() else count[s:e].astype(np.uint32).tobytes() for s, e in cut], pa.binary())], ["node", "hashes", "counts"])

    return docs.select("doc_id", F.xxhash64("doc_id").alias("key"), "text").mapInArrow(run, "node bigint, hashes binary, counts binary")


def _read(hashes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    h = np.frombuffer(hashes, np.uint64)
    return h, np.frombuffer(counts, np.uint32) if counts else np.ones(len(h), np.uint32)


def _compared(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, similarity, shared, held): exact similarity of the pairs (a, b), and which of a's shingles b has.

    ``shared`` is their number, ``held`` a bit for each of a's shingles, in
    order, 64 to a word (null if a has several versions).
    """
    parts = pairs.groupBy(F.col("a").alias("head")).agg(F.ceil(F.count("*") / FAN).alias("parts"))
    salted = pairs.join(parts.withColumnRenamed("head", "a"), "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part"))
    heads = parts.select(F.col("head").alias("node"), F.col("head").alias("a"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    others = salted.select(F.col("b").alias("node"), "a", "part")
    rows = sets.join(heads.unionByName(others).hint("merge"), "node").select("a", "part", "node", "hashes", "counts")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, head = None, []
        for batch in batches:
            out = []
            for a, part, node, hashes, counts in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if (a, part) != group:
                    group, head = (a, part), []
                if node == a:  # sorts before its partners
                    head.append(_read(hashes, counts))
                    continue
                own = _read(hashes, counts)
                s, i = max(((similarity(*h, *own), len(np.intersect1d(h[0], own[0], assume_unique=True))) for h in head), default=(0.0, 0))
                bits = None
                if len(head) == 1:
                    flags = np.packbits(np.isin(head[0][0], own[0], assume_unique=True))
                    bits = np.append(flags, np.zeros(-len(flags) % 8, np.uint8)).view(np.int64)
                out.append((a, node, s, float(i), bits))
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types)], ["a", "b", "similarity", "shared", "held"])

    order = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("node") != F.col("a"))
    return order.mapInArrow(compare, "a bigint, b bigint, similarity double, shared double, held array<bigint>")


def _reach(sets: DataFrame, marks) -> DataFrame:
    """(node, total, common, plain, slots) of marked nodes: weight of the shingles, the part that another node may share, and whether all weights are 1.

    Shingles count as common by a bitmap of fixed size, so ``common`` is an
    upper bound. ``slots`` has a bit for each of ``SLOTS`` hash values that a
    common shingle has, 64 to a word.
    """

    def own(b: pa.RecordBatch) -> pa.RecordBatch:
        return b.filter(pa.array(marked(marks.value, b.column("key").to_numpy(zero_copy_only=False).view(np.uint64))))

    sets = sets.withColumn("key", F.xxhash64("node"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in map(own, batches):
            h = np.frombuffer(b"".join(b.column("hashes").to_pylist()), np.uint64) & np.uint64(SHINGLE_BITS - 1)
            kinds, times = np.unique(h, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(times.astype(np.int64))], ["key", "n"])

    often = sets.select("key", "hashes").mapInArrow(keys, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")
    shared = sets.sparkSession.sparkContext.broadcast(bitmap(often, SHINGLE_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in map(own, batches):
            out = []
            for hashes, counts in zip(b.column("hashes").to_pylist(), b.column("counts").to_pylist(), strict=True):
                h, w = _read(hashes, counts)
                often_held = marked(shared.value, h)
                flags = np.zeros(SLOTS, bool)
                flags[h[often_held] & np.uint64(SLOTS - 1)] = True
                out.append((float(w.sum()), float(w[often_held].sum()), not counts, np.packbits(flags).view(np.int64)))
            types = (pa.float64(), pa.float64(), pa.bool_(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("node"), *(pa.array([x[i] for x in out], t) for i, t in enumerate(types))],
                                             ["node", "total", "common", "plain", "slots"])

    return sets.mapInArrow(run, "node bigint, total double, common double, plain boolean, slots array<bigint>")


def _reaches(threshold: float, most_a, most_b):
    """Whether two nodes can reach the threshold if they share at most the weights ``most_a`` and ``most_b`` of theirs.

    With unit weights at most ``i`` shared shingles give i / (|a| + |b| - i).
    In general a pair that shares the fractions f and g of its weights has a
    probability Jaccard similarity of at most 1 / (1/f + 1/g - 1).
    """
    i = F.least(most_a, most_b)
    sets = i * (1 + threshold) >= threshold * (F.col("total_a") + F.col("total_b")) * (1 - 1e-9)
    general = (i > 0) & (F.col("total_a") / most_a + F.col("total_b") / most_b <= (1 + 1 / threshold) * (1 + 1e-9))
    return F.coalesce(general & (~(F.col("plain_a") & F.col("plain_b")) | sets), F.lit(True))


def _possible(threshold: float):
    """Whether two nodes that were not compared with each other can reach the threshold, given what each may share at most.

    That is its common part, less one for each slot that only this node's
    common shingles have: one of them at least is not the other's. If both were
    compared with one head, the head's shingles that only one of the two has are
    shared by neither.
    """
    common_a, common_b = F.col("common_a"), F.col("common_b")

    def overlap(x: str, y: str):
        return F.aggregate(F.zip_with(x, y, lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda n, k: n + k)

    both, slots = overlap("held_a", "held_b"), overlap("slots_a", "slots_b")
    by_slots = _reaches(threshold, common_a - (F.col("n_slots_a") - slots), common_b - (F.col("n_slots_b") - slots))
    one_head = F.coalesce((F.col("head_a") == F.col("head_b")) & F.col("held_a").isNotNull() & F.col("held_b").isNotNull(), F.lit(False))
    tight = _reaches(threshold, common_a - (F.col("shared_a") - both), common_b - (F.col("shared_b") - both))
    compared = F.coalesce(F.col("head_a") == F.col("node_b"), F.lit(False)) | F.coalesce(F.col("head_b") == F.col("node_a"), F.lit(False))
    return ~compared & _reaches(threshold, common_a, common_b) & F.when(one_head, tight).otherwise(True) & by_slots


def _crowded_bands(reps: DataFrame) -> DataFrame:
    """(band, node) of the bands that several representatives share (and of few others)."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds, times = np.unique(b.column("bands").flatten().to_numpy(zero_copy_only=False), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(times.astype(np.int64))], ["key", "n"])

    often = reps.select("bands").mapInArrow(keys, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")
    shared = reps.sparkSession.sparkContext.broadcast(bitmap(often, BAND_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, off = b.column("bands").flatten().to_numpy(zero_copy_only=False), b.column("bands").offsets.to_numpy()
            node = np.repeat(b.column("node").to_numpy(zero_copy_only=False), np.diff(off))
            own = marked(shared.value, flat.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(flat[own]), pa.array(node[own])], ["band", "node"])

    return reps.select("node", "bands").mapInArrow(run, "band bigint, node bigint")


def _alike(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose registers agree often enough."""
    for b in batches:
        x, y = (np.frombuffer(b"".join(b.column(n).to_pylist()), np.uint16).reshape(b.num_rows, -1) for n in ("ra", "rb"))
        good = pa.array((x == y).mean(1) >= least)
        yield pa.RecordBatch.from_arrays([b.column("a").filter(good), b.column("b").filter(good)], ["a", "b"])


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, copy_id and class_id.

    ``copy_id`` is the smallest doc_id with the same weighted shingles,
    ``class_id`` the smallest doc_id linked by a chain of pairs of at least
    ``threshold`` similarity.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = keep(profiles(texts, size, bands, rows), "profiles")
    some = made.filter("n_shingles > 0 and doc_id is not null")
    reps = keep(some.groupBy("profile").agg(F.min(F.struct("doc_id", "registers", "bands")).alias("least"))
                .select("profile", F.col("least.doc_id").alias("node"), "least.registers", "least.bands"), "representatives")
    classes = reps.select("profile", "node")
    texts = texts.filter("doc_id is not null")

    # One head per representative: the most central member it shares most bands with.
    banded = keep(_crowded_bands(reps), "crowded-bands")
    groups = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    shared = keep(banded.join(groups, "band").select("band", "node", "n"), "shared-bands")
    rank = shared.groupBy("node").agg(F.struct(F.sum("n").alias("rank"), (-F.col("node")).alias("node")).alias("rank"))
    ranked = keep(shared.select("band", "node").join(rank, "node"), "ranked-bands")
    leads = ranked.groupBy("band").agg(F.max("rank").alias("lead"))
    votes = ranked.join(leads, "band").filter("rank.node <> lead.node").groupBy("node", "lead").count()
    stars = keep(votes.groupBy("node").agg(F.max(F.struct("count", "lead")).alias("best")).select((-F.col("best.lead.node")).alias("a"), F.col("node").alias("b")), "stars")
    marks = _marks_of(shared.select("node").distinct())
    sets = keep(_shingle_sets(texts, marks, size), "shingle-sets")
    known = keep(_only(reps.select("node", "registers", "bands"), marks), "known")
    compared = keep(_compared(sets, stars), "compared-stars")
    roots = components(compared.filter(F.col("similarity") >= threshold).select("a", "b"))

    # Pairs between the components that still share a band and can reach the threshold.
    labelled = keep(shared.select("band", "node").join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root")), "labelled-bands")
    split = labelled.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("band")
    mixed = keep(labelled.join(split, "band", "left_semi"), "mixed-bands")
    star = compared.select(F.col("b").alias("node"), F.col("a").alias("head"), "shared", "held")
    nodes = mixed.select("node").distinct()
    with_heads = nodes.unionByName(nodes.join(star, "node").select(F.col("head").alias("node"))).distinct()
    n_slots = F.aggregate("slots", F.lit(0), lambda n, word: n + F.bit_count(word))
    reach = _reach(sets, _marks_of(with_heads)).filter(F.col("common") >= threshold * F.col("total") * (1 - 1e-9)).withColumn("n_slots", n_slots)
    able = mixed.join(reach, "node").join(star, "node", "left").join(known.select("node", "bands"), "node")
    # Of two nodes with different roots, one at least is not of the root that most members of the band have.
    sizes = able.groupBy("band", "root").count()
    major = sizes.groupBy("band").agg(F.max(F.struct("count", "root")).alias("most")).select("band", F.col("most.root").alias("major"))
    able = keep(able.join(major, "band").withColumn("minor", F.col("root") != F.col("major")).drop("major"), "able-bands")
    fields = ("node", "root", "total", "common", "plain", "head", "shared", "held", "minor", "bands", "slots", "n_slots")
    side = lambda x: able.select("band", *[F.col(c).alias(f"{c}_{x}") for c in fields])
    once = ~F.col("minor_b") | (F.col("node_a") < F.col("node_b"))
    first_band = F.col("band") == F.array_min(F.array_intersect("bands_a", "bands_b"))  # a pair shows at its smallest common band only
    across = (side("a").filter("minor_a").join(side("b"), "band")
              .filter((F.col("root_a") != F.col("root_b")) & once & _possible(threshold) & first_band)
              .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct())
    with_a = across.join(known.select(F.col("node").alias("a"), F.col("registers").alias("ra")), "a")
    with_both = with_a.join(known.select(F.col("node").alias("b"), F.col("registers").alias("rb")), "b").select("a", "b", "ra", "rb")
    close = keep(with_both.mapInArrow(lambda batches: _alike(batches, threshold - MARGIN), "a bigint, b bigint").distinct(), "close-pairs")
    if close.isEmpty():
        final = roots
    else:
        more = keep(_compared(sets, close).filter(F.col("similarity") >= threshold).select("a", "b"), "more-links")
        final = components(more.unionByName(roots.select(F.col("root").alias("a"), F.col("node").alias("b"))))

    found = classes.join(final, "node", "left").select("profile", F.col("node").alias("copy"), F.coalesce("root", "node").alias("cls"))
    out = made.select("doc_id", "n_shingles", "profile").join(found, "profile", "left")
    linked_row = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return out.select("doc_id", "n_shingles", F.when(linked_row, F.col("copy")).otherwise(F.col("doc_id")).alias("copy_id"),
                      F.when(linked_row, F.col("cls")).otherwise(F.col("doc_id")).alias("class_id"))
