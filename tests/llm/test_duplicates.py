"""Substring dedup, decontamination and near duplicates against brute force."""
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from examlytics.llm import decontaminate, minhash, substring
from examlytics.llm.components import components

WORDS = [f"w{i}" for i in range(400)] + ["été", "日本", "x.y", "A-b"]


def prose(rng, n, sep=(" ", " ", "\n", "  ", "\t")):
    return "".join(rng.choice(WORDS) + rng.choice(sep) for _ in range(n))


def shared_passages(seed):
    """Documents that share passages of several lengths, copies, repeats inside a document, and edge rows."""
    rng = random.Random(seed)
    passages = [prose(rng, n) for n in (9, 12, 13, 30, 60, 90)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 25))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), prose(rng, rng.randint(0, 8))]
        rows.append((i, "".join(parts)))
    rows += [(100 + k, rows[7][1]) for k in range(8)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, passages[5] * 3), (204, "one"), (7, rows[7][1]), (None, passages[4])]
    return rows, passages


def removed_by_force(rows, window):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for s in range(len(w) - window + 1):
                k = tuple(w[s:s + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s:s + window])] < i:
                gone.update(range(s, s + window))
        out.append((i if i is not None else -1, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize("window,gram,rows_per_bucket,bits", [(10, 4, 20_000, 1 << 20), (10, 4, 0, 1 << 20), (12, 3, 3, 1 << 15), (8, 8, 20_000, 1 << 16)])
def test_repeated_windows(docs_of, window, gram, rows_per_bucket, bits):
    rows, _ = shared_passages(window)
    got = substring.remove_repeats(docs_of(rows), window, gram, bits, rows_per_bucket).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed, r.kept) for r in got) == removed_by_force(rows, window)


def test_no_documents(docs_of):
    none = docs_of([]).filter(F.lit(False))
    assert substring.remove_repeats(none).count() == 0
    assert minhash.near_duplicates(none).count() == 0


def hits_by_force(rows, items, window=13):
    low = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    windows = defaultdict(set)
    for i, t in items:
        w = low(t)
        if i is not None and t is not None and w:
            for s in range(max(1, len(w) - window + 1)):
                windows[tuple(w[s:s + window])].add(str(i))
    sizes = {len(k) for k in windows}
    out = []
    for i, t in rows:
        w, hit, found = low(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                k = tuple(w[s:s + n])
                if k in windows:
                    hit.update(range(s, s + n))
                    found |= windows[k]
        out.append((i if i is not None else -1, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_contamination(spark, docs_of, block):
    rows, passages = shared_passages(5)
    rows = [(i, t.upper() if t and i in (3, 5) else t) for i, t in rows]
    items = [(1, passages[2]), (2, passages[3] + " tail words here"), (3, "one"), (4, None), (5, ""), (6, passages[0]), (6, passages[1]), (None, passages[5]), (10, "Zz Qq"), (11, passages[4])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    index = decontaminate.build_index(docs_of(rows), shard_bytes=2000)
    hits = decontaminate.search(index, bench, block_bytes=block).withColumn("n", decontaminate.covered())
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n, sorted(r["items"])) for r in hits.collect())
    assert got == [x[:4] for x in hits_by_force(rows, items)]


def test_contamination_verdict_and_empty_items(spark, docs_of):
    passage = " ".join(f"p{i}" for i in range(13))
    rows = [(1, passage + " x" * 247), (2, passage + " x" * 248), (3, "nothing"), (4, None)]
    bench = spark.createDataFrame([(9, passage)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.contaminated) for r in decontaminate.contamination(docs_of(rows), bench).collect()}
    assert got == {1: (13, True), 2: (13, False), 3: (0, False), 4: (0, False)}
    none = decontaminate.contamination(docs_of(rows), bench.filter("false")).collect()
    assert {r.doc_id for r in none if not r.contaminated} == {1, 2, 3, 4}


def test_proximity(spark, docs_of):
    rows = [(1, "alpha x beta y gamma"), (2, "alpha x y z v w beta gamma"), (3, "gamma beta alpha"), (4, "alpha beta"), (5, "gamma")]
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    got = {r.doc_id: r.near for r in decontaminate.search(decontaminate.build_index(docs_of(rows)), bench, slop=2).collect()}
    assert got == {1: ["1"], 2: [], 3: ["1"], 4: [], 5: []}


def classes_by_force(rows, threshold=0.8):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        if w and i is not None:
            sets[i] = Counter(tuple(w[s:s + 5]) for s in range(max(1, len(w) - 4)))
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            s = sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())
            if s >= threshold - 1e-12:
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def near_copies(seed, n=70):
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(60, 120)).split() for _ in range(5)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        if rng.random() < 0.2:
            w += w[:20] * 2
        rows.append((i, " ".join(w)))
    rows += [(300, rows[4][1]), (301, rows[4][1]), (302, "two words"), (303, "two words"), (304, ""), (305, None), (306, ""), (4, rows[4][1]), (None, rows[5][1])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicate_classes(docs_of, seed):
    rows = near_copies(seed)
    got = minhash.near_duplicates(docs_of(rows)).collect()
    assert len(got) == len(rows)
    want = classes_by_force(rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id in want} == want
    assert {r.doc_id: r.class_id for r in got if r.doc_id in (304, 305, 306)} == {304: 304, 305: 305, 306: 306}
    assert [r.class_id for r in got if r.doc_id is None] == [None]
    assert {r.copy_id for r in got if r.doc_id in (4, 300, 301)} == {4}


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 2**63, 300).astype(np.uint64)
    x, y = np.sort(h[:220]), np.sort(h[80:])
    a, b = rng.integers(1, 5, 220), rng.integers(1, 5, 220)
    both = np.concatenate([x, y])
    held = minhash.registers(np.array([0, 220, 440]), both, np.concatenate([a, b]), 4000)
    assert abs((held[0] == held[1]).mean() - minhash.similarity(x, a, y, b)) < 0.04


def test_registers_lose_fewer_pairs_than_banding():
    t, m = minhash.THRESHOLD, minhash.BANDS * minhash.ROWS
    lost = sum(math.comb(m, i) * t**i * (1 - t) ** (m - i) for i in range(m + 1) if i / m < t - minhash.MARGIN)
    assert lost < 0.01 * (1 - t**minhash.ROWS) ** minhash.BANDS


def test_bound_never_excludes_a_link():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = rng.integers(5, 30)
        h = np.arange(40, dtype=np.uint64)
        x, y = np.sort(rng.choice(h, n, False)), np.sort(rng.choice(h, n, False))
        a, b = rng.integers(1, 4, n), rng.integers(1, 4, n)
        f, g = a[np.isin(x, y)].sum() / a.sum(), b[np.isin(y, x)].sum() / b.sum()
        if f > 0:
            assert minhash.similarity(x, a, y, b) <= 1 / (1 / f + 1 / g - 1) + 1e-9


def test_shingles_of_short_texts():
    first, h, count = minhash.shingles(pa.array(["a b", "", None, "a b", "a a a a a a a"]))
    assert np.diff(first).tolist() == [1, 0, 0, 1, 1] and h[0] == h[1] and count.tolist() == [1, 1, 3]


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(500, 500)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_kept_text_digest(docs_of):
    from examlytics.llm.queries import sha256
    out = substring.remove_repeats(docs_of([(1, "é  b\nc")])).select(sha256("kept").alias("h")).first()
    assert out.h == hashlib.sha256("é b c".encode()).hexdigest()


def near_by_force(words, window, slop):
    """Whether some stretch of len(window) + slop words holds the window's words as often as the window."""
    need, width = Counter(window), len(window) + slop
    return any(not need - Counter(words[s:s + width]) for s in range(len(words)))


def test_proximity_against_brute_force(spark, docs_of):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(12)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(60)] + [(99, None)]
    items = [(f"i{k}", " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 9])))) for k in range(25)] + [("none", " ")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    for block_bytes in (1 << 20, 40):
        got = {r.doc_id: set(r.near) for r in decontaminate.search(decontaminate.build_index(docs_of(rows), shard_bytes=300), bench, window=4, slop=2, block_bytes=block_bytes).collect()}
        for i, t in rows:
            words = (t or "").split()
            windows = {k: [w[s:s + 4] for s in range(max(1, len(w) - 3))] for k, x in items if (w := x.split())}
            assert got[i] == {k for k, ws in windows.items() if any(near_by_force(words, w, 2) for w in ws)}


def one_group(n, seed=3):
    """Copies of one text with 0 to 7 changed words each, among unrelated texts."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 7)):
            words[rng.randrange(len(words))] = f"e{i}-{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    return rows + [(10_000 + i, " ".join(f"u{i}-{k}" for k in range(30))) for i in range(20)]


def test_verified_pairs_grow_with_the_group(docs_of, monkeypatch):
    """Not with its square: heads, and bounds by a head's shingles, leave few pairs to compare."""
    compared, counts = minhash._compared, []

    def counted(sets, pairs):
        counts[-1].append(pairs.count())
        return compared(sets, pairs)

    monkeypatch.setattr(minhash, "_compared", counted)
    for n in (60, 240):
        counts.append([])
        rows = one_group(n)
        got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs_of(rows)).collect()}
        if n == 60:
            assert got == classes_by_force(rows)
    small, large = map(sum, counts)
    assert large <= 6 * small and large <= 3 * 240


def test_unlinked_copies_of_one_text_yield_no_pairs(docs_of, monkeypatch):
    """Copies with different passages replaced stay below the threshold; their pairs end inside the join by bands."""
    rng, met = random.Random(3), []
    base = [f"b{i}" for i in range(100)]
    rows = []
    for k in range(12):
        text = base[:7 * k + 5] + [f"e{k}.{rng.random()}" for _ in range(3)] + base[7 * k + 8:]
        rows += [(10 * k + n, " ".join([*text, f"t{n}"])) for n in range(4)]
    held = minhash.keep

    def keep(df, name):
        out = held(df, name)
        met.extend(out.collect() if name == "close-pairs" else [])
        return out

    monkeypatch.setattr(minhash, "keep", keep)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs_of(rows)).collect()}
    assert got == {i: i // 10 * 10 for i, _ in rows}
    across = [p for p in met if p.a // 10 != p.b // 10]
    assert len(across) <= 20, len(across)
