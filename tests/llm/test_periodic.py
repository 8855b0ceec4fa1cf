"""Periodic runs against brute force."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from examlytics.llm import periodic, queries


def by_force(x, least=periodic.LEAST):
    """Runs of the words x from the definition, period by period."""
    best = {}
    for d in range(1, len(x) // 3 + 1):
        i = 0
        while i + d < len(x):
            if x[i] != x[i + d]:
                i += 1
                continue
            s = i
            while i + d < len(x) and x[i] == x[i + d]:
                i += 1
            if i + d - s >= max(least, 3 * d):
                best.setdefault((s, i + d), d)
    return sorted((s, e - s, d) for (s, e), d in best.items())


def sample(rng):
    x = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(0, 400))]
    for _ in range(rng.randint(0, 3)):
        if len(x) > 30:
            a, p = rng.randrange(len(x)), rng.randint(1, 60)
            for i in range(a + p, min(len(x), a + p * rng.randint(3, 9) + rng.randint(0, 5))):
                x[i] = x[i - p]
    return x


def test_transform_gives_exact_squared_differences():
    rng = np.random.default_rng(0)
    for block in (1, 8, 64):
        x = rng.integers(0, 1000, 400)
        starts = np.array([0, 64, 400 - block])
        got = periodic.squared_differences(x, starts, block)
        padded = np.append(x, np.zeros(3 * block, np.int64))
        for s, row in zip(starts, got):
            assert row.tolist() == [int(((padded[s:s + block] - padded[s + d:s + d + block]) ** 2).sum()) % periodic.PRIME for d in range(2 * block + 1)]


@pytest.mark.parametrize("cells", [periodic.CELLS, 64])
def test_runs(monkeypatch, cells):
    monkeypatch.setattr(periodic, "CELLS", cells)
    rng = random.Random(cells)
    for _ in range(150):
        x = sample(rng)
        assert periodic.runs(np.array(x, np.int32)) == by_force(x)


def test_collapsed(docs_of, monkeypatch):
    """Rows with and without runs, in one slice; words in pieces."""
    monkeypatch.setattr(periodic, "PIECE", 50)
    rng = random.Random(5)
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(f"w{v}" for v in sample(rng))) for i in range(40)]
    rows += [(90, None), (91, ""), (92, "a " * 24), (93, "a " * 23), (92, "a " * 24), (None, "b c " * 30), (94, "é" * 300 + " x" * 40)]
    got = periodic.collapsed(docs_of(rows)).collect()
    want = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = by_force(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((str(i), len(w), runs, " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == sorted(want)
    assert periodic.collapsed(docs_of([])).collect() == []


def test_query(spark, tmp_path, docs_of):
    """The contract's columns, with its planted repeats."""
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randint(0, 160)))) for i in range(120)] + [(500, None), (501, "a b " * 20 + "c d " * 20)]
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()}
    planted = 0
    for i, t in rows:
        w = (t or "").split()
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = by_force(w)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *(best or (None,) * 3))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()
    assert planted > 3
