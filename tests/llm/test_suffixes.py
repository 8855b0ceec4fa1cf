"""External induced sorting and the dedup on it, against brute force."""
import random

import numpy as np
import pytest

from examlytics.llm import induced, induction


def suffixes(x, cap, base, memory):
    pool = induction.Pool(memory)
    tape = induction.suffixes(np.array(x, np.uint16), max(x) + 1, cap, pool, base)
    pos, lcp = [], []
    while tape.blocks:
        p, c = tape.take()
        pos += p.tolist()
        lcp += c.tolist()
    return pos, lcp, pool.spilled


@pytest.mark.parametrize("base,memory", [(1 << 21, 1 << 26), (2, 1 << 26), (10, 300)])
def test_suffix_order_and_common_prefixes(base, memory):
    """In one level, in several, and with nearly all tuples on disk."""
    rng, spilled = random.Random(base), 0
    for _ in range(60):
        k = rng.choice([1, 2, 3, 10, 200])
        x = [rng.randrange(1, k + 1) for _ in range(rng.randint(1, 120))]
        period = rng.randint(1, 8)
        if rng.random() < .5:
            for i in range(period, len(x)):
                if rng.random() < .95:
                    x[i] = x[i - period]
        x.append(0)
        cap = rng.choice([3, 7, 20, 1000])
        pos, lcp, s = suffixes(x, cap, base, memory)
        spilled += s
        assert sorted(pos) == list(range(len(x) - 1))
        for a, b, c in zip(pos, pos[1:], lcp[1:]):
            assert x[a:a + cap] >= x[b:b + cap]
            assert c == next((m for m in range(cap) if x[a + m] != x[b + m]), cap)
    assert (spilled > 0) == (memory < 1 << 20)


def by_force(rows, window):
    """(doc_id, n_bytes, n_removed, n_spans, kept) of rows of texts."""
    starts = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, t in texts:
        for s in range(len(t) - window + 1):
            starts[t[s:s + window]] = starts.get(t[s:s + window], 0) + 1
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - window + 1):
            if starts[t[s:s + window]] > 1:
                gone[s:s + window] = b"\1" * window
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i if i is not None else -1, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out)


def texts(seed):
    rng = random.Random(seed)
    letters = "abcdé日 \n"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [word(n) for n in (10, 25, 40, 70)]
    rows = []
    for i in range(50):
        parts = [word(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), word(rng.randint(0, 9))]
        rows.append((i, "".join(parts)))
    rows += [(100 + k, rows[3][1]) for k in range(5)] + [(200, None), (201, ""), (202, "ab" * 40), (203, "x" * 90), (204, shared[3]), (3, rows[4][1]), (None, shared[2]), (None, shared[2]), (205, word(15) * 4)]
    return rows


@pytest.mark.parametrize("window,grams,bucket,base,chunk", [(20, (5, 12), 1 << 26, 1 << 21, 1 << 19), (20, (4, 10), 60, 50, 1 << 19), (16, (16,), 0, 1 << 21, 1 << 19), (24, (6, 12), 1 << 26, 20, 16)])
def test_repeated_bytes(docs_of, monkeypatch, window, grams, bucket, base, chunk):
    """Plain, with oversize buckets cut again, with windows as buckets, and with texts in chunks."""
    monkeypatch.setattr(induced, "CHUNK", chunk)
    monkeypatch.setattr(induced, "LONGEST", 30)
    rows = texts(window + base)
    got = induced.remove_repeats(docs_of(rows), window, grams=grams, filter_bits=1 << 16, bucket_bytes=bucket, base=base, memory=2000).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == by_force(rows, window)


def test_no_rows(docs_of):
    assert induced.remove_repeats(docs_of([])).collect() == []
    assert [tuple(r) for r in induced.remove_repeats(docs_of([(1, None)])).collect()] == [(1, 0, 0, 0, bytearray())]
