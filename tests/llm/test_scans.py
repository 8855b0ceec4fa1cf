"""Personal data and secrets against plain regular expressions and planted cases."""
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from examlytics.llm import pii, secret_scan

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_pii(t):
    out = [(0, *m.span()) for m in EMAIL.finditer(t)]
    out += [(1, *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in PHONE.finditer(t) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


@pytest.mark.parametrize("alphabet,n", [("a.@b-_é +(1", 60), ("0123. -+()", 80), ("1.2 5a", 60), ("4 0-1", 60)])
def test_strict_forms(alphabet, n):
    rng = random.Random(4)
    for _ in range(5000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, n)))
        assert pii.strict(t) == plain_pii(t), t


def test_strict_forms_in_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1(" * 100_000, "9 " * 150_000, "a." * 150_000 + "@"):
        pii.strict(t)
        pii.loose(t, [])


def test_base_spans_and_edges(docs_of):
    rows = [(1, "é mail a.b@c.de now"), (1, "é mail a.b@c.de now"), (2, None), (3, ""), (None, "ip 1.2.3.4 and 300.1.1.1"), (5, "4111 1111 1111 1111 +1 (555) 123-4567 x")]
    got = pii.personal_data(docs_of(rows)).select("doc_id", pii.joined("base").alias("b")).collect()
    want = [(i, ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in plain_pii(t or ""))) for i, t in rows]
    assert sorted(map(str, [(r.doc_id, r.b) for r in got])) == sorted(map(str, want))
    assert pii.personal_data(docs_of([]).filter(F.lit(False))).count() == 0


def test_contexts_lead_to_unseen_identifiers(docs_of):
    rows = [(i, f"words hotline +1 (555) 123-4{i:03d} more the 12") for i in range(20)]
    rows += [(100 + i, f"text hotline 555 987-6{i:03d} and the 555 987-7{i:03d} end") for i in range(5)]
    rows += [(200 + i, "the quick the slow the end " * 5) for i in range(10)]
    rows += [(300, "run together +1 (555) 123-9999 4111111111111111 end")] + [(310 + i, f"pay with {n} today") for i, n in enumerate(["4111111111111111", "4012888888881881", "5555555555554444"])]
    out = {r.doc_id: r.s for r in pii.personal_data(docs_of(rows)).select("doc_id", pii.joined("spans").alias("s")).collect()}
    for i in range(5):
        t = rows[20 + i][1]
        s = t.index("555 987-6")
        assert out[100 + i] == f"phone:{s}:{s + 12}"  # after "hotline", not after "the"
    assert out[300] == "card:31:47,phone:13:30"
    assert all(out[200 + i] == "" for i in range(10))


def test_contexts_lead_on_until_nothing_new(docs_of):
    words = ["hotline", "dial", "ring", "fax", "mobile", "pager"]
    texts = [f"hotline +1 (555) 123-4{i:03d}" for i in range(25)] + [f"the 555 000-0{i:03d}" for i in range(80)]
    local = {w: [f"555 98{k}-6{i:03d}" for i in range(5)] for k, w in enumerate(words)}
    for w, following in zip(words, [*words[1:], None]):
        texts += [f"{w} {n}" for n in local[w]] + [f"{following} {n}" for n in local[w] for _ in range(5) if following]
    out = {r.doc_id: r.s for r in pii.personal_data(docs_of(list(enumerate(texts)))).select("doc_id", pii.joined("spans").alias("s")).collect()}
    for i, t in enumerate(texts):
        at = t.index(" ") + 1
        assert out[i] == ("" if t.startswith("the ") else f"phone:{at}:{len(t)}"), t


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_secrets(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m.group()) >= 18]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 16])


def test_secret_forms(docs_of):
    rng = random.Random(5)
    bits = ["token", "secret", "PassWord", "api_key", "apikey", "=", ":", " ", "'", '"', "abcdef0123456789", "AKIA", "ABCDEFG0123456789", "é", "\U0001F600", "\n", "x", "deadbeef", "Zm9vYmFyQmF6", "-", "."]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(1500)] + [(None, None), (5, ""), (6, "deadbeefdeadbeef " * 300)]
    got = secret_scan.scan(docs_of(rows)).select("doc_id", "base").collect()
    assert sorted((r.doc_id or -1, [(b.start, b.kind, b.end) for b in r.base]) for r in got) == sorted((i or -1, plain_secrets(t or "")) for i, t in rows)


def test_random_strings_are_told_from_identifiers(docs_of):
    rng = random.Random(8)
    hexa = ["".join(rng.choice("0123456789ABCDEF") for _ in range(40)) for _ in range(60)]
    b64 = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(48)) for _ in range(60)]
    words = "internationalisation configuration Management benchmark response handler document2 chapter3 ErrorCode release2024 testCase".split()
    names = ["_".join(rng.choice(words) for _ in range(3)) + str(rng.randint(1, 99)) for _ in range(120)]
    rows = [(i, f"some text {t} more") for i, t in enumerate(hexa + b64 + names)]
    out = {r.doc_id: len(r.spans) for r in secret_scan.secrets(docs_of(rows)).collect()}
    assert sum(out[i] for i in range(120)) >= 110
    assert sum(out[i] for i in range(120, 240)) == 0


def test_secrets_edges_and_redaction(spark, docs_of):
    rows = [(1, "a token = 'abcdefghijklmnop' b"), (1, "a token = 'abcdefghijklmnop' b"), (None, "x deadbeefdeadbeef"), (3, ""), (4, None)]
    out = secret_scan.secrets(docs_of(rows))
    assert sorted(str((r.doc_id, [tuple(s) for s in r.spans])) for r in out.collect()) == sorted(str((i, plain_secrets(t or ""))) for i, t in rows)
    frame = spark.createDataFrame([("é secret deadbeef x", [(2, 0, 8), (4, 1, 6), (9, 2, 17)])], "t string, s array<struct<start:int,kind:int,end:int>>")
    assert frame.select(secret_scan.redact(F.col("t"), F.col("s"), "#").alias("r")).first().r == "é # # x"
    assert secret_scan.secrets(docs_of([]).filter(F.lit(False))).count() == 0


def test_benjamini_hochberg(spark):
    rng = random.Random(2)
    p = [rng.random() ** rng.choice([1, 1, 6]) for _ in range(800)]
    bins = [min(secret_scan.BINS, math.floor(-20 * math.log10(max(x, 1e-30)))) for x in p]
    frame = spark.createDataFrame([("hex", 1, b) for b in bins], "encoding string, stratum int, bin int")
    limit = secret_scan.not_random(frame, 0.1).first().ruled_out
    upper = sorted(10 ** (-b / 20) for b in bins)
    k = max((i + 1 for i, x in enumerate(upper) if x <= 0.1 * (i + 1) / len(upper)), default=0)
    assert sum(b >= limit for b in bins) == k


def test_secret_scan_plan_is_native(docs_of):
    plan = secret_scan.scan(docs_of([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_share_of_other_strings_among_the_reported(spark):
    """Random strings have uniform p-values; the others sit below one half. At most about the level of them is reported."""
    rng = random.Random(4)
    p = [(True, rng.random()) for _ in range(3000)] + [(False, rng.random() ** 3 / 2) for _ in range(1500)]
    bins = [(r, min(secret_scan.BINS, math.floor(-20 * math.log10(x)))) for r, x in p]
    frame = spark.createDataFrame([("hex", 8, b) for _, b in bins], "encoding string, stratum int, bin int")
    cut = secret_scan.reported(frame, 0.1).first().cut
    kept = [r for r, b in bins if b < cut]
    assert len(kept) > 1500 and kept.count(False) / len(kept) <= 0.15
    # The cut from the definition.
    seen = sum(b < secret_scan.HALF for _, b in bins)
    m = (seen + math.sqrt(seen)) / (1 - 10 ** (-secret_scan.HALF / 20))
    fits = [b + 1 for _, b in bins if (above := sum(x <= b for _, x in bins)) - m * (1 - 10 ** (-(b + 1) / 20)) <= 0.1 * above]
    assert cut == max(fits)


def test_candidates_have_the_symbols_that_carry_the_bits():
    assert math.ceil(secret_scan.LEAST_BITS / 6) == secret_scan.LEAST_SYMBOLS and f"{{{secret_scan.LEAST_SYMBOLS}}}" in secret_scan.CANDIDATE


def test_battery_against_plain_statistics(spark):
    """p-values of the three tests and Fisher's join, computed plainly."""
    import numpy as np

    rng = random.Random(8)
    tokens = ["".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in (14, 32, 40)] + ["aaaaaaaaaaaaaaaa1b", "Zm9vYmFyQmF6cXV4MTIz", "ABCDEFGHIJKLMNOP2345", "abcDEF123ghiJKL456"]
    got = {r.token: r for r in secret_scan.battery(spark.createDataFrame([(t,) for t in tokens], "token string")).collect()}
    tail = lambda z: 1 / (1 + math.exp(1.5976 * max(-12, min(12, z)) + 0.070566 * max(-12, min(12, z)) ** 3))
    for t in tokens:
        symbols = {name: s for name, _, s in secret_scan._ALPHABETS}[got[t].encoding]
        shown = t.lower() if got[t].encoding in ("hex", "base36") else t
        x = np.array([symbols.index(c) for c in shown], float)
        n, k, d = len(x), len(symbols), 6 if got[t].encoding == "base32" else 10
        squares = sum(np.sum(x == v) ** 2 for v in set(x.tolist()))
        df = k - 1
        z_chi = (((squares * k / n - n) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
        low = x < d
        n1, switches = low.sum(), (low[1:] != low[:-1]).sum()
        pairs = 2 * n1 * (n - n1)
        if pairs:
            spread = pairs * (pairs - n) / (n * n * (n - 1))
            p_runs = min(1, 2 * tail(abs((switches - pairs / n) / math.sqrt(spread)))) if spread > 0 else 1.0
        else:
            p_runs = (1 - d / k if n1 == 0 else d / k) ** n
        square = n * (x * x).sum() - x.sum() ** 2
        z_serial = ((n * (x * np.roll(x, -1)).sum() - x.sum() ** 2) / square + 1 / (n - 1)) / (n / ((n - 1) * math.sqrt(n - 2))) if square > 0 else None
        p_serial = min(1, 2 * tail(abs(z_serial))) if z_serial is not None else 0.0
        half = -sum(math.log(max(p, 1e-15)) for p in (tail(z_chi), p_runs, p_serial))
        assert got[t].p == pytest.approx(min(1, math.exp(-half) * (1 + half + half * half / 2)), rel=1e-6)
        assert got[t].symbols == n and got[t].bits == pytest.approx(n * math.log2(k))
