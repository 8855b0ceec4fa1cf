"""Secret scans by a battery of randomness tests, in DataFrame expressions only.

Strict forms (assignments, access keys, long hexadecimal strings) are found in
every text and always stay. Further candidates are long strings over the
letters, digits and signs of the usual encodings that mix digits with letters
or switch case inside. For each the encoding is inferred from its symbols
(hexadecimal, base 32, 36, 62 or 64) and three tests ask whether it could be
uniformly random over that alphabet:

* chi-squared on the symbol counts (Wilson-Hilferty approximation),
* runs of digits and letters (Wald-Wolfowitz),
* lag-1 serial correlation of the symbol numbers.

Fisher's method joins the three p-values. Short strings have little power, so
decisions are made within strata of encoding and length, and two errors are
bounded there at level ``FDR``. Random strings that are dismissed: the
Benjamini-Hochberg procedure, with "is random" as null, rules strings out.
Strings that are reported and not random: the p-values of random strings are
uniform, so those above one half tell how many random strings the stratum has;
the cut is put where all others would make up at most that share of what is
reported. (Both are estimates where a stratum holds few strings.) Strings past
both cuts that carry at least ``LEAST_BITS`` bits are reported; a candidate has
at least the symbols that can carry them.

Scale: scanning is narrow. The procedure needs ranks of p-values: they are
counted in a fixed number of bins per stratum (a p-value counts as its bin's
upper end, which is conservative), so its tables have a bounded number of rows
whatever the input. Only candidates of accepted strata are joined back to their
documents.

Edge cases: a null text is empty; rows that repeat or lack a doc_id give one
row each; further columns are ignored. Offsets are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from examlytics.llm.store import keep

KINDS = ("assign", "access", "hex")
ADDED = "random"

# Fixed values of the strict forms.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # the whole run or nothing, as with + and a length check
HEX = r"[0-9a-f]{16,}"

FDR = 0.05
LEAST_BITS = 80.0
LEAST_SYMBOLS = 14  # of base 64 carry LEAST_BITS
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_-]{14})(?=[A-Za-z+/_-]*(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9+/_-]+={0,2}"
BINS = 400  # of -log10 p, a twentieth each
HALF = 6  # the bins below hold p above one half

_SPANS = "array<struct<start:int,kind:int,end:int>>"
_ALPHABETS = (
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("base32", r"^[A-Z2-7]+$", "234567ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base36", r"^(?:[a-z0-9]+|[A-Z0-9]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base62", r"^[A-Za-z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", r"^.+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/"),
)


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _located(text: Column, matches: Column, pattern: str, kind: int) -> Column:
    """Spans of all matches: the gaps between them are what a split leaves."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    step = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), F.transform(matches, F.length), lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["g"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), (begin + x["m"]).alias("end"))
        return F.struct((begin + x["m"]).alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    found = F.aggregate(step, start, add, lambda acc: acc["spans"])
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast(_SPANS))


def scan(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Per row: base spans, and candidates (start, end, token) that touch none of them (``carry``: and the whole row)."""
    text = F.col("text")
    whole = [F.struct(*docs.columns).alias("row")] if carry else []
    own = ["row"] if carry else []
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(text.cast("string"), F.lit("")).alias("text"), *whole)
    none = F.array().cast("array<string>")
    signs = text.contains("=") | text.contains(":")
    found = rows.select(
        *own, "doc_id", "text", F.xxhash64("doc_id", "text").alias("version"),
        F.when(signs, _matches(text, ASSIGN)).otherwise(none).alias("assign"),
        F.when(text.contains("AKIA"), _matches(text, ACCESS)).otherwise(none).alias("access"),
        _matches(text, HEX).alias("hex"), _matches(text, CANDIDATE).alias("candidate"))
    # A match counts only if its value is long enough; the others still take up their text.
    values = F.when(F.size("assign") > 0, _matches(text, ASSIGN, 1)).otherwise(none)
    long = F.filter(F.arrays_zip(_located(text, F.col("assign"), ASSIGN, 0).alias("span"), values.alias("value")), lambda x: F.length(x["value"]) >= 12)
    spans = found.select(
        *own, "doc_id", "version", "candidate", F.transform(long, lambda x: x["span"]).alias("a"), _located(text, F.col("access"), ACCESS, 1).alias("k"),
        _located(text, F.col("hex"), HEX, 2).alias("h"), _located(text, F.col("candidate"), CANDIDATE, 3).alias("c"))
    base = spans.select(*own, "doc_id", "version", F.array_sort(F.concat("a", "k", "h")).alias("base"), F.arrays_zip(F.col("c").alias("span"), F.col("candidate").alias("token")).alias("c"))
    free = F.filter("c", lambda x: ~F.exists("base", lambda b: (b["start"] < x["span"]["end"]) & (b["end"] > x["span"]["start"])))
    return base.select(*own, "doc_id", "version", "base", F.transform(free, lambda x: F.struct(x["span"]["start"].alias("start"), x["span"]["end"].alias("end"), x["token"].alias("token"))).alias("candidates"))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) for a normal Z (logistic approximation, error below 2e-4)."""
    c = F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))
    return 1 / (1 + F.exp(1.5976 * c + 0.070566 * c * c * c))


def battery(tokens: DataFrame) -> DataFrame:
    """Add encoding, bits and p (joint p-value of the three tests) to rows with a ``token``."""
    body = F.translate(F.rtrim(F.col("token"), F.lit("=")), "-_", "+/")
    kind, alphabet = F.lit(None).cast("string"), F.lit("")
    for name, pattern, symbols in reversed(_ALPHABETS):
        kind = F.when(F.col("body").rlike(pattern), name).otherwise(kind)
        alphabet = F.when(F.col("body").rlike(pattern), symbols).otherwise(alphabet)
    tokens = tokens.select(F.struct("*").alias("row"), "token")
    rows = tokens.withColumn("body", body).filter(F.length("body") > 2).withColumn("encoding", kind).withColumn("alphabet", alphabet)
    shown = F.when(F.col("encoding").isin("hex", "base36"), F.lower("body")).otherwise(F.col("body"))
    rows = rows.withColumn("x", F.transform(F.split(shown, ""), lambda c: F.instr(F.col("alphabet"), c) - 1)).withColumn("x", F.filter("x", lambda v: v >= 0))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    digits = F.when(F.col("encoding") == "base32", 6).otherwise(10)
    rows = rows.select(
        "row", "encoding", F.size("x").cast("double").alias("n"), F.length("alphabet").cast("double").alias("k"), digits.cast("double").alias("d"),
        total(F.transform(F.array_distinct("x"), lambda v: F.pow(F.size(F.filter("x", lambda w: w == v)), F.lit(2.0)))).alias("squares"),
        total(F.transform("x", lambda v: (v < digits).cast("double"))).alias("n1"),
        total(F.zip_with(F.slice("x", 1, F.size("x") - 1), F.slice("x", 2, F.size("x") - 1), lambda a, b: ((a < digits) != (b < digits)).cast("double"))).alias("switches"),
        total(F.transform("x", lambda v: v.cast("double"))).alias("s1"), total(F.transform("x", lambda v: (v * v).cast("double"))).alias("s2"),
        total(F.zip_with("x", F.concat(F.slice("x", 2, F.size("x")), F.slice("x", 1, 1)), lambda a, b: (a * b).cast("double"))).alias("s11"))
    n, k, n1 = F.col("n"), F.col("k"), F.col("n1")
    n2, df = n - n1, k - 1
    ratio = (F.col("squares") * k / n - n) / df
    z_chi = (F.pow(ratio, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    pairs = 2 * n1 * n2
    spread = pairs * (pairs - n) / (n * n * (n - 1))
    z_runs = F.when((pairs > 0) & (spread > 0), (F.col("switches") - pairs / n) / F.sqrt(spread))
    alone = F.pow(F.when(n1 == 0, 1 - F.col("d") / k).otherwise(F.col("d") / k), n)  # no digit, or nothing else
    square = n * F.col("s2") - F.col("s1") * F.col("s1")
    z_serial = F.when(square > 0, ((n * F.col("s11") - F.col("s1") * F.col("s1")) / square + 1 / (n - 1)) / (n / ((n - 1) * F.sqrt(n - 2))))
    two_sided = lambda z: F.least(F.lit(1.0), 2 * _upper_tail(F.abs(z)))
    p_runs = F.when(z_runs.isNotNull(), two_sided(z_runs)).when(pairs > 0, F.lit(1.0)).otherwise(alone)
    p_serial = F.coalesce(two_sided(z_serial), F.lit(0.0))
    floor = lambda p: F.greatest(p, F.lit(1e-15))
    half = -(F.log(floor(_upper_tail(z_chi))) + F.log(floor(p_runs)) + F.log(floor(p_serial)))
    tested = rows.withColumn("half", half).withColumn("p", F.exp(-F.col("half")) * (1 + F.col("half") + F.col("half") * F.col("half") / 2))
    return tested.select("row.*", "encoding", n.cast("int").alias("symbols"), (n * F.log2(k)).alias("bits"), F.least(F.col("p"), F.lit(1.0)).alias("p"))


def not_random(tested: DataFrame, fdr: float = FDR) -> DataFrame:
    """(encoding, stratum, ruled_out): the p-value bin from which Benjamini-Hochberg rules strings out, per stratum."""
    counts = tested.groupBy("encoding", "stratum", "bin").agg(F.count("*").alias("c"))  # BINS rows per stratum at most
    lower = Window.partitionBy("encoding", "stratum").orderBy(F.desc("bin"))
    whole = Window.partitionBy("encoding", "stratum")
    ranked = counts.withColumn("rank", F.sum("c").over(lower)).withColumn("m", F.sum("c").over(whole))
    upper_p = F.pow(F.lit(10.0), -F.col("bin") / 20)
    return ranked.filter(upper_p * F.col("m") <= fdr * F.col("rank")).groupBy("encoding", "stratum").agg(F.min("bin").alias("ruled_out"))


def reported(tested: DataFrame, fdr: float = FDR) -> DataFrame:
    """(encoding, stratum, cut): the p-value bin below which at most the share ``fdr`` of the strings is not random, per stratum.

    ``m`` random strings are expected to have m * (1 - p) p-values above p; what
    is above p beyond that number counts as not random. ``m`` is taken one
    standard error above its estimate, so that chance alone cuts little.
    """
    counts = tested.groupBy("encoding", "stratum", "bin").agg(F.count("*").alias("c"))  # BINS rows per stratum at most
    upper = Window.partitionBy("encoding", "stratum").orderBy("bin")
    whole = Window.partitionBy("encoding", "stratum")
    share = lambda bins: 1 - F.pow(F.lit(10.0), -bins / 20)
    seen = F.sum(F.when(F.col("bin") < HALF, F.col("c")).otherwise(0)).over(whole)
    random = (seen + F.sqrt(seen)) / share(F.lit(HALF))
    ranked = counts.withColumn("random", random).withColumn("above", F.sum("c").over(upper)).withColumn("next", F.col("bin") + 1)
    return ranked.filter(F.col("above") - F.col("random") * share(F.col("next")) <= fdr * F.col("above")).groupBy("encoding", "stratum").agg(F.max("next").alias("cut"))


def random_strings(found: DataFrame, fdr: float = FDR, least_bits: float = LEAST_BITS) -> DataFrame:
    """(version, added): the candidates of scanned rows that the tests take for secrets."""
    candidates = found.select("version", F.explode("candidates").alias("c")).select("version", "c.start", "c.end", "c.token").distinct()
    bin_of = F.least(F.lit(BINS), F.floor(-20 * F.log10(F.greatest(F.col("p"), F.lit(1e-30))))).cast("int")
    tested = keep(battery(candidates).withColumn("bin", bin_of).withColumn("stratum", F.floor(F.log2("symbols") * 2).cast("int")), "randomness")
    strata = ["encoding", "stratum"]
    limits = reported(tested, fdr).join(not_random(tested, fdr), strata, "left").select(*strata, F.least("cut", F.coalesce("ruled_out", "cut")).alias("limit"))
    passed = tested.join(limits, strata).filter((F.col("bin") < F.col("limit")) & (F.col("bits") >= least_bits))
    return passed.groupBy("version").agg(F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("kind"), "end")).alias("added"))


def _with_added(rows: DataFrame, added: DataFrame) -> DataFrame:
    """Add ``spans``: base and added ones, by start, then kind. Rows without candidates do not take part in the join."""
    joined = rows.filter(F.size("candidates") > 0).join(added, "version", "left").select(
        *rows.columns, F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(_SPANS)))).alias("spans"))
    return rows.filter(F.size("candidates") == 0).withColumn("spans", F.col("base")).unionByName(joined)


def secrets(docs: DataFrame, fdr: float = FDR, least_bits: float = LEAST_BITS) -> DataFrame:
    """One row per document: doc_id, version, base spans and all spans (start, kind, end), by start, then kind."""
    found = keep(scan(docs), "secret-spans")
    return _with_added(found, random_strings(found, fdr, least_bits)).select("doc_id", "version", "base", "spans")


def redacted(docs: DataFrame, mark: str, fdr: float = FDR, least_bits: float = LEAST_BITS) -> DataFrame:
    """The rows of ``docs`` with every secret in ``text`` replaced by the mark, and ``n_chars`` to match.

    The texts are scanned where they lie; only rows with candidates shuffle.
    """
    added = keep(random_strings(keep(scan(docs), "secret-spans"), fdr, least_bits), "random-strings")
    rows = _with_added(scan(docs, carry=True), added)
    clean = redact(F.col("row.text"), F.col("spans"), mark)
    new = {"text": clean, "n_chars": F.length(clean)}
    old = lambda c: F.col("row").getField(c)
    return rows.select(*[
        F.when(F.size("spans") == 0, old(c)).otherwise(new[c].cast(docs.schema[c].dataType)).alias(c) if c in new else old(c).alias(c) for c in docs.columns])


def redact(text: Column, spans: Column, mark: str) -> Column:
    """The text with every span (sorted by start; they may overlap) replaced by the mark."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(acc: Column, x: Column) -> Column:
        new = x["start"] >= acc["at"]
        before = F.when(new, F.concat(F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["out"], before).alias("out"))

    return F.aggregate(spans, start, cut, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
