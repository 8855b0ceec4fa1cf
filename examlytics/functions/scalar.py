"""Scalar Column expressions.

Every function returns a native Catalyst expression (no Python UDF), so it
stays inside whole-stage code generation. Where the source dialect and Spark
disagree on a corner case, the function reproduces the source behaviour and
says which corner it is about.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------
# Classification thresholds and labels used by the views.
# ---------------------------------------------------------------------------
PROFICIENCY_ADVANCED_MIN = 80
PROFICIENCY_INTERMEDIATE_MIN = 50
PROFICIENCY_LEVELS = ("Beginner", "Intermediate", "Advanced")
YEAR_WINDOW = ("2020", "2099")
# Neutral default; callers pass the e-mail domain of their own organization.
INTERNAL_DOMAIN_PATTERN = "corp.example"
DOMAIN_SUFFIX_PATTERN = r"[ _]\d{6,}.*$"
COHORT_YEAR_PATTERN = r"20[0-9]{2}"
# Seed that makes Spark's chained xxhash64 start from seed 0 (XXH64 of this
# long under Spark's seed 42 is 0).
XXH64_SEED_CANCEL = -365884300664092260


# ---------------------------------------------------------------------------
# Percentages and ratios
# ---------------------------------------------------------------------------
def safe_div(n: ColumnOrName, d: ColumnOrName) -> Column:
    """``n / NULLIF(d, 0)``; ANSI division by zero never raises."""
    return _c(n) / F.nullif(_c(d), F.lit(0))


def pct(n: ColumnOrName, d: ColumnOrName) -> Column:
    """``CAST(n AS DOUBLE) / NULLIF(d, 0) * 100`` (unrounded DOUBLE)."""
    return _c(n).cast("double") / F.nullif(_c(d), F.lit(0)) * F.lit(100)


def pct_dec1(n: ColumnOrName, d: ColumnOrName) -> Column:
    """``n * 100.0 / NULLIF(d, 0)`` with the source's DECIMAL scale 1.

    Integer counts in, exact half-up rounding to one decimal: the value is
    ``floor((2000 n + d) / (2 d)) / 10`` computed on integers, so neither a
    binary fraction nor an intermediate decimal scale can round twice. A
    NULL numerator or a zero denominator gives NULL.
    """
    n_ = _c(n).cast("long")
    d_ = F.nullif(_c(d).cast("long"), F.lit(0))
    tenths = _int_div(F.lit(2000) * n_ + d_, F.lit(2) * d_)
    return (tenths.cast("decimal(38,0)") / F.lit(10)).cast("decimal(38,1)")


def _int_div(a: Column, b: Column) -> Column:
    """Floor division of non-negative longs, exact (decimal, not double)."""
    return F.floor(a.cast("decimal(38,0)") / b.cast("decimal(38,0)")).cast("long")


def div_dec1(x: ColumnOrName, k: int) -> Column:
    """``x / k.0`` rounded half-up (away from zero) to DECIMAL scale 1."""
    x_ = _c(x).cast("long")
    mag = _int_div(F.lit(20) * F.abs(x_) + F.lit(k), F.lit(2 * k))
    signed = F.when(x_ < 0, -mag).otherwise(mag)
    return (signed.cast("decimal(38,0)") / F.lit(10)).cast("decimal(38,1)")


def integrity_risk(violation_count: ColumnOrName, violation_seconds: ColumnOrName) -> Column:
    """Weighted integrity score ``2 * count + seconds / 60`` (row or aggregate)."""
    return _c(violation_count) * F.lit(2.0) + _c(violation_seconds) / F.lit(60.0)


# ---------------------------------------------------------------------------
# Text
# ---------------------------------------------------------------------------
def trim_ws(x: ColumnOrName) -> Column:
    """TRIM that strips all leading/trailing whitespace, tabs included."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


def key_norm(x: ColumnOrName, suffix_pattern: str = DOMAIN_SUFFIX_PATTERN) -> Column:
    """Normalised lookup key: drop a trailing id/epoch suffix, trim, lower."""
    return F.lower(trim_ws(F.regexp_replace(_c(x), suffix_pattern, "")))


def title_case(x: ColumnOrName) -> Column:
    """Python ``str.title``: upper after every non-letter, lower elsewhere.

    Splits the text into alternating letter / non-letter runs and
    capitalises each run, so ``o'neil john-doe a1b`` -> ``O'Neil John-Doe A1B``
    (``initcap`` only capitalises after spaces). Known difference: a run that
    starts with a character whose title form is not its upper form (``ß``,
    some ligatures) gets the JVM upper form (``SS``), Python gives ``Ss``.
    """
    runs = F.regexp_extract_all(_c(x), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    cap = F.transform(runs, lambda p: F.concat(F.upper(F.substring(p, 1, 1)),
                                               F.lower(F.substring(p, 2, 1 << 30))))
    return F.when(_c(x).isNotNull(), F.array_join(cap, ""))


def local_part(email: ColumnOrName) -> Column:
    """Text before the first '@' (whole text when there is none)."""
    return F.substring_index(_c(email), "@", 1)


def candidate_name(email: ColumnOrName) -> Column:
    """Gold-layer name: local part, dots to spaces, Python title case."""
    return title_case(F.replace(local_part(email), F.lit("."), F.lit(" ")))


def sql_candidate_name(email: ColumnOrName) -> Column:
    """View-layer name: ``replace(substr(e, 1, strpos(e,'@')-1), '.', ' ')``.

    No '@' gives '' (length -1), unlike :func:`local_part`.
    """
    e = _c(email)
    return F.replace(e.substr(F.lit(1), F.instr(e, "@") - 1), F.lit("."), F.lit(" "))


def email_domain(email: ColumnOrName) -> Column:
    """``substr(e, strpos(e,'@')+1)``: whole e-mail when there is no '@'."""
    e = _c(email)
    return e.substr(F.instr(e, "@") + 1, F.lit(1 << 30))


def nonblank(x: ColumnOrName) -> Column:
    c = _c(x)
    return c.isNotNull() & (c != F.lit(""))


# ---------------------------------------------------------------------------
# Dates held as ISO text
# ---------------------------------------------------------------------------
def iso_to_timestamp(x: ColumnOrName) -> Column:
    """First 19 characters, 'T' to space, TRY cast to a zone-less timestamp."""
    text = F.replace(F.substring(_c(x), 1, 19), F.lit("T"), F.lit(" "))
    return text.try_cast("timestamp_ntz")


def year_text(x: ColumnOrName) -> Column:
    return F.substring(_c(x), 1, 4)


def month_text(x: ColumnOrName) -> Column:
    return F.substring(_c(x), 1, 7)


def quarter_label(x: ColumnOrName) -> Column:
    """'<yyyy>-Q<n>' from ISO text; any month outside 01-09 falls to Q4."""
    c = _c(x)
    mm = F.substring(c, 6, 2)
    yyyy = F.substring(c, 1, 4)
    q = (F.when(mm.isin("01", "02", "03"), F.lit("-Q1"))
         .when(mm.isin("04", "05", "06"), F.lit("-Q2"))
         .when(mm.isin("07", "08", "09"), F.lit("-Q3"))
         .otherwise(F.lit("-Q4")))
    return F.concat(yyyy, q)


def diff_seconds(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Complete seconds from a to b."""
    return F.timestamp_diff("SECOND", _c(a), _c(b))


def diff_hours(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Complete hours from a to b (not hour boundaries crossed)."""
    return F.timestamp_diff("HOUR", _c(a), _c(b))


def diff_days(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Complete days from a to b (23:00 -> 01:00 next day is 0)."""
    return F.timestamp_diff("DAY", _c(a), _c(b))


# ---------------------------------------------------------------------------
# Classifications (CASE ... ELSE keeps NULL inputs in the ELSE bucket)
# ---------------------------------------------------------------------------
def proficiency_level(score: ColumnOrName, advanced: float = PROFICIENCY_ADVANCED_MIN,
                      intermediate: float = PROFICIENCY_INTERMEDIATE_MIN) -> Column:
    s = _c(score)
    return (F.when(s >= F.lit(advanced), F.lit("Advanced"))
            .when(s >= F.lit(intermediate), F.lit("Intermediate"))
            .otherwise(F.lit("Beginner")))


def violation_severity(count: ColumnOrName) -> Column:
    c = _c(count)
    return (F.when(c == 0, F.lit("No Violations"))
            .when(c.between(1, 5), F.lit("Low Violations"))
            .otherwise(F.lit("High Violations")))


def normalise_pass(status: ColumnOrName) -> Column:
    return F.when(F.upper(_c(status)) == F.lit("PASS"), F.lit("passed")).otherwise(F.lit("failed"))


def candidate_source(domain: ColumnOrName, internal_pattern: str = INTERNAL_DOMAIN_PATTERN) -> Column:
    return (F.when(F.lower(_c(domain)).contains(internal_pattern), F.lit("Internal"))
            .otherwise(F.lit("External")))


def integrity_label(score: ColumnOrName, high: float = 10, medium: float = 5) -> Column:
    s = _c(score)
    return (F.when(s > F.lit(high), F.lit("High"))
            .when(s > F.lit(medium), F.lit("Medium"))
            .otherwise(F.lit("Low")))


def retake_direction(delta: ColumnOrName, tolerance: float = 0.001) -> Column:
    """Bins (-inf, -tol] Declined, (-tol, tol] Same, (tol, inf) Improved; NULL stays NULL."""
    d = _c(delta)
    return (F.when(d <= F.lit(-tolerance), F.lit("Declined"))
            .when(d <= F.lit(tolerance), F.lit("Same"))
            .when(d > F.lit(tolerance), F.lit("Improved")))


def bool_text(x: ColumnOrName) -> Column:
    """'true'/'false' text (any case) to boolean, anything else False."""
    return F.coalesce(F.lower(trim_ws(_c(x).cast("string"))) == F.lit("true"), F.lit(False))


def question_label(text: ColumnOrName, title: ColumnOrName, empty: str = "(no text)") -> Column:
    return F.coalesce(F.nullif(trim_ws(_c(text)), F.lit("")),
                      F.nullif(trim_ws(_c(title)), F.lit("")), F.lit(empty))


# ---------------------------------------------------------------------------
# Deterministic hash buckets
# ---------------------------------------------------------------------------
def xxh64(x: ColumnOrName) -> Column:
    """Signed XXH64 (seed 0) of the UTF-8 bytes; NULL in, NULL out."""
    c = _c(x)
    return F.when(c.isNotNull(), F.xxhash64(F.lit(XXH64_SEED_CANCEL).cast("long"), c.cast("string")))


def md5_60(x: ColumnOrName) -> Column:
    """First 60 bits of MD5 as a non-negative long (portable across engines)."""
    c = _c(x)
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 15), 16, 10).cast("long")


def hash_bucket(x: ColumnOrName, labels: Sequence[str], algo: str = "xxh64") -> Column:
    """``labels[pmod(hash(x), n)]``; NULL when x is NULL."""
    h = xxh64(x) if algo == "xxh64" else md5_60(x) if algo == "md5" else None
    if h is None:
        raise ValueError(f"unknown hash algo {algo!r}")
    idx = (F.pmod(h, F.lit(len(labels))) + F.lit(1)).cast("int")
    # Guarded explicitly: element_at over a literal array with a NULL index
    # was seen to return the last element instead of NULL.
    return F.when(idx.isNotNull(), F.element_at(F.array(*[F.lit(v) for v in labels]), idx))
