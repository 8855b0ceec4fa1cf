"""Sequence numbers and rankings (W2-W12) that hold no whole key in one task.

Rows are cut into slices by an order-preserving number made from the ordering
value; a window works within (slice, key), and the totals of the slices, at
most one row per slice and key, carry the counts over from slice to slice. The
slice bounds are approximate quantiles of the data, taken by a scalar subquery
of the same plan: nothing runs before the result is asked for, and a narrow
cluster of values is spread as well as a wide one. Bounds only affect balance,
never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numeric_image(df: DataFrame, col: str) -> Column:
    """A DOUBLE that never decreases as ``col`` increases (text: its first six bytes)."""
    t, c = dict(df.dtypes)[col], F.col(col)
    if t.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if t == "date":
        return F.unix_date(c).cast("double")
    if t == "boolean":
        return c.cast("int").cast("double")
    if t == "string":
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal"):
        return c.cast("double")
    raise TypeError(f"no order-preserving number for {col}: {t}")


def _parts(df: DataFrame, parts: int | None) -> int:
    """Number of slices: explicit, else the session's shuffle partitions."""
    return max(1, parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def _with_slice(df: DataFrame, image: str, parts: int) -> DataFrame:
    """Replace ``image`` by ``__slice``: the slice (0 to ``parts`` - 1) of its value; NULLs go to slice ``parts``."""
    if parts == 1:
        return df.withColumn("__slice", F.lit(0)).drop(image)
    probs = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    bounds = df.agg(F.sort_array(F.array_distinct(F.percentile_approx(image, probs, 10000)))).scalar()
    # Bounds below the value by binary search; a place past the end reads as NULL, which is not below.
    v, out = F.col(image), df.withColumn("__bounds", bounds).withColumn("__place", F.lit(0))
    for step in (1 << i for i in reversed(range((parts - 1).bit_length()))):
        tried = F.get("__bounds", F.col("__place") + (step - 1))
        out = out.withColumn("__place", F.when(tried < v, F.col("__place") + step).otherwise(F.col("__place")))
    return out.withColumn("__slice", F.when(v.isNull(), F.lit(parts)).otherwise(F.col("__place"))).drop("__bounds", "__place", image)


def _sentinel(dtype: str) -> Column:
    """A non-NULL value of a type, to stand beside an is-NULL flag."""
    if dtype == "string":
        return F.lit("")
    if dtype.startswith("timestamp") or dtype == "date":
        return F.lit(0).cast("timestamp").cast(dtype)
    if dtype == "boolean":
        return F.lit(False)
    return F.lit(0).cast(dtype)


def _null_free(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Key columns without NULLs (flag and value), so grouping, windows and joins share one partitioning."""
    types, names = dict(df.dtypes), []
    for i, k in enumerate(keys):
        df = df.withColumn(f"__n{i}", F.col(k).isNull()).withColumn(f"__k{i}", F.coalesce(F.col(k), _sentinel(types[k])))
        names += [f"__n{i}", f"__k{i}"]
    return df, names


def null_last_key(cols: Sequence[str], df: DataFrame) -> Column:
    """A NULL-free struct ordering rows by ``cols`` ascending with NULLs last."""
    types = dict(df.dtypes)
    fields = []
    for i, c in enumerate(cols):
        fields += [F.col(c).isNull().alias(f"n{i}"), F.coalesce(F.col(c), _sentinel(types[c])).alias(f"v{i}")]
    return F.struct(*fields)


def value_ranks(df: DataFrame, value: str, partition: Sequence[str] = (), descending: bool = True, parts: int | None = None) -> DataFrame:
    """One row per distinct non-NULL value and key: ``rank_min``, ``ties`` and ``n`` (non-NULL rows of the key).

    Equal values are counted first (map-side), so a value that many rows
    share is one row from then on.
    """
    keys = list(partition)
    v = F.col(value)
    vals = df.where(v.isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("ties"))
    vals, names = _null_free(vals.withColumn("__b", numeric_image(vals, value)), keys)
    sliced = _with_slice(vals, "__b", _parts(df, parts))
    if descending:
        sliced = sliced.withColumn("__slice", -F.col("__slice"))
    group = ["__slice", *names]
    run = F.sum("ties").over(Window.partitionBy(*group).orderBy(v.desc() if descending else v.asc())
                             .rowsBetween(Window.unboundedPreceding, -1))
    local = sliced.withColumn("__before", F.coalesce(run, F.lit(0)))
    totals = sliced.groupBy(*group).agg(F.sum("ties").alias("__tot"))
    earlier = Window.partitionBy(*names).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, F.coalesce(F.sum("__tot").over(earlier), F.lit(0)).alias("__off"),
                            F.sum("__tot").over(Window.partitionBy(*names)).alias("n"))
    return local.join(offsets, group).select(*keys, value, (F.col("__off") + F.col("__before") + 1).alias("rank_min"), "ties", "n")


def rank_over(df: DataFrame, value: str, partition: Sequence[str] = (), descending: bool = True,
              parts: int | None = None, out_prefix: str = "") -> DataFrame:
    """Rank rows by ``value`` within ``partition`` without a whole-key window.

    Adds ``{prefix}rank_min`` (RANK(): 1 + rows strictly before), ``{prefix}ties``
    (rows with the same value) and ``{prefix}n`` (non-NULL rows in the
    partition key). NULL values get NULL for all three; NULL partition keys
    form their own group (SQL PARTITION BY semantics).
    """
    keys = list(partition)
    ranks = value_ranks(df, value, keys, descending, parts).select(
        *[F.col(c).alias(f"__k_{c}") for c in keys], F.col(value).alias("__k_v"),
        *[F.col(c).alias(out_prefix + c) for c in ("rank_min", "ties", "n")])
    cond = [df[c].eqNullSafe(ranks[f"__k_{c}"]) for c in keys] + [df[value] == ranks["__k_v"]]
    return df.join(ranks, cond, "left").drop(*[f"__k_{c}" for c in keys], "__k_v")


def sequence_over(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "seq",
                  prev: Sequence[str] = (), prev_prefix: str = "prev_", parts: int | None = None) -> DataFrame:
    """Skew-safe ``row_number()`` (and ``lag`` of ``prev`` columns) per ``keys`` ordered by ``order`` (NULLs last).

    Same result as a window partitioned by ``keys`` (NULL keys form their
    own group) when ``order`` is unique within a key. The rows are shuffled
    once, by (slice of the first ordering column, keys); the number of rows of
    earlier slices, and the last row of the slice before, come from the slice
    totals, which join on the same columns.
    """
    tmp, names = _null_free(df.withColumn("__b", numeric_image(df, order[0])), keys)
    tmp = _with_slice(tmp, "__b", _parts(df, parts))
    group = ["__slice", *names]
    w = Window.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    carried = F.struct(F.lit(1).alias("__row"), *[F.col(c) for c in prev])
    local = tmp.select("*", F.row_number().over(w).alias("__rn"), F.lag(carried).over(w).alias("__lag"))
    totals = tmp.groupBy(*group).agg(F.count(F.lit(1)).alias("__cnt"), F.max_by(carried, null_last_key(order, df)).alias("__last"))
    by_slice = Window.partitionBy(*names).orderBy("__slice")
    offsets = totals.select(
        *group, F.coalesce(F.sum("__cnt").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"),
        F.lag("__last").over(by_slice).alias("__before"))
    joined = local.join(offsets, group)
    last = F.when(F.col("__rn") == 1, F.col("__before")).otherwise(F.col("__lag"))
    return joined.select(*df.columns, (F.col("__off") + F.col("__rn")).alias(out),
                         *[last[c].alias(prev_prefix + c) for c in prev])


def previous_by_number(df: DataFrame, keys: Sequence[str], number: str, cols: Sequence[str],
                       prefix: str = "prev_") -> DataFrame:
    """``lag`` by a dense per-key sequence number, as an equi-join on (keys, number - 1)."""
    p = df.select(*[F.col(k).alias(f"__p_{k}") for k in keys], (F.col(number) + 1).alias("__p_seq"),
                  *[F.col(c).alias(prefix + c) for c in cols])
    cond = [df[k].eqNullSafe(p[f"__p_{k}"]) for k in keys] + [df[number] == p["__p_seq"]]
    return df.join(p, cond, "left").drop(*[f"__p_{k}" for k in keys], "__p_seq")


def percent_rank_asc(rank_desc_min: Column, ties: Column, n: Column) -> Column:
    """SQL PERCENT_RANK() ascending from a descending min-rank: (rank_asc - 1) / (n - 1)."""
    below = n - (rank_desc_min - 1) - ties
    return F.when(n > 1, below.cast("double") / (n - 1).cast("double")).when(n == 1, F.lit(0.0))


def pct_rank_avg(rank_desc_min: Column, ties: Column, n: Column) -> Column:
    """Pandas ``rank(pct=True)`` (ascending, average ties) from a descending min-rank."""
    below = n - (rank_desc_min - 1) - ties
    avg_rank = below.cast("double") + (ties.cast("double") + F.lit(1.0)) / F.lit(2.0)
    return avg_rank / n.cast("double")


def quantiles_of(ranks: DataFrame, value: str, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Exact linear-interpolated quantiles per key from ascending :func:`value_ranks`: two order statistics each."""
    last = F.col("rank_min") + F.col("ties") - 1
    parts, out = [], []
    for i, (name, p) in enumerate(probs.items()):
        at = (F.col("n") - 1) * F.lit(p) + 1
        for side, k in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            parts.append(F.max(F.when((F.col("rank_min") <= k) & (last >= k), F.col(value))).alias(f"__{side}{i}"))
        frac = (F.col("__n") - 1) * F.lit(p) - F.floor((F.col("__n") - 1) * F.lit(p))
        out.append((F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * frac).alias(name))
    return ranks.groupBy(*keys).agg(*parts, F.max("n").alias("__n")).select(*keys, *out)


def exact_quantiles(df: DataFrame, value: str, keys: Sequence[str], probs: dict[str, float], parts: int | None = None) -> DataFrame:
    """Exact quantiles per key without a counter per distinct value or a whole key in one task."""
    return quantiles_of(value_ranks(df.select(*keys, value), value, keys, descending=False, parts=parts), value, keys, probs)


def exact_median(df: DataFrame, value: str, parts: int | None = None) -> DataFrame:
    """Exact (interpolated) median of ``value`` as a one-row frame."""
    return exact_quantiles(df, value, [], {"median": 0.5}, parts)
