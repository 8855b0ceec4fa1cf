"""Combining one-row aggregates without a join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row(*frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row frames side by side.

    Each input is a global aggregate (exactly one row). The frames are
    stacked with their missing columns as NULL and collapsed with ``max``,
    which picks each column's only non-NULL value; column names must be
    distinct across frames. Types are kept.
    """
    names: list[str] = []
    for f in frames:
        for c in f.columns:
            if c in names:
                raise ValueError(f"column {c!r} appears in two frames")
            names.append(c)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in names])


def grouped_with_distinct(df: DataFrame, keys: list[str], aggs: list, distinct: dict[str, str]) -> DataFrame:
    """``groupBy(keys).agg(*aggs, count(DISTINCT col) AS alias ...)`` planned as separate aggregates.

    With one COUNT(DISTINCT) in a grouped aggregate, Spark first groups by
    (keys + distinct column) and evaluates every other aggregate there, so
    a sketch such as ``percentile_approx`` is built once per (key, distinct
    value) pair. Here each distinct count is a two-level aggregate of its
    own (both partial, map-side), the other measures one aggregate, and the
    small per-key results are joined on the keys (NULL keys match NULL keys).
    """
    out = df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()
    for alias, col in distinct.items():
        d = (df.where(F.col(col).isNotNull()).select(*keys, col).distinct()
             .groupBy(*keys).agg(F.count(F.lit(1)).alias(alias)))
        if not keys:
            out = one_row(out, d) if aggs else d
            continue
        d = d.select(*[F.col(k).alias(f"__d_{k}") for k in keys], alias)
        cond = [out[k].eqNullSafe(d[f"__d_{k}"]) for k in keys]
        out = out.join(d, cond, "left").drop(*[f"__d_{k}" for k in keys]) \
            .withColumn(alias, F.coalesce(F.col(alias), F.lit(0)))
    return out


def weighted_mean(value: str, weight: str) -> Column:
    """``sum(v * w) / sum(w)`` over rows with non-NULL v and w and w > 0; NULL when none remain."""
    ok = F.col(value).isNotNull() & F.col(weight).isNotNull() & (F.col(weight) > 0)
    num = F.sum(F.when(ok, F.col(value).cast("double") * F.col(weight)))
    den = F.sum(F.when(ok, F.col(weight).cast("double")))
    return num / F.nullif(den, F.lit(0.0))
