"""Dashboard slicers, option lists, thresholds, top-N and fixed orderings
(F4, F5, F8, L2, L3)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType


def apply_slicers(df: DataFrame, **selections: Iterable | None) -> DataFrame:
    """keep rows whose column value is in the selected list.

    An empty or None selection means "all"; a selection on a column the
    frame does not have is skipped. Predicates reach the scan when the
    column comes straight from a file.
    """
    for col, values in selections.items():
        vals = list(values) if values is not None else []
        if not vals or col not in df.columns:
            continue
        df = df.where(F.col(col).isin(vals))
    return df


def slicer_options(df: DataFrame, col: str, **upstream: Iterable | None) -> DataFrame:
    """sorted distinct non-blank values of ``col`` given upstream selections
    (cascading: each slicer's options depend on the ones before it)."""
    pool = apply_slicers(df, **upstream)
    c = F.col(col)
    return (pool.where(c.isNotNull() & (c.cast("string") != "")).select(c).distinct()
            .orderBy(c.asc()))


def cascading_options(df: DataFrame, chain: Sequence[str], **selections: Iterable | None) -> DataFrame:
    """F5 for a whole chain of slicers from one scan: (slicer, value, rows, rows_under_others).

    ``rows`` counts a value's rows under the selections before it in the chain
    (only values that have some are options), ``rows_under_others`` those under
    all selections but its own. Rows are first counted per combination of
    values; each combination then carries one bit per selection it meets, and
    a mask per slicer tells which counts it enters.
    """
    combos = df.groupBy(*chain).agg(F.count(F.lit(1)).alias("__n"))
    chosen = [list(selections.get(c) or []) for c in chain]
    bits = sum((F.when(F.col(c).isin(v) if v else F.lit(True), F.lit(1 << i)).otherwise(F.lit(0)) for i, (c, v) in enumerate(zip(chain, chosen, strict=True))), F.lit(0))
    every = (1 << len(chain)) - 1
    entries = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("slicer"), F.col(c).cast("string").alias("value"), F.lit((1 << i) - 1).alias("before"),
                                 F.lit(every ^ (1 << i)).alias("others")) for i, c in enumerate(chain)])
    rows = combos.withColumn("__bits", bits).select("__n", "__bits", F.explode(entries).alias("e")).where(F.col("e.value").isNotNull() & (F.col("e.value") != ""))
    under = lambda mask: F.sum(F.when(F.col("__bits").bitwiseAND(F.col(mask)) == F.col(mask), F.col("__n")).otherwise(F.lit(0)))
    return (rows.groupBy("e.slicer", "e.value").agg(under("e.before").alias("rows"), under("e.others").alias("rows_under_others"))
            .where(F.col("rows") > 0).select("slicer", "value", "rows", "rows_under_others"))


def min_group_size(df: DataFrame, count_col: str, minimum: int) -> DataFrame:
    """F8: post-aggregation threshold."""
    return df.where(F.col(count_col) >= minimum)


def top_n(df: DataFrame, n: int, order: Sequence[Column], tiebreak: Sequence[str] = ()) -> DataFrame:
    """L2: first ``n`` rows by ``order`` (+ deterministic tiebreak).

    Planned as TakeOrderedAndProject: each task keeps its own top ``n``,
    only ``n`` rows per task reach the final merge.
    """
    return df.orderBy(*order, *[F.col(c).asc_nulls_last() for c in tiebreak]).limit(n)


def fixed_order(spark: SparkSession, df: DataFrame, col: str, values: Sequence[str],
                order_col: str = "sort_order") -> DataFrame:
    """L3: keep only the listed categories, tagged with their position.

    A reindex to a fixed category list: categories outside the list are
    dropped, listed categories with no rows stay absent. The list is a
    literal of known size, so it is broadcast.
    """
    seed = spark.createDataFrame([(v, i) for i, v in enumerate(values)],
                                 StructType([StructField(col, StringType()), StructField(order_col, IntegerType())]))
    return df.join(F.broadcast(seed), col, "inner")
