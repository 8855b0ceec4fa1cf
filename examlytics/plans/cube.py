"""One cube per fact table, from which the grouped views are rolled up.

The cube holds, per finest group, additive measures (counts, sums, a KLL
quantile sketch of the score) and, for each column whose distinct values a view
counts, the set of those values as bitmaps over a dense dictionary. Sets merge
by OR, so a distinct count of any coarser group is exact; medians come from
merged sketches with the rank error of :data:`KLL_K`. Views read the cube only:
their cost follows the number of groups, not of attempts.

The dictionary needs no global sort: values are hashed by the group they mostly
belong to, numbered within their partition, and shifted by the sizes of the
partitions before (one row per partition). Values of one group are neighbours,
so a group's set takes few bitmaps of 32,768 positions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examlytics.functions import scalar as fx
from examlytics.plans import seeds
from examlytics.session import keep

#: Sketches of up to about this many scores are exact; beyond, ranks are off by at most about 2.3 / k ** 0.9 with 99 % confidence.
KLL_K = 8000
#: A group's values are dealt to this many partitions, for a group that holds very many of them.
DEALT = 16
_LOCAL = (1 << 33) - 1


def dense_ids(rows: DataFrame, value: str, group: str, writer: Callable[[DataFrame, str], DataFrame] = keep) -> DataFrame:
    """(value, id): the distinct non-NULL values numbered from 0 without gaps, those of one ``group`` near one another."""
    distinct = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(F.col(group).cast("string")).alias("__g"))
    dealt = distinct.repartition("__g", F.pmod(F.xxhash64(value), F.lit(DEALT))).sortWithinPartitions("__g", value)
    # Written once: the numbers depend on the partitioning.
    numbered = writer(dealt.select(value, F.monotonically_increasing_id().alias("__n")), "dictionary")
    part = F.shiftright("__n", 33)
    sizes = numbered.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__size"))
    before = F.coalesce(F.sum("__size").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__p", before.alias("__start"))  # a row per partition
    return numbered.join(F.broadcast(starts), part == F.col("__p")).select(value, (F.col("__start") + F.col("__n").bitwiseAND(_LOCAL)).alias("id"))


class Cube:
    """Measures and member sets of ``facts`` by ``keys``.

    ``measures`` are additive aggregates; ``distinct`` maps a name to the
    column whose values it counts, ``near`` names the key that most of them
    belong to; ``sketched`` is the column of the quantile sketch.
    """

    def __init__(self, facts: DataFrame, keys: Sequence[str], measures: dict[str, Column], distinct: dict[str, str], near: str,
                 sketched: str | None = None, k: int = KLL_K, writer: Callable[[DataFrame, str], DataFrame] = keep):
        self.keys, self.sketched, self.k = list(keys), sketched, k
        aggs = [c.alias(n) for n, c in measures.items()]
        if sketched:
            aggs.append(F.kll_sketch_agg_double(F.col(sketched).cast("double"), F.lit(k)).alias("sketch"))
        self.additive = list(measures)
        self.measures = writer(facts.groupBy(*keys).agg(*aggs), "cube-measures")
        self.members = {}
        for name, col in distinct.items():
            ids = dense_ids(facts.select(col, near), col, near, writer).withColumnRenamed(col, "__value")
            pairs = facts.where(F.col(col).isNotNull()).select(*keys, F.col(col).alias("__value")).distinct().join(ids, "__value")
            self.members[name] = writer(pairs.groupBy(*keys, F.bitmap_bucket_number("id").alias("__bucket"))
                                        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits")), f"cube-{name}")

    def rollup(self, keys: Sequence[str], distinct: Sequence[str] = (), where: Column | None = None, median: str | None = None,
               also: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        """Sums of all measures, exact distinct counts and (``median``: its name) the sketch's median by ``keys``.

        ``also`` may add key columns to the cube's rows; ``where`` filters on the cube's keys.
        """
        def chosen(df: DataFrame) -> DataFrame:
            return also(df.where(where) if where is not None else df)

        aggs = [F.sum(m).alias(m) for m in self.additive]
        if median:
            aggs.append(F.kll_merge_agg_double("sketch", F.lit(self.k)).alias("__sketch"))
        out = chosen(self.measures).groupBy(*keys).agg(*aggs)
        if median:
            out = out.withColumn(median, F.when(F.kll_sketch_get_n_double("__sketch") > 0, F.kll_sketch_get_quantile_double("__sketch", F.lit(0.5)))).drop("__sketch")
        for name in distinct:
            sets = chosen(self.members[name]).groupBy(*keys, "__bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
            n = sets.groupBy(*[F.col(c).alias(f"__{c}") for c in keys]).agg(F.sum(F.bitmap_count("bits")).alias(name))
            same = [out[c].eqNullSafe(n[f"__{c}"]) for c in keys]
            out = out.join(n, same, "left").drop(*[f"__{c}" for c in keys]).withColumn(name, F.coalesce(name, F.lit(0)))
        return out


EXECUTIVE_KEYS = ["attempt_month", "attempt_quarter", "attempt_year", "test_difficulty", "organization_id", "organization_name"]
COHORT_KEYS = ["cohort", "cohort_year", "program_type", "center", "specialization", "is_excluded", "attempt_month", "attempt_quarter"]


def _mean(c: str) -> dict[str, Column]:
    return {f"{c}_sum": F.sum(F.col(c).cast("double")), f"{c}_n": F.count(c)}


def _averaged(c: str) -> Column:
    return F.col(f"{c}_sum") / F.nullif(F.col(f"{c}_n"), F.lit(0))


def executive_cube(cp: DataFrame, writer: Callable[[DataFrame, str], DataFrame] = keep) -> Cube:
    """Over V1: months, difficulty and organizations."""
    measures = {"attempts": F.count(F.lit(1)), "passes": F.sum("is_pass"), **_mean("score_pct"), **_mean("duration_min"),
                "total_violations": F.sum("violation_count")}
    return Cube(cp, EXECUTIVE_KEYS, measures, {"unique_candidates": "assessment_taker_id", "unique_tests": "test_id"}, "organization_id", writer=writer)


def cohort_cube(ca: DataFrame, writer: Callable[[DataFrame, str], DataFrame] = keep, k: int = KLL_K) -> Cube:
    """Over V14: cohorts, specializations and months."""
    hits = lambda cond: F.sum(F.when(cond, F.lit(1)))  # noqa: E731  NULL where nothing matches, as in the views
    first = F.col("attempt_number") == 1
    qt, qf = F.col("questions_total"), F.col("questions_failed")
    facts = ca.withColumns({"done_share": (qt - qf) / F.nullif(qt, F.lit(0)), "tries": F.col("total_attempts_before_pass").cast("double")})
    measures = {"attempts": F.count(F.lit(1)), "passes": F.sum("is_pass"), "firsts": hits(first), "first_passes": hits(first & (F.col("is_pass") == 1)),
                **{f"{x}_n": hits(F.col("proficiency_level") == x.capitalize()) for x in ("advanced", "intermediate", "beginner")},
                **_mean("score_pct"), **_mean("tries"), **_mean("duration_min"), **_mean("done_share"),
                "total_violations": F.sum("violation_count"), "violations_n": F.count("violation_count")}
    return Cube(facts, COHORT_KEYS, measures, {"unique_candidates": "assessment_taker_id"}, "cohort", sketched="score_pct", k=k, writer=writer)


def monthly_trend(cube: Cube) -> DataFrame:
    """V3 from the cube."""
    g = cube.rollup(EXECUTIVE_KEYS, ["unique_candidates"], where=fx.nonblank("attempt_month"))
    return g.select(*EXECUTIVE_KEYS, "attempts", "passes", (F.col("attempts") - F.col("passes")).alias("fails"), fx.pct("passes", "attempts").alias("pass_rate_pct"),
                    _averaged("score_pct").alias("avg_score_pct"), _averaged("duration_min").alias("avg_duration_min"), "total_violations", "unique_candidates")


def organization_overview(cube: Cube) -> DataFrame:
    """V6 from the cube."""
    keys = ["organization_id", "organization_name"]
    g = cube.rollup(keys, ["unique_candidates", "unique_tests"])
    return g.select(*keys, "attempts", "unique_candidates", "unique_tests", "passes", (F.col("attempts") - F.col("passes")).alias("fails"),
                    fx.pct("passes", "attempts").alias("pass_rate_pct"), _averaged("score_pct").alias("avg_score_pct"),
                    _averaged("duration_min").alias("avg_duration_min"), "total_violations")


def _cohort_figures() -> dict[str, Column]:
    rate = lambda n, d="attempts": fx.pct_dec1(F.col(n), F.col(d))
    return {"pass_rate_pct": rate("passes"), "first_attempt_pass_rate_pct": rate("first_passes", "firsts"), "avg_score_pct": _averaged("score_pct"),
            "pct_advanced": rate("advanced_n"), "pct_intermediate": rate("intermediate_n"), "pct_beginner": rate("beginner_n"),
            "avg_attempts_to_pass": _averaged("tries"), "avg_duration_min": _averaged("duration_min"), "completion_rate_pct": _averaged("done_share") * 100,
            "avg_violations_per_attempt": F.col("total_violations") / F.nullif(F.col("violations_n"), F.lit(0))}


def _cohort_view(cube: Cube, keys: list[str], columns: list[str], **options) -> DataFrame:
    g, made = cube.rollup(keys, ["unique_candidates"], **options), _cohort_figures()
    return g.select(*keys, *[made[c].alias(c) if c in made else F.col(c) for c in columns])


def cohort_kpis(cube: Cube, reference: DataFrame | None = None) -> DataFrame:
    """V15 from the cube, the median from merged sketches."""
    ref = F.broadcast(reference if reference is not None else seeds.program_reference(cube.measures.sparkSession))
    return _cohort_view(cube, ["cohort", "program_type", "cohort_year", "center", "duration_months"],
                        ["attempts", "unique_candidates", "pass_rate_pct", "first_attempt_pass_rate_pct", "avg_score_pct", "median_score_pct", "pct_advanced",
                         "pct_intermediate", "pct_beginner", "avg_attempts_to_pass", "avg_duration_min", "completion_rate_pct", "total_violations",
                         "avg_violations_per_attempt"],
                        median="median_score_pct", also=lambda df: df.join(ref, df.program_type == ref.program, "left"))


def cohort_specialization_kpis(cube: Cube) -> DataFrame:
    """V16 from the cube."""
    return _cohort_view(cube, ["cohort", "cohort_year", "program_type", "specialization", "center"],
                        ["attempts", "unique_candidates", "pass_rate_pct", "avg_score_pct", "median_score_pct", "pct_advanced", "pct_intermediate", "pct_beginner",
                         "avg_attempts_to_pass", "avg_duration_min", "total_violations"],
                        median="median_score_pct", where=~F.col("is_excluded"))


def specialization_kpis(cube: Cube) -> DataFrame:
    """V17 from the cube."""
    return _cohort_view(cube, ["specialization"],
                        ["attempts", "unique_candidates", "pass_rate_pct", "first_attempt_pass_rate_pct", "avg_score_pct", "median_score_pct", "pct_advanced",
                         "pct_intermediate", "pct_beginner", "avg_attempts_to_pass", "avg_duration_min", "completion_rate_pct", "total_violations"],
                        median="median_score_pct", where=~F.col("is_excluded"))


def cohort_progression(cube: Cube) -> DataFrame:
    """V21 from the cube."""
    return _cohort_view(cube, ["cohort", "cohort_year", "program_type", "specialization", "attempt_month", "attempt_quarter"],
                        ["attempts", "unique_candidates", "pass_rate_pct", "avg_score_pct"], where=fx.nonblank("attempt_month"))
