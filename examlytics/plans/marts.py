"""Dashboard marts (M1-M38) as distributed DataFrames.

The source computed these in pandas over at most 50,000 fetched rows; here
every mart aggregates the whole (sliced) attempt table. Inputs:

* executive marts read V1 (``cp``), sliced with :func:`apply_slicers`;
* training marts read :func:`prepare_base` of V14, whose sitting number
  ``seq`` is computed on the unsliced base, then sliced.

pandas group-bys drop NULL keys; the marts filter NULL keys explicitly where
the source grouped (the executive roster keeps the NULL e-mail group, as the
source asked pandas to). pandas ``first``/``last`` skip NULLs; so do the
``min_by``/``max_by`` picks here (rows with a NULL value are left out first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from examlytics.functions import scalar as fx
from examlytics.functions.html import with_question_label
from examlytics.operators.combine import grouped_with_distinct, one_row
from examlytics.operators.nested import crosstab, to_long
from examlytics.operators.slicers import apply_slicers, fixed_order, min_group_size, top_n
from examlytics.plans.org import latest_by_id
from examlytics.operators.windows import (exact_median, exact_quantiles, pct_rank_avg, previous_by_number,
                                          quantiles_of, rank_over, sequence_over, value_ranks)

# Dashboard constants.
LEVEL_ORDER = ["Beginner", "Intermediate", "Advanced"]
ROSTER_LIMIT = 2000
WATCHLIST_LIMIT = 20
QUESTION_LIST_LIMIT = 15
DEFAULT_MIN_SERVED = 20
RETAKE_HIST_DAYS = (0, 60, 30)  # low, high, bins
RETAKE_GAP_MAX_DAYS = 120
SEQ_TIEBREAK = ("assessment_taker_id", "attempt_number")


def _mean_pct(cond_or_flag: Column) -> Column:
    """``mean(x) * 100`` over non-NULL x (pandas mean skips NaN)."""
    return F.avg(cond_or_flag.cast("double")) * F.lit(100.0)


def _nn(*cols: str) -> Column:
    out = None
    for c in cols:
        out = F.col(c).isNotNull() if out is None else out & F.col(c).isNotNull()
    return out


def _pick(value: str, order: Column, latest: bool) -> Column:
    """First/last non-NULL ``value`` by ``order`` (pandas groupby first/last)."""
    v = F.when(F.col(value).isNotNull(), order)
    return F.max_by(value, v) if latest else F.min_by(value, v)


def _seq_key() -> Column:
    """Order of a person's sittings in the marts: seq, then time, test, taker."""
    return F.struct(F.col("seq"), F.coalesce(F.col("start_time").cast("string"), F.lit("~")),
                    F.coalesce("test_id", F.lit("")), F.coalesce("assessment_taker_id", F.lit("")))


# ---------------------------------------------------------------------------
# Executive page (V1 based): M2-M10, M38
# ---------------------------------------------------------------------------
def kpi_strip(cp: DataFrame, catalog: DataFrame, retake: DataFrame,
              organizations: Sequence[str] | None = None) -> DataFrame:
    """M2: one row of outcome and catalog KPIs for the sliced attempts.

    Catalog counts are summed over the selected organizations (all when none);
    the mean retake gap reads the retake view restricted to the sliced
    attempts' takers (J10 semi join).
    """
    ps = F.col("pass_status")
    outcomes = cp.agg(
        F.count(F.lit(1)).alias("total_attempts"),
        F.count_if(ps == "passed").alias("total_pass"),
        F.count_if(ps == "failed").alias("total_fail"),
        F.avg("duration_min").alias("avg_duration_min"),
        F.coalesce(F.sum("violation_count"), F.lit(0)).alias("total_violations"))
    cat = apply_slicers(catalog, organization_name=organizations).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in
          ("assessments_created", "assessments_dispatched", "tests_created", "questions_created")])
    takers = cp.select("assessment_taker_id").where(F.col("assessment_taker_id").isNotNull())
    r = retake.join(takers, "assessment_taker_id", "left_semi").agg(
        F.avg(F.col("days_between_attempts").cast("double")).alias("avg_retake_days"))
    out = one_row(outcomes, cat, r)
    return out.select("total_attempts", "total_pass", "total_fail",
                      F.coalesce(fx.pct("total_pass", "total_attempts"), F.lit(0.0)).alias("pass_rate_pct"),
                      "avg_duration_min", "assessments_created", "assessments_dispatched", "tests_created",
                      "questions_created", "total_violations", "avg_retake_days")


def monthly_performance(cp: DataFrame) -> DataFrame:
    """M3: per month attempts (non-NULL test), passes, pass rate, averages."""
    g = cp.where(F.col("attempt_month").isNotNull()).groupBy("attempt_month").agg(
        F.count("test_id").alias("attempts"), F.sum("is_pass").alias("passes"),
        F.avg("score_pct").alias("avg_score"), F.avg("duration_min").alias("avg_duration"))
    return g.select("*", (F.col("passes") / F.nullif(F.col("attempts"), F.lit(0)) * 100).alias("pass_rate_pct"))


def quarterly_yearly(cp: DataFrame, period: str = "attempt_quarter") -> DataFrame:
    """M4: attempts, passes and pass rate per quarter (or ``attempt_year``)."""
    g = cp.where(F.col(period).isNotNull()).groupBy(period).agg(
        F.count("test_id").alias("attempts"), F.sum("is_pass").alias("passes"))
    return g.select("*", (F.col("passes") / F.nullif(F.col("attempts"), F.lit(0)) * 100).alias("pass_rate_pct"))


def outcome_composition(cp: DataFrame, by_level: bool = False) -> DataFrame:
    """M5: pass/fail counts, optionally per test difficulty."""
    keys = ["test_difficulty", "pass_status"] if by_level else ["pass_status"]
    return cp.where(_nn(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def monthly_violations(cp: DataFrame) -> DataFrame:
    """M6: violation sum per month (an all-NULL month sums to 0, as in pandas)."""
    return cp.where(F.col("attempt_month").isNotNull()).groupBy("attempt_month").agg(
        F.coalesce(F.sum("violation_count"), F.lit(0)).alias("violation_count"))


def retake_interval_histogram(retake: DataFrame, low: float = RETAKE_HIST_DAYS[0],
                              high: float = RETAKE_HIST_DAYS[1], bins: int = RETAKE_HIST_DAYS[2]) -> DataFrame:
    """M7: retake gaps in [low, high] days counted in ``bins`` equal-width bins.

    The top edge belongs to the last bin. Bins with no gaps are absent.
    """
    d = F.col("days_between_attempts").cast("double")
    width = (high - low) / bins
    b = F.least(F.floor((d - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (retake.where(d.isNotNull() & d.between(low, high)).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
            .select("bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"),
                    (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"), "count"))


def executive_roster(cp: DataFrame, limit: int = ROSTER_LIMIT) -> DataFrame:
    """M8: one row per e-mail (the NULL e-mail is its own row), top ``limit`` by attempts."""
    g = grouped_with_distinct(cp, ["email"], [
        F.min_by("candidatename", F.when(F.col("candidatename").isNotNull(), _sheet_order()))
        .alias("candidate_name"),
        F.count("test_id").alias("total_attempts"),
        F.avg("score_pct").alias("avg_score"),
        F.coalesce(F.sum("is_pass"), F.lit(0)).alias("total_pass"),
        F.count_if(F.col("is_pass") == 0).alias("total_fail"),
        F.avg("duration_min").alias("avg_duration"),
        F.coalesce(F.sum("violation_count"), F.lit(0)).alias("total_violations"),
        F.max("start_time").alias("last_attempt")], {"tests_taken": "test_id"})
    g = g.select("*", (F.col("total_pass") / F.nullif(F.col("total_attempts"), F.lit(0)) * 100).alias("pass_rate"))
    return top_n(g, limit, [F.col("total_attempts").desc()], tiebreak=["email"])


def _sheet_order() -> Column:
    """Stable order of attempt rows for "first" picks in V1-based marts."""
    return F.struct(F.coalesce(F.col("start_time").cast("string"), F.lit("~")),
                    F.coalesce("test_id", F.lit("")), F.coalesce("assessment_taker_id", F.lit("")))


def busiest_email(cp: DataFrame) -> Column:
    """The e-mail with the most attempts (of several, the last by text), as a scalar subquery."""
    n = cp.where(F.col("email").isNotNull()).groupBy("email").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.max(F.struct("n", "email"))["email"]).scalar()


def candidate_history(cp: DataFrame, email: str | Column) -> tuple[DataFrame, DataFrame]:
    """M9: (KPIs, attempt list newest first) for one e-mail."""
    h = cp.where(F.col("email") == email)
    kpis = h.agg(
        F.count(F.lit(1)).alias("total_attempts"),
        F.count_distinct("test_id").alias("tests_taken"),
        _mean_pct(F.col("pass_status") == "passed").alias("pass_rate"),
        F.avg("score_pct").alias("avg_score"),
        F.avg("duration_min").alias("avg_duration"),
        F.coalesce(F.sum("violation_count"), F.lit(0)).alias("total_violations"))
    attempts = h.orderBy(F.col("start_time").desc_nulls_last(), F.col("test_id").asc())
    return kpis, attempts


def period_progression(cp: DataFrame, period: str = "attempt_year", email: str | None = None) -> DataFrame:
    """Per period attempts, average score and pass rate (optionally one candidate)."""
    h = cp if email is None else cp.where(F.col("email") == email)
    return h.where(F.col(period).isNotNull()).groupBy(period).agg(
        F.count("test_id").alias("attempts"), F.avg("score_pct").alias("avg_score"),
        _mean_pct(F.col("is_pass")).alias("pass_rate"))


def freshness_list(freshness: DataFrame) -> DataFrame:
    """Freshness rows (table, last load date)."""
    return freshness.select("table_name", "last_updated")


# ---------------------------------------------------------------------------
# Attempt drill-down
# ---------------------------------------------------------------------------
def attempt_questions(responses: DataFrame, testresult: DataFrame, question: DataFrame) -> DataFrame:
    """Per-question detail of attempts, with attempt-level figures and question metadata.

    ``responses`` is the exploded result JSON (position kept), ``testresult``
    the deduplicated attempt rows; filter either by (taker, test, attempt)
    for a point lookup, or keep everything for the whole table.
    """
    qd = latest_by_id(question, "questiontype", "difficultylevel", "questiontitle", "questiontext") \
        .withColumnRenamed("id", "q_id")
    keys = ["assessmenttakerid", "testid", "attemptnumber"]
    att = testresult.select(*keys,
                            F.col("testwindowviolationcount").alias("violation_count"),
                            F.col("testwindowviolationduration").alias("violation_duration_sec"),
                            F.col("numberofquestions").alias("attempt_questions_total"),
                            F.col("numberofquestionsfailed").alias("attempt_questions_failed"),
                            "testpercentage", "passstatus", F.col("duration").alias("attempt_duration_sec"),
                            "starttime", "finishtime")
    j = responses.join(att, keys, "left").join(qd, F.col("question_id") == F.col("q_id"), "left")
    return j.drop("q_id")


def question_outcomes(detail: DataFrame) -> DataFrame:
    """Outcome per served question and its number within the attempt.

    Correct if any points were scored, else Wrong if answered, else
    Unanswered; ``marked_correct_differs`` flags a correctness flag that
    disagrees with the score.
    """
    answered = fx.bool_text(F.col("is_answered"))
    scored = F.coalesce(F.col("achieved_score"), F.lit(0.0))
    outcome = (F.when(scored > 0, F.lit("Correct")).when(answered, F.lit("Wrong"))
               .otherwise(F.lit("Unanswered")))
    marked = fx.bool_text(F.col("is_answer_correct"))
    return detail.select("*", (F.col("pos") + 1).alias("question_no"), outcome.alias("outcome"),
                         (marked != (scored > 0)).alias("marked_correct_differs"))


def attempt_kpis(detail: DataFrame) -> DataFrame:
    """Per attempt: questions, answered, unanswered, correct, idle sum/mean.

    Source aggregates (question counts on the attempt row) win; per-question
    derivations fill in where the source figure is missing.
    """
    keys = ["assessmenttakerid", "testid", "attemptnumber"]
    answered = fx.bool_text(F.col("is_answered"))
    g = detail.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("served"),
        F.count_if(answered).alias("answered_derived"),
        F.count_if(F.coalesce(F.col("achieved_score"), F.lit(0.0)) > 0).alias("correct_derived"),
        F.sum("idle_time_sec").alias("idle_sum_sec"),
        F.avg("idle_time_sec").alias("idle_mean_sec"),
        F.max("attempt_questions_total").alias("src_total"),
        F.max("attempt_questions_failed").alias("src_failed"))
    total = F.coalesce(F.col("src_total"), F.col("served"))
    return g.select(*keys, total.alias("questions_total"), F.col("answered_derived").alias("answered"),
                    (total - F.col("answered_derived")).alias("unanswered"),
                    F.coalesce(total - F.col("src_failed"), F.col("correct_derived")).alias("correct"),
                    "idle_sum_sec", "idle_mean_sec")


def question_type_mix(detail: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(questions per type with NULL as 'Unknown', earned vs max long form per question)."""
    mix = detail.groupBy(F.coalesce("questiontype", F.lit("Unknown")).alias("question_type")).agg(
        F.count(F.lit(1)).alias("questions"))
    long = to_long(detail.select("assessmenttakerid", "testid", "attemptnumber", "pos",
                                 F.col("achieved_score").alias("Earned"), F.col("max_score").alias("Max")),
                   ["assessmenttakerid", "testid", "attemptnumber", "pos"], ["Earned", "Max"], "kind", "points")
    return mix, long


# ---------------------------------------------------------------------------
# Training Center (V14 based): M1, M15-M37
# ---------------------------------------------------------------------------
def prepare_base(ca: DataFrame) -> DataFrame:
    """M1: working set with year text and the real sitting number ``seq``.

    Drops excluded / 'Unmapped' rows (no-ops under force mapping) and numbers
    each person's sittings of a test by start time (NULL times last); the
    number is computed before any slicing, so slicing never renumbers.
    """
    keep = ~F.coalesce(F.col("is_excluded"), F.lit(False)) & \
        (F.col("specialization").isNull() | (F.col("specialization") != "Unmapped"))
    base = ca.where(keep).withColumn("year", F.substring("attempt_year", 1, 4))
    numbered = sequence_over(base, ["email", "test_id"], ["start_time", *SEQ_TIEBREAK], out="seq")
    return numbered.withColumn("seq", F.when(_nn("email", "test_id"), F.col("seq")))


def slice_base(base: DataFrame, years: Sequence[str] | None = None, specializations: Sequence[str] | None = None,
               programs: Sequence[str] | None = None) -> DataFrame:
    """Year -> specialization -> program slicers of the Training Center."""
    return apply_slicers(base, year=years, specialization=specializations, program_type=programs)


def data_trust(coverage: DataFrame) -> DataFrame:
    """Genuine-specialization share of attempts."""
    t, r = F.coalesce(F.col("total_attempts"), F.lit(0)), F.coalesce(F.col("real_specialization_attempts"), F.lit(0))
    return coverage.select(t.alias("total_attempts"), r.alias("real_specialization_attempts"),
                           F.when(t > 0, r / t * 100).otherwise(F.lit(0.0)).alias("real_pct"))


def outcomes_scorecard(f: DataFrame) -> DataFrame:
    """Candidates, attempts, first-sitting and overall pass, lift, median and mean score."""
    first = F.when(F.col("seq") == 1, F.col("is_pass"))
    g = grouped_with_distinct(f, [], [
        F.count(F.lit(1)).alias("attempts"),
        _mean_pct(first).alias("first_sitting_pass_pct"),
        _mean_pct(F.col("is_pass")).alias("overall_pass_pct"),
        F.avg("score_pct").alias("avg_score"),
        F.avg("duration_min").alias("avg_duration")],
        {"candidates": "email", "specializations": "specialization"})
    return g.select("candidates", "attempts", "specializations", "first_sitting_pass_pct", "overall_pass_pct",
                    (F.col("overall_pass_pct") - F.col("first_sitting_pass_pct")).alias("lift"),
                    exact_median(f, "score_pct").scalar().alias("median_score"), "avg_score", "avg_duration")


def attempts_to_pass(f: DataFrame) -> DataFrame:
    """Mean over (person, test) of the first sitting number that passed."""
    firsts = (f.where((F.col("is_pass") == 1) & _nn("email", "test_id", "seq"))
              .groupBy("email", "test_id").agg(F.min("seq").alias("first_pass_seq")))
    return firsts.agg(F.avg("first_pass_seq").alias("avg_attempts_to_pass"))


def question_accuracy(f: DataFrame) -> DataFrame:
    """Mean share of questions not failed, over attempts with questions."""
    qt, qf = F.col("questions_total"), F.col("questions_failed")
    return f.agg((F.avg(F.when(qt > 0, (qt - qf) / qt)) * F.lit(100.0)).alias("question_accuracy_pct"))


def integrity_rate(f: DataFrame) -> DataFrame:
    """Share of attempts with any violation (NULL counts as none)."""
    return f.agg(_mean_pct(F.coalesce(F.col("violation_count"), F.lit(0.0)) > 0).alias("integrity_rate_pct"))


def readiness_funnel(f: DataFrame) -> DataFrame:
    """Candidates -> Passed (ever) -> Passed 1st sitting -> Reached Advanced (long form)."""
    per = f.where(F.col("email").isNotNull()).groupBy("email").agg(
        F.coalesce(F.max("is_pass"), F.lit(0)).alias("ever"),
        F.max(F.when((F.col("seq") == 1) & (F.col("is_pass") == 1), F.lit(1)).otherwise(F.lit(0))).alias("first"),
        _pick("proficiency_level", _seq_key(), latest=True).alias("latest_prof"))
    wide = per.agg(
        F.count(F.lit(1)).alias("Candidates"),
        F.sum("ever").cast("long").alias("Passed (ever)"),
        F.sum("first").cast("long").alias("Passed 1st sitting"),
        F.count_if(F.col("latest_prof") == "Advanced").alias("Reached Advanced"))
    return to_long(wide, [], ["Candidates", "Passed (ever)", "Passed 1st sitting", "Reached Advanced"],
                   "stage", "n")


def proficiency_mix(f: DataFrame) -> DataFrame:
    """Attempts per specialization and proficiency level."""
    return f.where(_nn("specialization", "proficiency_level")).groupBy(
        "specialization", "proficiency_level").agg(F.count(F.lit(1)).alias("n"))


def specialization_summary(f: DataFrame) -> DataFrame:
    """Attempts, pass rate and average score per specialization."""
    return f.where(F.col("specialization").isNotNull()).groupBy("specialization").agg(
        F.count(F.lit(1)).alias("attempts"), _mean_pct(F.col("is_pass")).alias("pass_rate_pct"),
        F.avg("score_pct").alias("avg_score_pct"))


def score_distribution(f: DataFrame, *keys: str) -> DataFrame:
    """Box-plot figures per group: quartiles (linear), whiskers, outlier count.

    The rows are reduced once to ranked (group, score) pairs; quartiles,
    fences, whiskers and outliers all come from those.
    """
    keys = list(keys or ("specialization",))
    s = F.col("score_pct")
    rows = f.where(_nn(*keys, "score_pct")).select(*keys, "score_pct")
    ranks = value_ranks(rows, "score_pct", keys, descending=False)
    q = quantiles_of(ranks, "score_pct", keys, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    fences = q.select("*", (F.col("q1") - reach).alias("lo"), (F.col("q3") + reach).alias("hi"))
    figures = ranks.join(fences, keys).groupBy(*keys, "q1", "median", "q3").agg(
        F.max("n").alias("n"), F.min(s).alias("min"), F.max(s).alias("max"),
        F.min(F.when(s >= F.col("lo"), s)).alias("lower_whisker"), F.max(F.when(s <= F.col("hi"), s)).alias("upper_whisker"),
        F.coalesce(F.sum(F.when((s < F.col("lo")) | (s > F.col("hi")), F.col("ties"))), F.lit(0)).alias("outliers"))
    return figures.select(*keys, "n", "min", "max", "q1", "median", "q3", "lower_whisker", "upper_whisker", "outliers")


def level_summary(spark: SparkSession, f: DataFrame, levels: Sequence[str] = LEVEL_ORDER) -> DataFrame:
    """Attempts and pass rate per test level, restricted to and ordered by ``levels``."""
    g = f.where(F.col("test_difficulty").isNotNull()).groupBy("test_difficulty").agg(
        F.count(F.lit(1)).alias("attempts"), _mean_pct(F.col("is_pass")).alias("pass_rate_pct"))
    return fixed_order(spark, g, "test_difficulty", levels)


def pass_by_sitting(f: DataFrame, minimum: int = 5) -> DataFrame:
    """Attempts and pass rate per sitting number, sittings with >= ``minimum`` attempts."""
    g = f.where(F.col("seq").isNotNull()).groupBy("seq").agg(
        F.count(F.lit(1)).alias("attempts"), _mean_pct(F.col("is_pass")).alias("pass_rate_pct"))
    return min_group_size(g, "attempts", minimum)


def score_over_time(f: DataFrame) -> DataFrame:
    """Average score and attempts per month (month text of length >= 7)."""
    return f.where(F.length("attempt_month") >= 7).groupBy("attempt_month").agg(
        F.avg("score_pct").alias("avg_score_pct"), F.count(F.lit(1)).alias("attempts"))


def proficiency_migration(f: DataFrame, levels: Sequence[str] = LEVEL_ORDER) -> DataFrame:
    """People by first x latest proficiency (levels x levels, zero-filled)."""
    per = f.where(F.col("email").isNotNull()).groupBy("email").agg(
        _pick("proficiency_level", _seq_key(), latest=False).alias("first_proficiency"),
        _pick("proficiency_level", _seq_key(), latest=True).alias("latest_proficiency"))
    per = per.where(F.col("first_proficiency").isin(list(levels)) & F.col("latest_proficiency").isin(list(levels)))
    ct = crosstab(per, "first_proficiency", "latest_proficiency", values=list(levels))
    spark = f.sparkSession
    rows = spark.createDataFrame([(lv, i) for i, lv in enumerate(levels)], "first_proficiency string, sort_order int")
    out = F.broadcast(rows).join(ct, "first_proficiency", "left")
    return out.fillna(0, subset=list(levels))


def _retaken(f: DataFrame) -> DataFrame:
    """Rows of (person, test) groups with more than one sitting.

    The group sizes are a partial (map-side) aggregate; the rows are kept by
    a semi join on the re-sat keys, so no window holds a whole group.
    """
    keyed = f.where(_nn("email", "test_id"))
    resat = keyed.groupBy("email", "test_id").agg(F.count(F.lit(1)).alias("__size")) \
        .where(F.col("__size") > 1).select("email", "test_id")
    return keyed.join(resat, ["email", "test_id"], "left_semi")


def retake_score_change(f: DataFrame) -> DataFrame:
    """Per re-sat (person, test): last - first score (non-NULL scores, by seq) and its direction."""
    r = _retaken(f)
    g = r.groupBy("email", "test_id").agg(
        (_pick("score_pct", _seq_key(), True) - _pick("score_pct", _seq_key(), False)).alias("delta"))
    g = g.where(F.col("delta").isNotNull())
    return g.select("*", fx.retake_direction("delta").alias("direction"))


def retake_gaps(f: DataFrame, max_days: float = RETAKE_GAP_MAX_DAYS) -> DataFrame:
    """Days between consecutive sittings of re-sat tests, kept within [0, max_days]."""
    r = _retaken(f).select("email", "test_id", "seq", "start_time")
    g = previous_by_number(r, ["email", "test_id"], "seq", ["start_time"])
    gap = (F.unix_micros(F.col("start_time").cast("timestamp"))
           - F.unix_micros(F.col("prev_start_time").cast("timestamp"))) / F.lit(86400e6)
    return g.select("email", "test_id", "seq", gap.alias("gap_days")).where(F.col("gap_days").between(0, max_days))


def retake_medians(f: DataFrame) -> DataFrame:
    """Median score change and median gap in days of re-sat tests (one row)."""
    change = exact_median(retake_score_change(f).select("delta"), "delta").withColumnRenamed("median", "median_score_change")
    gap = exact_median(retake_gaps(f).select("gap_days"), "gap_days").withColumnRenamed("median", "median_gap_days")
    return one_row(change, gap)


def candidate_integrity(f: DataFrame) -> DataFrame:
    """Per person attempts, average score, violations and violations per attempt."""
    g = f.where(F.col("email").isNotNull()).groupBy("email").agg(
        _pick("candidatename", _sheet_order(), latest=False).alias("name"),
        F.count(F.lit(1)).alias("attempts"),
        F.avg("score_pct").alias("avg_score"),
        F.coalesce(F.sum("violation_count"), F.lit(0.0)).alias("total_viol"),
        F.coalesce(F.sum("violation_duration_sec"), F.lit(0.0)).alias("viol_dur"))
    return g.select("*", (F.col("total_viol") / F.nullif(F.col("attempts"), F.lit(0))).alias("viol_per_attempt"))


def violation_rate(f: DataFrame) -> DataFrame:
    """Per specialization the share of attempts with a violation and their total."""
    vc = F.coalesce(F.col("violation_count"), F.lit(0.0))
    return f.where(F.col("specialization").isNotNull()).groupBy("specialization").agg(
        F.count(F.lit(1)).alias("attempts"), _mean_pct(vc > 0).alias("violation_rate_pct"),
        F.sum(vc).alias("total_violations"))


def risk_watchlist(f: DataFrame, limit: int = WATCHLIST_LIMIT) -> DataFrame:
    """The ``limit`` people with the highest positive integrity risk."""
    ci = candidate_integrity(f)
    ci = ci.select("*", fx.integrity_risk("total_viol", "viol_dur").alias("integrity_risk"),
                   (F.col("viol_dur") / 60).alias("viol_min"))
    return top_n(ci.where(F.col("integrity_risk") > 0), limit, [F.col("integrity_risk").desc()], ["email"])


def cohort_scorecard(f: DataFrame) -> DataFrame:
    """Per cohort candidates, attempts, first-sitting / overall pass, scores, advanced share, integrity."""
    vc = F.coalesce(F.col("violation_count"), F.lit(0.0))
    g = grouped_with_distinct(f.where(F.col("cohort").isNotNull()), ["cohort"], [
        F.count(F.lit(1)).alias("attempts"),
        _mean_pct(F.when(F.col("seq") == 1, F.col("is_pass"))).alias("first_sit_pass_pct"),
        _mean_pct(F.col("is_pass")).alias("overall_pass_pct"),
        F.avg("score_pct").alias("avg_score_pct"),
        _mean_pct(F.coalesce(F.col("proficiency_level") == "Advanced", F.lit(False))).alias("pct_advanced"),
        _mean_pct(vc > 0).alias("integrity_pct")],
        {"candidates": "email"})
    median = exact_quantiles(f.where(_nn("cohort", "score_pct")), "score_pct", ["cohort"], {"median_pct": 0.5})
    g = g.join(median, "cohort", "left")
    return g.select("cohort", "candidates", "attempts", "first_sit_pass_pct", "overall_pass_pct", "avg_score_pct",
                    "median_pct", "pct_advanced", "integrity_pct")


def cohort_scores(f: DataFrame) -> DataFrame:
    """Average score per cohort, 'Unassigned' left out."""
    return f.where(F.col("cohort").isNotNull() & (F.col("cohort") != "Unassigned")).groupBy("cohort").agg(
        F.avg("score_pct").alias("avg_score_pct"))


COMPARE_METRICS = ["Attempts", "Candidates", "1st-Sit Pass %", "Overall Pass %", "Avg Score %", "Integrity %"]


def compare_groups(f: DataFrame, dimension: str, a: str, b: str) -> DataFrame:
    """Six KPIs for two values of ``dimension`` and their difference A - B (long form)."""
    vc = F.coalesce(F.col("violation_count"), F.lit(0.0))
    g = f.where(F.col(dimension).isin(a, b)).groupBy(F.col(dimension).alias("grp")).agg(
        F.count(F.lit(1)).cast("double").alias("Attempts"),
        F.count_distinct("email").cast("double").alias("Candidates"),
        _mean_pct(F.when(F.col("seq") == 1, F.col("is_pass"))).alias("1st-Sit Pass %"),
        _mean_pct(F.col("is_pass")).alias("Overall Pass %"),
        F.avg("score_pct").alias("Avg Score %"),
        _mean_pct(vc > 0).alias("Integrity %"))
    long = to_long(g, ["grp"], COMPARE_METRICS, "metric", "val")
    wide = long.groupBy("metric").pivot("grp", [a, b]).agg(F.first("val"))
    # A group without rows still has 0 attempts and 0 candidates; its rates stay NULL.
    counted = F.col("metric").isin("Attempts", "Candidates")
    ga = F.when(counted, F.coalesce(F.col(f"`{a}`"), F.lit(0.0))).otherwise(F.col(f"`{a}`"))
    gb = F.when(counted, F.coalesce(F.col(f"`{b}`"), F.lit(0.0))).otherwise(F.col(f"`{b}`"))
    metrics = f.sparkSession.createDataFrame([(m,) for m in COMPARE_METRICS], "metric string")
    wide = F.broadcast(metrics).join(wide, "metric", "left")
    return wide.select("metric", ga.alias("group_a"), gb.alias("group_b"), (ga - gb).alias("delta"))


def question_rankings(qp: DataFrame, min_served: int = DEFAULT_MIN_SERVED,
                      limit: int = QUESTION_LIST_LIMIT) -> DataFrame:
    """Hardest, most-skipped and idle-hotspot questions (top ``limit`` each) of V23.

    The lists are cut first and labelled after, so text cleaning sees at most
    ``3 * limit`` rows.
    """
    pool = qp.where(F.col("times_served") >= min_served)
    cols = ["question_id", "question_text", "question_title", "question_type", "question_difficulty", "specialization",
            "times_served", "answer_rate_pct", "correct_rate_pct", "avg_idle_sec"]
    lists = [("hardest", F.col("correct_rate_pct").asc_nulls_last()),
             ("most_skipped", F.col("answer_rate_pct").asc_nulls_last()),
             ("idle_hotspots", F.col("avg_idle_sec").desc_nulls_last())]
    out = None
    for name, order in lists:
        one = top_n(pool.select(*cols), limit, [order], ["question_id"]).withColumn("ranking", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return with_question_label(out).drop("question_text", "question_title")


def training_roster(f: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per person with rank (min, by average score) and percentile.

    The population ranking uses :func:`rank_over` (range-partitioned, no
    single-task window over all people).
    """
    k = _seq_key()
    per = grouped_with_distinct(f.where(F.col("email").isNotNull()), ["email"], [
        _pick("candidatename", _sheet_order(), latest=False).alias("candidatename"),
        F.count(F.lit(1)).alias("attempts"),
        _mean_pct(F.col("is_pass")).alias("pass_rate_pct"),
        F.avg("score_pct").alias("avg_score_pct"),
        F.max("score_pct").alias("best_score_pct"),
        (F.coalesce(F.sum("violation_count"), F.lit(0.0)) * 2
         + F.coalesce(F.sum("violation_duration_sec"), F.lit(0.0)) / 60).alias("integrity_risk"),
        _pick("proficiency_level", k, latest=True).alias("latest_proficiency"),
        (_pick("score_pct", k, True) - _pick("score_pct", k, False)).alias("improvement")],
        {"tests_taken": "test_id"})
    ranked = rank_over(per, "avg_score_pct", descending=True, parts=parts)
    return ranked.select(
        "email", "candidatename", "attempts", "tests_taken", "pass_rate_pct", "avg_score_pct", "best_score_pct",
        "latest_proficiency", "improvement", "integrity_risk",
        F.col("rank_min").alias("rank"),
        pct_rank_avg(F.col("rank_min"), F.col("ties"), F.col("n")).alias("percentile"))
