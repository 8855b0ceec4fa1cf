"""Documented-only views and panels (DOC1-DOC20, V24).

These are defined in the project's documentation or demo schemas but have
no SQL of their own. Formulas follow the KPI dictionary where it gives one;
where only column names exist (the assessment summary), the formula is
inferred from the name and says so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examlytics.functions import scalar as fx
from examlytics.operators.nested import to_long
from examlytics.operators.slicers import apply_slicers
from examlytics.operators.windows import sequence_over
from examlytics.plans.org import latest_attempts, latest_by_id
from examlytics.sources.silver import Silver

# Documented thresholds and labels.
RISK_HIGH, RISK_MEDIUM = 10, 5
CALIBRATION_TARGET = 80.0
STALE_AFTER_HOURS = 24
DEFAULT_RECENT_MONTHS = 3
INTERNAL_PASS_TARGET = 70.0


def growth_tracking(cp: DataFrame) -> DataFrame:
    """DOC1 ``candidate_growth_tracking``: previous score and improvement per (taker, test) by attempt.

    (taker, test, attempt) is unique after dedup, so each (taker, test)
    window partition holds at most one row per attempt number (NULL takers
    included): bounded by construction.
    """
    w = Window.partitionBy("assessment_taker_id", "test_id").orderBy(
        F.col("attempt_number").asc_nulls_last(), F.col("start_time").asc_nulls_last())
    return cp.select("assessment_taker_id", "candidatename", "test_id", "test_title", "attempt_number",
                     "score_pct", "load_date", F.lag("score_pct").over(w).alias("previous_score")) \
        .withColumn("score_improvement", F.col("score_pct") - F.col("previous_score"))


def _risk_label(score: Column) -> Column:
    return F.concat(fx.integrity_label(score, RISK_HIGH, RISK_MEDIUM), F.lit(" Risk"))


def senior_insights(silver: Silver) -> DataFrame:
    """DOC2 ``senior_analytics_insights``: integrity risk, label and completion funnel per attempt.

    ``completion_funnel_pct = answered / NULLIF(total, 0)`` (a fraction, as
    documented); NULL when the source has no answered-count column.
    """
    tr = latest_attempts(silver)
    answered = (F.col("numberofquestionsanswered") if "numberofquestionsanswered" in tr.columns
                else F.lit(None).cast("long"))
    risk = fx.integrity_risk(F.col("testwindowviolationcount"), F.col("testwindowviolationduration"))
    return tr.select(
        F.col("assessmenttakerid").alias("assessment_taker_id"), F.col("testid").alias("test_id"),
        F.col("title").alias("test_title"), risk.alias("integrity_risk_score"),
        (answered / F.nullif(F.col("numberofquestions"), F.lit(0))).alias("completion_funnel_pct"),
        _risk_label(risk).alias("integrity_label"), "load_date")


def flag_counts(flags: DataFrame, takers: DataFrame) -> DataFrame:
    """(f_id, question_flag_count): flags per assessment, through the taker (id, assessment_id) who raised them."""
    return (flags.join(takers, F.col("assessmenttakerid") == takers.id).groupBy(F.col("assessment_id").alias("f_id"))
            .agg(F.count(F.lit(1)).alias("question_flag_count")))


def assessment_summary(cp: DataFrame, silver: Silver) -> DataFrame:
    """DOC3 / V24 ``assessment_summary`` (``mv_assessment_kpis``): 17 columns per assessment.

    Inferred from the column names (no defining SQL exists): takers are
    distinct taker ids, started = with a start time, completed = with a
    finish time, graded = attempts with a score; title, status and planned
    duration come from the assessment table when it has them; flags count by
    the taker who raised them (NULL without a question-flag table).
    """
    a_cols = silver.assessment.columns
    extra = [c for c in ("title", "status", "duration") if c in a_cols]
    asmt = latest_by_id(silver.assessment, "organizationid", *extra).alias("a")
    g = cp.groupBy("assessment_id").agg(
        F.count_distinct("assessment_taker_id").alias("total_takers"),
        F.count_distinct(F.when(F.col("start_time").isNotNull(), F.col("assessment_taker_id"))).alias("started_takers"),
        F.count_distinct(F.when(F.col("is_complete") == 1, F.col("assessment_taker_id"))).alias("completed_takers"),
        F.count("score_pct").alias("graded_attempts"),
        F.avg("score_pct").alias("average_score"),
        (F.avg("is_pass") * 100).alias("pass_rate_pct"),
        F.avg("duration_min").alias("average_duration_minutes"),
        F.max("duration_min").alias("max_duration_minutes"),
        F.sum("violation_count").alias("violation_count"))
    j = g.join(asmt, g.assessment_id == F.col("a.id"), "left")
    flag_count = F.lit(None)
    if silver.questionflag is not None:
        takers = latest_by_id(silver.assessmenttaker, "assessmentid").select("id", F.col("assessmentid").alias("assessment_id"))
        flags = flag_counts(latest_by_id(silver.questionflag, "questionid", "assessmenttakerid").drop("id"), takers)
        j = j.join(flags, g.assessment_id == flags.f_id, "left")
        flag_count = F.coalesce("question_flag_count", F.lit(0))
    col = lambda c: F.col(f"a.{c}") if c in extra else F.lit(None)
    return j.select(
        "assessment_id", col("title").cast("string").alias("assessment_title"),
        F.col("a.organizationid").alias("organization_id"), col("status").cast("string").alias("status"),
        (col("duration").cast("double") / 60).alias("duration_minutes"),
        "total_takers", "started_takers", "completed_takers",
        fx.pct("completed_takers", "total_takers").alias("completion_rate_pct"),
        "graded_attempts", "average_score", F.col("average_score").alias("average_percentage"),
        "pass_rate_pct", "average_duration_minutes", "max_duration_minutes", "violation_count",
        flag_count.cast("long").alias("question_flag_count"))


def kpi_month_deltas(cp: DataFrame) -> DataFrame:
    """DOC4: per month avg score, pass rate, internal share and change vs the previous month.

    Months are free text in the source, so their number is not bounded: the
    previous month comes from :func:`sequence_over`, not a global window.
    """
    m = cp.where(fx.nonblank("attempt_month")).groupBy("attempt_month").agg(
        F.avg("score_pct").alias("avg_score_pct"),
        (F.avg("is_pass") * 100).alias("pass_rate_pct"),
        (F.avg((F.col("candidate_source") == "Internal").cast("double")) * 100).alias("internal_pct"))
    seq = sequence_over(m, [], ["attempt_month"], out="n", prev=["avg_score_pct", "pass_rate_pct"])
    return seq.select(*m.columns, (F.col("avg_score_pct") - F.col("prev_avg_score_pct")).alias("avg_score_delta"),
                      (F.col("pass_rate_pct") - F.col("prev_pass_rate_pct")).alias("pass_rate_delta"))


def integrity_composition(insights: DataFrame) -> DataFrame:
    """DOC5: attempts per integrity label."""
    return insights.groupBy("integrity_label").agg(F.count(F.lit(1)).alias("attempts"))


def completion_funnel(cp: DataFrame) -> DataFrame:
    """DOC6: Registered -> Submitted -> Passed (long form)."""
    wide = cp.agg(F.count(F.lit(1)).alias("Registered"),
                  F.count_if(F.col("is_complete") == 1).alias("Submitted"),
                  F.count_if(F.col("is_pass") == 1).alias("Passed"))
    return to_long(wide, [], ["Registered", "Submitted", "Passed"], "stage", "attempts")


def domain_difficulty_heatmap(ca: DataFrame) -> DataFrame:
    """DOC7: average score by domain x test difficulty (long form: one cell per row)."""
    return ca.where(F.col("domain_name").isNotNull() & F.col("test_difficulty").isNotNull()).groupBy(
        "domain_name", "test_difficulty").agg(F.avg("score_pct").alias("avg_score_pct"))


def source_pass_rates(cp: DataFrame) -> DataFrame:
    """DOC8: pass rate of internal vs external candidates, with the documented target."""
    return cp.groupBy("candidate_source").agg(
        F.count(F.lit(1)).alias("attempts"), (F.avg("is_pass") * 100).alias("pass_rate_pct")) \
        .withColumn("target_pct", F.lit(INTERNAL_PASS_TARGET))


def violations_by_severity(violations: DataFrame) -> DataFrame:
    """DOC9: attempts, violations and questions failed per test and severity slice."""
    return violations.groupBy("test_id", "test_title", "violation_severity_slice").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.sum("test_window_violation_count").alias("violations"),
        F.sum("number_of_questions_failed").alias("questions_failed"))


def violation_audit(ca: DataFrame) -> DataFrame:
    """DOC9: every attempt with a recorded violation count: severity, domain and difficulty."""
    return ca.where(F.col("violation_count").isNotNull()).select(
        "assessment_taker_id", "test_id", "attempt_number", "test_title", "domain_name", "test_difficulty",
        "violation_count", "violation_duration_sec", "questions_failed",
        fx.violation_severity("violation_count").alias("violation_severity_slice"))


def duration_scores(cp: DataFrame) -> DataFrame:
    """DOC10: time to finish against score, with proficiency, for attempts that have both."""
    return cp.where(F.col("duration_min").isNotNull() & F.col("score_pct").isNotNull()).select(
        "assessment_taker_id", "test_id", "attempt_number", "duration_min", "score_pct", "proficiency_level")


def attempts_needed_histogram(cp: DataFrame) -> DataFrame:
    """DOC10: (taker, test) pairs by number of attempts, and attempts per proficiency level."""
    pairs = cp.where(F.col("total_attempts_before_pass").isNotNull()) \
        .groupBy("assessment_taker_id", "test_id").agg(F.max("total_attempts_before_pass").alias("attempts"))
    return pairs.groupBy("attempts").agg(F.count(F.lit(1)).alias("pairs"))


def proficiency_distribution(cp: DataFrame) -> DataFrame:
    """DOC10: attempts per proficiency level."""
    return cp.groupBy("proficiency_level").agg(F.count(F.lit(1)).alias("attempts"))


def assessment_training_summary(cp: DataFrame) -> DataFrame:
    """DOC11: per test: takers, average score, pass rate, average duration, average attempts."""
    return cp.groupBy("test_id", "test_title").agg(
        F.count_distinct("assessment_taker_id").alias("takers"),
        F.avg("score_pct").alias("avg_score_pct"),
        (F.avg("is_pass") * 100).alias("pass_rate_pct"),
        F.avg("duration_min").alias("avg_duration_min"),
        F.avg(F.col("total_attempts_before_pass").cast("double")).alias("avg_attempts"))


def trainer_output_long(trainer: DataFrame) -> DataFrame:
    """DOC12: questions per trainer and difficulty (long form) with calibration vs target."""
    long = to_long(trainer.select("trainer_id", "avg_calibration_score",
                                  F.col("hard_questions_created").alias("hard"),
                                  F.col("medium_questions_created").alias("medium"),
                                  F.col("easy_questions_created").alias("easy")),
                   ["trainer_id", "avg_calibration_score"], ["hard", "medium", "easy"], "difficulty", "questions")
    return long.select("*", (F.col("avg_calibration_score") >= CALIBRATION_TARGET).alias("meets_calibration_target"))


def freshness_alarm(freshness: DataFrame, now: str, hours: int = STALE_AFTER_HOURS) -> DataFrame:
    """DOC13: a table is stale when its last load is more than ``hours`` before ``now``."""
    last = F.col("last_updated").try_cast("timestamp_ntz")
    ref = F.lit(now).cast("timestamp_ntz")
    age = fx.diff_hours(last, ref)
    return freshness.select("table_name", "last_updated", age.alias("hours_behind"),
                            (age > hours).alias("is_stale"))


def candidate_drilldown(insights: DataFrame, growth: DataFrame) -> DataFrame:
    """DOC14: per taker the most frequent integrity label and the total score gain.

    ``mode`` ties go to the smallest label; the score gain sums the
    improvements of DOC1.
    """
    lab = insights.groupBy("assessment_taker_id").agg(
        F.mode("integrity_label", deterministic=True).alias("integrity_label_mode"))
    gain = growth.groupBy("assessment_taker_id").agg(F.sum("score_improvement").alias("total_score_gain"))
    return lab.join(gain, "assessment_taker_id", "full")


def recent_months(cp: DataFrame, months: int = DEFAULT_RECENT_MONTHS) -> DataFrame:
    """DOC15: attempts in the latest ``months`` calendar months present.

    The latest months are a top-k of the distinct months (``months`` rows,
    broadcast); the attempts are never ranked.
    """
    m = cp.where(fx.nonblank("attempt_month")).select("attempt_month").distinct()
    top = m.orderBy(F.col("attempt_month").desc()).limit(months)
    return cp.join(F.broadcast(top), "attempt_month", "left_semi")


def cohort_specialization_heatmap(csk: DataFrame) -> DataFrame:
    """DOC18: cohort x specialization average score (long form of V16)."""
    return csk.select("cohort", "specialization", "avg_score_pct", "attempts")


def service_center(csp: DataFrame, tech: DataFrame, hide_unmapped: bool = True) -> tuple[DataFrame, DataFrame]:
    """DOC19: service-center roster (V20) and tech coverage (V18), optionally without 'Unmapped'."""
    if hide_unmapped:
        csp = csp.where(F.col("specialization") != "Unmapped")
        tech = tech.where(F.col("specialization") != "Unmapped")
    return csp, tech


def documented_slicers(ca: DataFrame, domains: Sequence[str] | None = None, proficiency: Sequence[str] | None = None,
                       sources: Sequence[str] | None = None, categories: Sequence[str] | None = None,
                       silver: Silver | None = None) -> DataFrame:
    """DOC20: domain, category, proficiency and candidate-source slicers on V14.

    An attempt belongs to the categories of the questions in its test's
    domain; the category slicer needs ``silver`` for those.
    """
    if categories:
        names = latest_by_id(silver.category, "name").where(F.col("name").isin(list(categories))).select(F.col("id").alias("c_id"))
        fields = latest_by_id(silver.domain, "name").select(F.col("id").alias("d_id"), F.col("name").alias("domain_name"))
        q = latest_by_id(silver.question, "categoryid", "domainid").select("categoryid", "domainid")
        held = (q.join(names, F.col("categoryid") == F.col("c_id"), "left_semi").select("domainid").distinct()
                .join(fields, F.col("domainid") == F.col("d_id")).select("domain_name"))
        ca = ca.join(held, "domain_name", "left_semi").select(*ca.columns)
    return apply_slicers(ca, domain_name=domains, proficiency_level=proficiency, candidate_source=sources)
