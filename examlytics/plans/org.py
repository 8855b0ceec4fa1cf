"""Executive / organization views (one attempt grain and its rollups).

``candidate_performance`` (V1) is the per-attempt base every other view and
mart reads. It deduplicates the silver snapshots, left-joins the taker,
test and organization dimensions and derives the attempt attributes.

Physical plan: the fact side (test results) and the taker dimension are
both as large as the number of sittings, so they meet in a shuffle join on
the taker id (NULL ids dealt over many partitions); the attempt count per
(taker, test) is a window over that join's own partitioning. The test and
organization dimensions are joined plainly and become broadcasts when
adaptive execution measures them small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from examlytics.functions import scalar as fx
from examlytics.operators.dedup import dedup_latest
from examlytics.operators.combine import one_row
from examlytics.operators.joins import as_planned, spread_nulls
from examlytics.operators.windows import sequence_over
from examlytics.sources.silver import Silver

TESTRESULT_COLS = ["assessmenttakerid", "testid", "attemptnumber", "starttime", "finishtime",
                   "duration", "testpercentage", "passstatus", "title", "testwindowviolationcount",
                   "testwindowviolationduration", "numberofquestionsfailed", "numberofquestions",
                   "load_date"]


OPTIONAL_COLS = ["numberofquestionsanswered"]


def valid_start(year_from: str = fx.YEAR_WINDOW[0], year_to: str = fx.YEAR_WINDOW[1]) -> Column:
    s = F.col("starttime")
    return fx.nonblank(s) & F.substring(s, 1, 4).between(year_from, year_to)


def latest_attempts(silver: Silver, year_from: str = fx.YEAR_WINDOW[0],
                    year_to: str = fx.YEAR_WINDOW[1]) -> DataFrame:
    """DED1: latest snapshot per (taker, test, attempt) among rows with a valid start.

    Optional source columns (:data:`OPTIONAL_COLS`) come along where the table has them.
    """
    optional = [c for c in OPTIONAL_COLS if c in silver.testresult.columns]
    return dedup_latest(
        silver.testresult.select(*TESTRESULT_COLS, *optional),
        keys=["assessmenttakerid", "testid", "attemptnumber"],
        order=["load_date", "finishtime"],
        pre_filter=valid_start(year_from, year_to))


def latest_attempts_all(silver: Silver) -> DataFrame:
    """Latest snapshot per (taker, test, attempt), no start-time filter, without the result JSON.

    The JSON text is large and the attempt-level figures do not need it, so
    it is neither carried through the shuffle nor used as a tiebreak.
    """
    cols = [c for c in silver.testresult.columns if c != "result"]
    return dedup_latest(silver.testresult.select(*cols), keys=["assessmenttakerid", "testid", "attemptnumber"],
                        order=["load_date", "finishtime"])


def latest_by_id(df: DataFrame, *cols: str) -> DataFrame:
    """DED2-DED8: latest snapshot per id, projected to ``cols``."""
    return dedup_latest(df.select("id", *cols, "load_date"), keys=["id"]).select("id", *cols)


def candidate_performance(silver: Silver, internal_pattern: str = fx.INTERNAL_DOMAIN_PATTERN,
                          advanced: float = fx.PROFICIENCY_ADVANCED_MIN,
                          intermediate: float = fx.PROFICIENCY_INTERMEDIATE_MIN,
                          year_from: str = fx.YEAR_WINDOW[0], year_to: str = fx.YEAR_WINDOW[1], dimension=as_planned) -> DataFrame:
    """V1 ``trainer_candidate_performance``: one row per deduplicated attempt, 30 columns.

    ``dimension`` may keep the deduplicated tests and organizations and
    broadcast the small ones (:class:`examlytics.operators.joins.SizedDimensions`).
    """
    tr = latest_attempts(silver, year_from, year_to)
    taker = latest_by_id(silver.assessmenttaker, "email", "assessmentid", "organizationid").select(
        F.col("id").alias("at_id"), F.col("email").alias("at_email"), F.col("assessmentid").alias("at_assessmentid"),
        F.col("organizationid").alias("at_organizationid"))
    test = dimension(latest_by_id(silver.test, "title", "difficultylevel").select(
        F.col("id").alias("t_id"), F.col("difficultylevel").alias("t_difficulty")), "tests")
    org = dimension(latest_by_id(silver.organization, "organizationname").select(
        F.col("id").alias("o_id"), F.col("organizationname").alias("o_name")), "organizations")

    # One pass: the taker join and the attempt count share one partitioning,
    # by the taker id with its NULLs dealt out (they match no taker). A NULL
    # key never matched in the source's self-join, so its count stays NULL. A
    # (taker, test) partition holds one row per attempt number (the dedup
    # key), so the window is bounded by construction.
    keyed = tr.withColumn("__taker", spread_nulls("assessmenttakerid", "testid", "attemptnumber"))
    both = F.col("assessmenttakerid").isNotNull() & F.col("testid").isNotNull()
    counted = F.count(F.lit(1)).over(Window.partitionBy("__taker", "testid"))
    j = (keyed.join(taker, F.col("__taker") == F.col("at_id"), "left")
         .withColumn("__attempts", F.when(both, counted))
         .join(test, F.col("testid") == F.col("t_id"), "left")
         .join(org, F.col("at_organizationid") == F.col("o_id"), "left"))

    st = F.col("starttime")
    score = F.col("testpercentage").cast("double")
    metrics = j.select(
        F.col("assessmenttakerid").alias("assessment_taker_id"),
        fx.sql_candidate_name("at_email").alias("candidatename"),
        F.col("at_email").alias("email"),
        fx.email_domain("at_email").alias("email_domain"),
        F.col("at_organizationid").alias("organization_id"),
        F.coalesce(F.col("o_name"), F.col("at_organizationid"), F.lit("Unknown")).alias("organization_name"),
        F.col("at_assessmentid").alias("assessment_id"),
        F.col("testid").alias("test_id"),
        F.col("title").alias("test_title"),
        st.alias("start_time_raw"),
        F.col("finishtime").alias("finish_time_raw"),
        fx.iso_to_timestamp(st).alias("start_time"),
        (F.col("duration").try_cast("double") / F.lit(60.0)).alias("duration_min"),
        score.alias("score_pct"),
        fx.normalise_pass("passstatus").alias("pass_status"),
        F.col("attemptnumber").alias("attempt_number"),
        F.col("testwindowviolationcount").alias("violation_count"),
        F.col("testwindowviolationduration").alias("violation_duration_sec"),
        F.col("numberofquestionsfailed").alias("questions_failed"),
        F.col("numberofquestions").alias("questions_total"),
        F.col("load_date").alias("load_date"),
        fx.month_text(st).alias("attempt_month"),
        fx.year_text(st).alias("attempt_year"),
        fx.quarter_label(st).alias("attempt_quarter"),
        F.col("t_difficulty").alias("test_difficulty"),
        fx.proficiency_level(score, advanced, intermediate).alias("proficiency_level"),
        F.when(fx.nonblank("finishtime"), F.lit(1)).otherwise(F.lit(0)).alias("is_complete"),
        F.col("__attempts").alias("total_attempts_before_pass"),
    )
    return metrics.select(
        *[c for c in metrics.columns if c != "total_attempts_before_pass"], "total_attempts_before_pass",
        F.when(F.col("pass_status") == "passed", F.lit(1)).otherwise(F.lit(0)).alias("is_pass"),
        fx.candidate_source("email_domain", internal_pattern).alias("candidate_source"))


def executive_overview(cp: DataFrame, silver: Silver) -> DataFrame:
    """V2 ``executive_overview_kpis``: one row of top-line totals.

    Every part is a global aggregate (partial aggregation on each map task,
    one tiny final task); the one-row parts are stacked and collapsed into
    a single row, no join involved.
    """
    a = cp.agg(
        F.count(F.lit(1)).alias("total_attempts"),
        F.count_distinct("test_id").alias("total_unique_tests_taken"),
        F.avg("duration_min").alias("avg_duration_min"),
        F.sum("violation_count").alias("total_violations"),
        F.sum("is_pass").alias("total_pass"),
        F.sum(F.lit(1) - F.col("is_pass")).alias("total_fail"),
        F.avg("score_pct").alias("avg_score_pct"),
    )
    asmt = silver.assessment.agg(
        F.count_distinct("id").alias("total_assessments_created"),
        F.count_distinct(F.when(F.col("isdispatched") == F.lit(True), F.col("id")))
        .alias("total_assessments_dispatched"))
    tests = silver.test.agg(F.count_distinct("id").alias("total_tests_created"))
    qs = silver.question.agg(F.count_distinct("id").alias("total_questions_created"))
    # Previous attempt per (taker, test) by attempt number. (taker, test,
    # attempt) is unique after dedup, so a (taker, test) window partition
    # holds at most one row per attempt number, NULL takers included: the
    # window is bounded by construction.
    w = Window.partitionBy("assessment_taker_id", "test_id").orderBy(F.col("attempt_number").asc_nulls_last())
    gaps = (cp.where(F.col("start_time").isNotNull())
            .select(F.lag("start_time").over(w).alias("prev"), "start_time")
            .where(F.col("prev").isNotNull())
            .select(fx.diff_days("prev", "start_time").alias("d")))
    retake = gaps.agg(F.avg("d").alias("avg_retake_days"),
                      F.percentile_approx("d", 0.5, 10000).alias("median_retake_days"))
    out = one_row(a, asmt, tests, qs, retake)
    return out.select(
        "total_attempts", "total_unique_tests_taken", "avg_duration_min", "total_violations",
        "total_pass", "total_fail", fx.pct("total_pass", "total_attempts").alias("pass_rate_pct"),
        "avg_score_pct", "total_assessments_created", "total_assessments_dispatched",
        "total_tests_created", "total_questions_created", "avg_retake_days", "median_retake_days")


def _outcome_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("attempts"),
        F.sum("is_pass").alias("passes"),
        F.sum(F.lit(1) - F.col("is_pass")).alias("fails"),
    ]


def monthly_trend(cp: DataFrame) -> DataFrame:
    """V3 ``monthly_assessment_trend``."""
    keys = ["attempt_month", "attempt_quarter", "attempt_year", "test_difficulty",
            "organization_id", "organization_name"]
    g = (cp.where(fx.nonblank("attempt_month")).groupBy(*keys)
         .agg(*_outcome_measures(),
              F.avg("score_pct").alias("avg_score_pct"),
              F.avg("duration_min").alias("avg_duration_min"),
              F.sum("violation_count").alias("total_violations"),
              F.count_distinct("assessment_taker_id").alias("unique_candidates")))
    return g.select(*keys, "attempts", "passes", "fails", fx.pct("passes", "attempts").alias("pass_rate_pct"),
                    "avg_score_pct", "avg_duration_min", "total_violations", "unique_candidates")


def retake_intervals(cp: DataFrame) -> DataFrame:
    """V4 ``candidate_retake_intervals``: sittings after the first per (email, test).

    Sitting number and previous sitting come from :func:`sequence_over`
    (range-partitioned numbering + equi-join on the previous number), so a
    person/test key holding a large share of all sittings (a NULL e-mail,
    say) is spread over many tasks. Ties on start_time are broken by the
    taker id, then the attempt number, so numbers are deterministic.
    """
    rows = cp.where(F.col("start_time").isNotNull()).select(
        "assessment_taker_id", "candidatename", "email", "test_id", "test_title", "start_time",
        "score_pct", "is_pass", "pass_status", "attempt_year", "attempt_quarter", "attempt_month",
        "attempt_number")
    pairs = sequence_over(rows, ["email", "test_id"], ["start_time", "assessment_taker_id", "attempt_number"],
                          out="sitting_no", prev=["start_time", "score_pct"])
    secs = fx.diff_seconds("prev_start_time", "start_time")
    return pairs.where(F.col("prev_start_time").isNotNull()).select(
        "assessment_taker_id", "candidatename", "email", "test_id", "test_title", "sitting_no",
        "start_time", "prev_start_time", "score_pct", "prev_score_pct",
        (F.col("score_pct") - F.col("prev_score_pct")).alias("score_delta"),
        "is_pass", "pass_status", "attempt_year", "attempt_quarter", "attempt_month",
        fx.div_dec1(secs, 86400).alias("days_between_attempts"),
        fx.diff_hours("prev_start_time", "start_time").alias("hours_between_attempts"))


def quality_violations(cp: DataFrame) -> DataFrame:
    """V5 ``trainer_quality_violations``: projection plus severity slice."""
    return cp.select(
        "test_id", "test_title", "organization_id", "organization_name",
        F.col("questions_failed").alias("number_of_questions_failed"),
        F.col("violation_count").alias("test_window_violation_count"),
        F.col("violation_duration_sec").alias("test_window_violation_duration"),
        "load_date", "test_difficulty",
        fx.violation_severity("violation_count").alias("violation_severity_slice"))


def organization_overview(cp: DataFrame) -> DataFrame:
    """V6 ``organization_overview_kpis``."""
    g = cp.groupBy("organization_id", "organization_name").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_distinct("assessment_taker_id").alias("unique_candidates"),
        F.count_distinct("test_id").alias("unique_tests"),
        F.sum("is_pass").alias("passes"),
        F.sum(F.lit(1) - F.col("is_pass")).alias("fails"),
        F.avg("score_pct").alias("avg_score_pct"),
        F.avg("duration_min").alias("avg_duration_min"),
        F.sum("violation_count").alias("total_violations"))
    return g.select("organization_id", "organization_name", "attempts", "unique_candidates",
                    "unique_tests", "passes", "fails", fx.pct("passes", "attempts").alias("pass_rate_pct"),
                    "avg_score_pct", "avg_duration_min", "total_violations")


def organization_catalog(silver: Silver) -> DataFrame:
    """V7 ``organization_catalog_kpis``: catalog counts per organization.

    Counts run on the undeduplicated snapshots (an id that moved between
    organizations counts in both), as the source does. Each count is a
    grouped aggregate keyed by organization; the organization universe is
    the distinct union of the three tables' organization ids.
    """
    a = silver.assessment.groupBy(F.col("organizationid").alias("oid")).agg(
        F.count_distinct("id").alias("assessments_created"),
        F.count_distinct(F.when(F.col("isdispatched") == F.lit(True), F.col("id"))).alias("assessments_dispatched"))
    t = silver.test.groupBy(F.col("organizationid").alias("oid")).agg(F.count_distinct("id").alias("tests_created"))
    q = silver.question.groupBy(F.col("organizationid").alias("oid")).agg(
        F.count_distinct("id").alias("questions_created"))
    universe = (silver.assessment.select(F.col("organizationid").alias("oid"))
                .union(silver.test.select("organizationid"))
                .union(silver.question.select("organizationid")).distinct()
                .where(fx.nonblank("oid")))
    org = latest_by_id(silver.organization, "organizationname")
    j = (universe.join(a, "oid", "left").join(t, "oid", "left").join(q, "oid", "left")
         .join(org, F.col("oid") == F.col("id"), "left"))
    return j.select(
        F.col("oid").alias("organization_id"),
        F.coalesce("organizationname", "oid", F.lit("Unknown")).alias("organization_name"),
        F.coalesce("assessments_created", F.lit(0)).alias("assessments_created"),
        F.coalesce("assessments_dispatched", F.lit(0)).alias("assessments_dispatched"),
        F.coalesce("tests_created", F.lit(0)).alias("tests_created"),
        F.coalesce("questions_created", F.lit(0)).alias("questions_created"))


def trainer_kpis(silver: Silver) -> DataFrame:
    """V8 ``executive_trainer_kpis``: question productivity per creator."""
    q = latest_by_id(silver.question, "creator", "activeversionid", "calibrationscore", "status",
                     "difficultylevel")
    lvl = F.col("difficultylevel")
    return q.where(F.col("creator").isNotNull()).groupBy(F.col("creator").alias("trainer_id")).agg(
        F.count_distinct("id").alias("total_questions_created"),
        F.count_distinct("activeversionid").alias("active_questions"),
        F.avg(F.col("calibrationscore").cast("double")).alias("avg_calibration_score"),
        F.sum(F.when(F.col("status") == "active", F.lit(1)).otherwise(F.lit(0))).alias("live_questions"),
        F.count_distinct(F.when(lvl == "hard", F.col("id"))).alias("hard_questions_created"),
        F.count_distinct(F.when(lvl == "medium", F.col("id"))).alias("medium_questions_created"),
        F.count_distinct(F.when(lvl == "easy", F.col("id"))).alias("easy_questions_created"))


def data_freshness(silver: Silver) -> DataFrame:
    """V9 ``gold_data_freshness``: latest load_date per silver table."""
    # Labels of the freshness rows, in the source's order.
    parts = [("assessmenttaker", silver.assessmenttaker), ("testresult", silver.testresult),
             ("question", silver.question), ("assessment", silver.assessment),
             ("test", silver.test), ("organization", silver.organization)]
    out = None
    for name, df in parts:
        one = df.agg(F.max("load_date").alias("last_updated")).select(
            F.lit(name).alias("table_name"), "last_updated")
        out = one if out is None else out.unionByName(one)
    return out
