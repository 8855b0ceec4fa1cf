"""Cohort / specialization views.

``cohort_attempt`` (V14) extends the per-attempt base with specialization,
program, cohort and center. Everything else aggregates it, except the two
question-grain views (V18 content coverage, V23 per-question efficacy).

Plan notes:
* the taker-level cohort resolution (dispatch tags, JSON parse, explode,
  keyword match, one program per taker) is computed once per taker and
  joined to the attempts on the taker id;
* crosswalks and the keyword vocabulary are literal seeds of known size and
  are broadcast; the keyword match is a substring (theta) join against the
  broadcast vocabulary;
* grouped measures use partial (map-side) aggregation, so a hot cohort or
  specialization is pre-aggregated before the shuffle; ``latest`` / ``first``
  attempt values are ``max_by`` / ``min_by`` aggregates for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from examlytics.functions import scalar as fx
from examlytics.operators.combine import grouped_with_distinct
from examlytics.operators.dedup import dedup_latest
from examlytics.operators.joins import as_planned, spread_nulls
from examlytics.operators.nested import explode_tags, parse_results, parse_tags, result_fields
from examlytics.operators.windows import rank_over
from examlytics.plans import seeds
from examlytics.plans.org import latest_by_id
from examlytics.sources.silver import Silver

# Labels used when the mapping tables do not resolve a row.
UNMAPPED = "Unmapped"
UNASSIGNED = "Unassigned"
TRAINING_CENTER = "Training Center"
SERVICE_CENTER = "Service Center"
UNCLASSIFIED = "Unclassified"
APTITUDE_KEYWORD = "aptitude"


def taker_cohort(spark: SparkSession, silver: Silver, vocabulary: DataFrame | None = None) -> DataFrame:
    """Per taker: program (keyword match), cohort year and assessment type.

    Dispatch group tags win over the taker's own tags unless they are ``[]``;
    the anchor date falls back from dispatch commence date to dispatch
    creation to taker creation. One program per taker: the smallest
    (program, tag) pair among matches.
    """
    vocab = vocabulary if vocabulary is not None else seeds.cohort_tag_vocabulary(spark)
    taker = latest_by_id(silver.assessmenttaker, "tags", "dispatchid", "createdat").alias("at")
    disp = latest_by_id(silver.dispatch, "tags", "commencedate", "createdat").alias("d")
    tt = taker.join(disp, F.col("at.dispatchid") == F.col("d.id"), "left").select(
        F.col("at.id").alias("taker_id"),
        parse_tags(F.coalesce(F.nullif(F.col("d.tags"), F.lit("[]")), F.col("at.tags"))).alias("tags_arr"),
        F.coalesce(F.col("d.commencedate"), F.col("d.createdat"), F.col("at.createdat")).alias("anchor_date"))
    # One pass: every tag with its matching keyword (if any), then one row per taker.
    tags = explode_tags(tt, "tags_arr", keep_empty=True)
    low = F.lower(F.col("tag"))
    matched = tags.join(F.broadcast(vocab), low.contains(F.col("keyword")), "left")
    year = F.coalesce(F.nullif(F.regexp_extract(F.col("tag"), fx.COHORT_YEAR_PATTERN, 0), F.lit("")),
                      F.substring("anchor_date", 1, 4))
    choice = F.when(F.col("program").isNotNull(), F.struct(
        F.col("program"), F.col("tag"), year.isNull().alias("none"), year.alias("year")))
    g = matched.groupBy("taker_id").agg(F.min(choice).alias("pick"), F.max(low.contains(APTITUDE_KEYWORD)).alias("aptitude"))
    return g.select("taker_id", F.col("pick.program").alias("program_type"), F.col("pick.year").alias("cohort_year"),
                    F.when(F.col("aptitude"), F.lit("Aptitude")).alias("assessment_type"))


def cohort_attempt(spark: SparkSession, cp: DataFrame, silver: Silver, algo: str = "xxh64",
                   force_map: bool = True, crosswalk: DataFrame | None = None,
                   vocabulary: DataFrame | None = None, dimension=as_planned) -> DataFrame:
    """V14 ``cohort_specialization_attempt`` (``force_map=False``: DOC16).

    ``force_map=True`` (the deployed rule): every attempt gets one of the
    eight real specializations (crosswalk hit that is not excluded, else a
    deterministic hash bucket of domain / test / e-mail) and a program (tag
    match, else a hash bucket of the e-mail); nothing is excluded.
    ``force_map=False`` (the documented rule): unmatched domains are
    ``Unmapped``, excluded domains are flagged, takers without a program tag
    are in cohort ``Unassigned`` and the center is derived.
    ``algo`` picks the bucket hash: ``xxh64`` (the source's) or ``md5``;
    ``dimension`` is as in :func:`examlytics.plans.org.candidate_performance`.
    """
    cw = crosswalk if crosswalk is not None else seeds.specialization_crosswalk(spark)
    tc = taker_cohort(spark, silver, vocabulary).select(
        F.col("taker_id").alias("tc_taker_id"), F.col("program_type").alias("tc_program_type"),
        F.col("cohort_year").alias("tc_cohort_year"), F.col("assessment_type").alias("tc_assessment_type"))
    test = dimension(latest_by_id(silver.test, "domainid").select(F.col("id").alias("te_id"), "domainid"), "test-domains")
    # Crosswalk and bucket depend on the domain's name alone: once per domain, not per attempt.
    dom = seeds.norm_join(latest_by_id(silver.domain, "name").select(F.col("id").alias("d_id"), F.col("name").alias("domain_name")),
                          "domain_name", cw, "cw")
    if force_map:
        dom = dom.withColumn("d_bucket", fx.hash_bucket("domain_name", seeds.FORCE_MAP_SPECIALIZATIONS, algo))
    dom = dimension(dom, "domains")
    keyed = cp.withColumn("__taker", spread_nulls("assessment_taker_id", "test_id", "attempt_number"))
    j = (keyed.join(tc, F.col("__taker") == F.col("tc_taker_id"), "left")
         .join(test, F.col("test_id") == F.col("te_id"), "left")
         .join(dom, F.col("domainid") == F.col("d_id"), "left"))

    excluded = F.coalesce(F.col("cw_is_excluded"), F.lit(False))
    if force_map:
        spec = F.coalesce(F.when(F.col("cw_is_excluded") == F.lit(False), F.col("cw_specialization")),
                          F.col("d_bucket"),
                          fx.hash_bucket(F.coalesce("test_id", "email"), seeds.FORCE_MAP_SPECIALIZATIONS, algo))
        program = F.coalesce(F.col("tc_program_type"),
                             fx.hash_bucket("email", seeds.FORCE_MAP_PROGRAMS, algo))
        is_excluded = F.lit(False)
        cohort = F.concat(F.coalesce(F.col("tc_cohort_year"), F.col("attempt_year"), F.lit("Unknown")),
                          F.lit(" "), program)
        center = F.lit(TRAINING_CENTER)
        has_spec = F.when(excluded, F.lit(0)).otherwise(F.lit(1))
        has_cohort = F.lit(1)
    else:
        spec = F.coalesce(F.col("cw_specialization"), F.lit(UNMAPPED))
        program = F.col("tc_program_type")
        is_excluded = excluded
        cohort = F.when(program.isNull(), F.lit(UNASSIGNED)).otherwise(F.concat(
            F.coalesce(F.col("tc_cohort_year"), F.col("attempt_year"), F.lit("Unknown")), F.lit(" "), program))
        real_spec = F.col("cw_specialization").isNotNull() & ~excluded
        center = (F.when(program.isNotNull(), F.lit(TRAINING_CENTER))
                  .when(real_spec, F.lit(SERVICE_CENTER)).otherwise(F.lit(UNCLASSIFIED)))
        has_spec = F.when(real_spec, F.lit(1)).otherwise(F.lit(0))
        has_cohort = F.when(program.isNotNull(), F.lit(1)).otherwise(F.lit(0))

    return j.select(
        "assessment_taker_id", "candidatename", "email", "candidate_source", "organization_id",
        "organization_name", "test_id", "test_title", "test_difficulty", "domain_name",
        spec.alias("specialization"),
        is_excluded.alias("is_excluded"),
        program.alias("program_type"),
        F.col("tc_assessment_type").alias("assessment_type"),
        F.coalesce(F.col("tc_cohort_year"), F.col("attempt_year")).alias("cohort_year"),
        cohort.alias("cohort"),
        center.alias("center"),
        has_spec.alias("has_specialization"),
        has_cohort.alias("has_cohort"),
        "score_pct", "is_pass", "pass_status", "proficiency_level",
        F.col("attempt_number").try_cast("int").alias("attempt_number"),
        "total_attempts_before_pass", "duration_min",
        F.col("violation_count").try_cast("double").alias("violation_count"),
        F.col("violation_duration_sec").try_cast("double").alias("violation_duration_sec"),
        F.col("questions_failed").try_cast("double").alias("questions_failed"),
        F.col("questions_total").try_cast("double").alias("questions_total"),
        "start_time", "attempt_month", "attempt_quarter", "attempt_year", "load_date")


# ---------------------------------------------------------------------------
# Measures shared by the cohort rollups
# ---------------------------------------------------------------------------
def _count_when(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 END)``: NULL (not 0) when nothing matches."""
    return F.sum(F.when(cond, F.lit(1)))


def _level_pct(level: str) -> Column:
    return fx.pct_dec1(_count_when(F.col("proficiency_level") == level), F.count(F.lit(1)))


def _median(c: str) -> Column:
    return F.percentile_approx(c, 0.5, 10000)


def first_attempt_pass_rate() -> Column:
    """First-attempt passes over first attempts, one-decimal percentage (NULL when none)."""
    return _first_attempt_pass_rate()


def _first_attempt_pass_rate() -> Column:
    first = F.col("attempt_number") == 1
    return fx.pct_dec1(_count_when(first & (F.col("is_pass") == 1)), _count_when(first))


def _completion_rate() -> Column:
    qt, qf = F.col("questions_total"), F.col("questions_failed")
    return F.avg((qt - qf) / F.nullif(qt, F.lit(0))) * F.lit(100)


def cohort_kpis(spark: SparkSession, ca: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """V15 ``cohort_performance_kpis``."""
    ref = reference if reference is not None else seeds.program_reference(spark)
    j = ca.join(F.broadcast(ref), ca.program_type == ref.program, "left")
    keys = ["cohort", "program_type", "cohort_year", "center", "duration_months"]
    g = grouped_with_distinct(j, keys, [
        F.count(F.lit(1)).alias("attempts"),
        fx.pct_dec1(F.sum("is_pass"), F.count(F.lit(1))).alias("pass_rate_pct"),
        _first_attempt_pass_rate().alias("first_attempt_pass_rate_pct"),
        F.avg("score_pct").alias("avg_score_pct"),
        _median("score_pct").alias("median_score_pct"),
        _level_pct("Advanced").alias("pct_advanced"),
        _level_pct("Intermediate").alias("pct_intermediate"),
        _level_pct("Beginner").alias("pct_beginner"),
        F.avg(F.col("total_attempts_before_pass").cast("double")).alias("avg_attempts_to_pass"),
        F.avg("duration_min").alias("avg_duration_min"),
        _completion_rate().alias("completion_rate_pct"),
        F.sum("violation_count").alias("total_violations"),
        F.avg("violation_count").alias("avg_violations_per_attempt")],
        {"unique_candidates": "assessment_taker_id"})
    return g.select(*keys, "attempts", "unique_candidates", "pass_rate_pct", "first_attempt_pass_rate_pct",
                    "avg_score_pct", "median_score_pct", "pct_advanced", "pct_intermediate", "pct_beginner",
                    "avg_attempts_to_pass", "avg_duration_min", "completion_rate_pct", "total_violations",
                    "avg_violations_per_attempt")


def cohort_specialization_kpis(ca: DataFrame) -> DataFrame:
    """V16 ``cohort_specialization_kpis`` (excluded attempts left out)."""
    keys = ["cohort", "cohort_year", "program_type", "specialization", "center"]
    g = grouped_with_distinct(ca.where(~F.col("is_excluded")), keys, [
        F.count(F.lit(1)).alias("attempts"),
        fx.pct_dec1(F.sum("is_pass"), F.count(F.lit(1))).alias("pass_rate_pct"),
        F.avg("score_pct").alias("avg_score_pct"),
        _median("score_pct").alias("median_score_pct"),
        _level_pct("Advanced").alias("pct_advanced"),
        _level_pct("Intermediate").alias("pct_intermediate"),
        _level_pct("Beginner").alias("pct_beginner"),
        F.avg(F.col("total_attempts_before_pass").cast("double")).alias("avg_attempts_to_pass"),
        F.avg("duration_min").alias("avg_duration_min"),
        F.sum("violation_count").alias("total_violations")],
        {"unique_candidates": "assessment_taker_id"})
    return g.select(*keys, "attempts", "unique_candidates", "pass_rate_pct", "avg_score_pct", "median_score_pct",
                    "pct_advanced", "pct_intermediate", "pct_beginner", "avg_attempts_to_pass",
                    "avg_duration_min", "total_violations")


def specialization_kpis(ca: DataFrame) -> DataFrame:
    """V17 ``specialization_performance_kpis``."""
    g = grouped_with_distinct(ca.where(~F.col("is_excluded")), ["specialization"], [
        F.count(F.lit(1)).alias("attempts"),
        fx.pct_dec1(F.sum("is_pass"), F.count(F.lit(1))).alias("pass_rate_pct"),
        _first_attempt_pass_rate().alias("first_attempt_pass_rate_pct"),
        F.avg("score_pct").alias("avg_score_pct"),
        _median("score_pct").alias("median_score_pct"),
        _level_pct("Advanced").alias("pct_advanced"),
        _level_pct("Intermediate").alias("pct_intermediate"),
        _level_pct("Beginner").alias("pct_beginner"),
        F.avg(F.col("total_attempts_before_pass").cast("double")).alias("avg_attempts_to_pass"),
        F.avg("duration_min").alias("avg_duration_min"),
        _completion_rate().alias("completion_rate_pct"),
        F.sum("violation_count").alias("total_violations")],
        {"unique_candidates": "assessment_taker_id"})
    return g.select("specialization", "attempts", "unique_candidates", "pass_rate_pct",
                    "first_attempt_pass_rate_pct", "avg_score_pct", "median_score_pct", "pct_advanced",
                    "pct_intermediate", "pct_beginner", "avg_attempts_to_pass", "avg_duration_min",
                    "completion_rate_pct", "total_violations")


def specialization_tech_kpis(spark: SparkSession, silver: Silver, crosswalk: DataFrame | None = None,
                             category_crosswalk: DataFrame | None = None) -> DataFrame:
    """V18 ``specialization_tech_kpis``: question content by specialization and tech."""
    cw = crosswalk if crosswalk is not None else seeds.specialization_crosswalk(spark)
    cc = category_crosswalk if category_crosswalk is not None else seeds.category_crosswalk(spark)
    q = latest_by_id(silver.question, "categoryid", "domainid", "calibrationscore", "difficultylevel")
    cat = latest_by_id(silver.category, "name").select(F.col("id").alias("c_id"), F.col("name").alias("c_name"))
    dom = latest_by_id(silver.domain, "name").select(F.col("id").alias("d_id"), F.col("name").alias("d_name"))
    j = (q.join(cat, F.col("categoryid") == F.col("c_id"), "left")
         .join(dom, F.col("domainid") == F.col("d_id"), "left"))
    j = seeds.norm_join(j, "c_name", cc, "cc")
    j = seeds.norm_join(j, "d_name", cw, "cw")
    lvl = F.col("difficultylevel")
    return j.groupBy(
        F.coalesce("cc_specialization", "cw_specialization", F.lit(UNMAPPED)).alias("specialization"),
        F.coalesce("cc_tech", F.lit(UNMAPPED)).alias("tech")).agg(
        F.count_distinct("id").alias("questions"),
        F.avg(F.col("calibrationscore").try_cast("double")).alias("avg_calibration_score"),
        F.count_distinct(F.when(lvl == "hard", F.col("id"))).alias("hard_questions"),
        F.count_distinct(F.when(lvl == "medium", F.col("id"))).alias("medium_questions"),
        F.count_distinct(F.when(lvl == "easy", F.col("id"))).alias("easy_questions"))


def _latest_key() -> Column:
    """Ordering for "latest attempt" picks (G14 refinement).

    The source orders by attempt_number alone (always 1, so its pick is
    arbitrary). Ties are broken by start time, test and taker id; rows with
    a NULL attempt number are ignored as the source's MAX_BY ignores them.
    """
    return F.when(F.col("attempt_number").isNotNull(), F.struct(
        F.col("attempt_number"),
        F.coalesce(F.col("start_time").cast("string"), F.lit("")),
        F.coalesce(F.col("test_id"), F.lit("")),
        F.coalesce(F.col("assessment_taker_id"), F.lit(""))))


CANDIDATE_COLS = ["candidatename", "candidate_source", "attempts", "tests_taken", "pass_rate_pct", "avg_score_pct",
                  "best_score_pct", "latest_score_pct", "latest_proficiency", "score_improvement",
                  "integrity_risk_score"]


def _candidates(ca: DataFrame, keys: list[str]) -> DataFrame:
    """Per-person measures; the distinct test count is its own aggregate (see grouped_with_distinct).

    Name and source are functions of the e-mail in V1, so they are constant
    within an e-mail group: grouping by them (instead of aggregating them
    with ARBITRARY/min) gives the same groups and keeps string buffers out
    of the aggregate.
    """
    g = grouped_with_distinct(ca, keys + ["candidatename", "candidate_source"], _candidate_measures(),
                              {"tests_taken": "test_id"})
    return g.select(*keys, *CANDIDATE_COLS)


def _candidate_measures() -> list[Column]:
    k = _latest_key()
    return [
        F.count(F.lit(1)).alias("attempts"),
        fx.pct_dec1(F.sum("is_pass"), F.count(F.lit(1))).alias("pass_rate_pct"),
        F.avg("score_pct").alias("avg_score_pct"),
        F.max("score_pct").alias("best_score_pct"),
        F.max_by("score_pct", k).alias("latest_score_pct"),
        F.max_by("proficiency_level", k).alias("latest_proficiency"),
        (F.max_by("score_pct", k) - F.min_by("score_pct", k)).alias("score_improvement"),
        fx.integrity_risk(F.sum("violation_count"), F.sum("violation_duration_sec")).alias("integrity_risk_score"),
    ]


def _ranked(cand: DataFrame, part: str, rank_name: str, pct_name: str) -> DataFrame:
    """RANK() by avg score DESC NULLS LAST and PERCENT_RANK() ASC NULLS LAST within ``part``.

    Computed with :func:`rank_over` (range-partitioned), so one cohort or
    specialization holding most candidates is still spread over many tasks.
    NULL scores rank after all values; the partition size for PERCENT_RANK
    counts them too.
    """
    r = rank_over(cand, "avg_score_pct", partition=[part], descending=True, out_prefix="__")
    sizes = cand.groupBy(part).agg(F.count(F.lit(1)).alias("__size"))
    r = r.join(sizes.withColumnRenamed(part, "__part"), r[part].eqNullSafe(F.col("__part")), "left").drop("__part")
    nn = F.coalesce(F.col("__n"), F.lit(0))
    rank = F.when(F.col("avg_score_pct").isNotNull(), F.col("__rank_min")).otherwise(nn + 1)
    below = F.when(F.col("avg_score_pct").isNotNull(), F.col("__n") - (F.col("__rank_min") - 1) - F.col("__ties")) \
        .otherwise(nn)
    size = F.col("__size")
    pr = F.when(size > 1, below.cast("double") / (size - 1).cast("double")).otherwise(F.lit(0.0))
    return r.select(*cand.columns, rank.cast("int").alias(rank_name), pr.alias(pct_name))


def cohort_candidates(ca: DataFrame) -> DataFrame:
    """Measures per person and cohort (V19 before ranking)."""
    return _candidates(ca, ["cohort", "cohort_year", "program_type", "center", "email"])


def specialization_candidates(ca: DataFrame) -> DataFrame:
    """Measures per person and specialization (V20 before ranking)."""
    return _candidates(ca.where(~F.col("is_excluded")), ["specialization", "center", "email"])


def candidate_cohort_performance(ca: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """V19 ``candidate_cohort_performance``: one row per person per cohort, ranked.

    The ranking reads the measures several times: ``candidates`` may be
    :func:`cohort_candidates` kept as a table.
    """
    cand = candidates if candidates is not None else cohort_candidates(ca)
    return _ranked(cand, "cohort", "rank_in_cohort", "percentile_in_cohort")


def candidate_specialization_performance(ca: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """V20 ``candidate_specialization_performance``; ``candidates`` as in V19."""
    cand = candidates if candidates is not None else specialization_candidates(ca)
    return _ranked(cand, "specialization", "rank_in_specialization", "percentile_in_specialization")


def cohort_progression(ca: DataFrame) -> DataFrame:
    """V21 ``cohort_progression_trend``."""
    return ca.where(fx.nonblank("attempt_month")).groupBy(
        "cohort", "cohort_year", "program_type", "specialization", "attempt_month", "attempt_quarter").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_distinct("assessment_taker_id").alias("unique_candidates"),
        fx.pct_dec1(F.sum("is_pass"), F.count(F.lit(1))).alias("pass_rate_pct"),
        F.avg("score_pct").alias("avg_score_pct"))


def coverage(ca: DataFrame) -> DataFrame:
    """V22 ``additional_analytics_coverage``: one-row resolution gauge."""
    spec, cohort = F.col("specialization"), F.col("cohort")
    one_zero = lambda cond: F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))
    return ca.agg(
        F.count(F.lit(1)).alias("total_attempts"),
        F.sum("has_specialization").alias("real_specialization_attempts"),
        one_zero(F.col("is_excluded")).alias("excluded_attempts"),
        one_zero(spec == UNMAPPED).alias("unmapped_specialization_attempts"),
        F.sum("has_cohort").alias("attempts_with_cohort"),
        (F.avg(F.col("has_specialization").cast("double")) * F.lit(100.0)).alias("pct_specialization_resolved"),
        (F.avg(F.col("has_cohort").cast("double")) * F.lit(100.0)).alias("pct_cohort_resolved"),
        F.count_distinct(F.when(F.col("has_specialization") == 1, spec)).alias("distinct_specializations"),
        F.count_distinct(F.when(cohort != UNASSIGNED, cohort)).alias("distinct_cohorts"),
        one_zero(cohort == UNASSIGNED).alias("unassigned_cohort_attempts"))


def has_results() -> Column:
    """Whether the result looks like a JSON array of objects."""
    return fx.nonblank(F.col("result")) & F.col("result").startswith("[{")


def latest_valid_results(silver: Silver) -> DataFrame:
    """DED9: latest snapshot per attempt among rows whose result looks like a JSON array of objects."""
    return dedup_latest(
        silver.testresult.select("assessmenttakerid", "testid", "attemptnumber", "result", "load_date"),
        keys=["assessmenttakerid", "testid", "attemptnumber"],
        pre_filter=has_results())


def question_responses(silver: Silver, mode: str = "PERMISSIVE") -> DataFrame:
    """One row per served question of each latest valid attempt (U3 + U4)."""
    t = latest_valid_results(silver)
    return (t.select("assessmenttakerid", "testid", "attemptnumber",
                     F.posexplode(parse_results("result", mode)).alias("pos", "q"))
            .select("assessmenttakerid", "testid", "attemptnumber", "pos", *result_fields("q")))


def question_performance(spark: SparkSession, silver: Silver, crosswalk: DataFrame | None = None,
                         mode: str = "PERMISSIVE") -> DataFrame:
    """V23 ``question_performance``: per-question efficacy over all latest attempts.

    The per-question aggregate is partial on each map task, so a question
    served in a large share of attempts is combined before the shuffle.
    """
    cw = crosswalk if crosswalk is not None else seeds.specialization_crosswalk(spark)
    p = question_responses(silver, mode)
    agg = p.where(F.col("question_id").isNotNull()).groupBy("question_id").agg(
        F.count(F.lit(1)).alias("times_served"),
        F.sum(F.when(F.col("is_answered"), F.lit(1)).otherwise(F.lit(0))).alias("times_answered"),
        F.sum(F.when(F.col("achieved_score") > 0, F.lit(1)).otherwise(F.lit(0))).alias("times_correct"),
        F.avg("idle_time_sec").alias("avg_idle_sec"),
        (F.avg(F.when(F.col("max_score") > 0, F.col("achieved_score") / F.col("max_score"))) * F.lit(100.0))
        .alias("avg_score_ratio_pct"),
        F.avg("max_score").alias("avg_max_score"))
    qd = latest_by_id(silver.question, "questiontype", "difficultylevel", "questiontitle", "questiontext",
                      "domainid").withColumnRenamed("id", "q_id")
    dom = latest_by_id(silver.domain, "name").select(F.col("id").alias("d_id"), F.col("name").alias("domain_name"))
    j = (agg.join(qd, F.col("question_id") == F.col("q_id"), "left")
         .join(dom, F.col("domainid") == F.col("d_id"), "left"))
    j = seeds.norm_join(j, "domain_name", cw, "cw")
    return j.select(
        "question_id",
        F.col("questiontype").alias("question_type"),
        F.col("difficultylevel").alias("question_difficulty"),
        F.col("questiontitle").alias("question_title"),
        F.col("questiontext").alias("question_text"),
        F.coalesce(F.col("cw_specialization"), F.lit(UNMAPPED)).alias("specialization"),
        "domain_name", "times_served", "times_answered", "times_correct",
        fx.pct_dec1("times_answered", "times_served").alias("answer_rate_pct"),
        fx.pct_dec1("times_correct", "times_served").alias("correct_rate_pct"),
        "avg_idle_sec", "avg_score_ratio_pct", "avg_max_score")
