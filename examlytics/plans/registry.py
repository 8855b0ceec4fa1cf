"""Named analytical queries and view deployment.

``QUERIES`` maps a name to ``(spark, silver) -> DataFrame``. The order is the
dependency order of the source's view files (executive views first, then
cohort views), which :func:`register_all` follows when it publishes the
results as temp views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from pyspark.sql import functions as F

from examlytics.operators.combine import weighted_mean
from examlytics.operators.joins import point_lookup
from examlytics.operators.slicers import cascading_options
from examlytics.plans import cohort, cube, documented as doc, incremental, marts as m, medallion, org, profile
from examlytics.sources import ingest, lake
from examlytics.sources.fixtures import read_table, skills
from examlytics.plans.context import Analytics

ViewFn = Callable[[Analytics], DataFrame]

QUERIES: dict[str, ViewFn] = {
    "candidate_performance": lambda a: a.cp,
    "executive_overview": lambda a: org.executive_overview(a.cp, a.silver),
    "monthly_trend": lambda a: org.monthly_trend(a.cp),
    "retake_intervals": lambda a: a.retake,
    "quality_violations": lambda a: org.quality_violations(a.cp),
    "organization_overview": lambda a: org.organization_overview(a.cp),
    "organization_catalog": lambda a: org.organization_catalog(a.silver),
    "trainer_kpis": lambda a: org.trainer_kpis(a.silver),
    "data_freshness": lambda a: org.data_freshness(a.silver),
    # Cohort views use the context's bucket hash: the source's XXH64 unless the
    # caller asks for md5 (the check entry does, DuckDB has no XXH64).
    "cohort_attempt": lambda a: a.ca(),
    "cohort_attempt_xxh64": lambda a: a.ca("xxh64"),
    "cohort_kpis": lambda a: cohort.cohort_kpis(a.spark, a.ca()),
    "cohort_specialization_kpis": lambda a: cohort.cohort_specialization_kpis(a.ca()),
    "specialization_kpis": lambda a: cohort.specialization_kpis(a.ca()),
    "specialization_tech_kpis": lambda a: cohort.specialization_tech_kpis(a.spark, a.silver),
    "candidate_cohort_performance": lambda a: cohort.candidate_cohort_performance(a.ca(), a.candidates("cohort")),
    "candidate_specialization_performance": lambda a: cohort.candidate_specialization_performance(a.ca(), a.candidates("specialization")),
    "cohort_progression": lambda a: cohort.cohort_progression(a.ca()),
    "coverage": lambda a: cohort.coverage(a.ca()),
    "question_performance": lambda a: a.qp,
    # Executive marts (V1, no slicer selected = all attempts)
    "kpi_strip": lambda a: m.kpi_strip(a.cp, org.organization_catalog(a.silver), a.retake),
    "monthly_performance": lambda a: m.monthly_performance(a.cp),
    "quarterly_performance": lambda a: m.quarterly_yearly(a.cp, "attempt_quarter"),
    "yearly_performance": lambda a: m.quarterly_yearly(a.cp, "attempt_year"),
    "outcome_composition": lambda a: m.outcome_composition(a.cp),
    "outcome_by_level": lambda a: m.outcome_composition(a.cp, by_level=True),
    "monthly_violations": lambda a: m.monthly_violations(a.cp),
    "retake_interval_histogram": lambda a: m.retake_interval_histogram(a.retake),
    "executive_roster": lambda a: m.executive_roster(a.cp),
    "period_progression": lambda a: m.period_progression(a.cp, "attempt_year"),
    "attempt_questions": lambda a: _attempt_detail(a),
    "attempt_kpis": lambda a: m.attempt_kpis(_attempt_detail(a)),
    "question_outcomes": lambda a: m.question_outcomes(_attempt_detail(a)),
    "question_type_mix": lambda a: m.question_type_mix(_attempt_detail(a))[0],
    "question_score_mix": lambda a: m.question_type_mix(_attempt_detail(a))[1],
    "attempt_lookup": lambda a: point_lookup(a.cp, order_by=["start_time_raw"], test_id="t-10", attempt_number=1),
    "freshness_list": lambda a: m.freshness_list(org.data_freshness(a.silver)),
    # Training Center marts (V14 base with sitting numbers, no slicer selected)
    "training_base": lambda a: a.base,
    "data_trust": lambda a: m.data_trust(cohort.coverage(a.ca())),
    "outcomes_scorecard": lambda a: m.outcomes_scorecard(a.base),
    "attempts_to_pass": lambda a: m.attempts_to_pass(a.base),
    "question_accuracy": lambda a: m.question_accuracy(a.base),
    "integrity_rate": lambda a: m.integrity_rate(a.base),
    "readiness_funnel": lambda a: m.readiness_funnel(a.base),
    "proficiency_mix": lambda a: m.proficiency_mix(a.base),
    "specialization_summary": lambda a: m.specialization_summary(a.base),
    "score_distribution": lambda a: m.score_distribution(a.base),
    "level_summary": lambda a: m.level_summary(a.spark, a.base),
    "pass_by_sitting": lambda a: m.pass_by_sitting(a.base),
    "score_over_time": lambda a: m.score_over_time(a.base),
    "proficiency_migration": lambda a: m.proficiency_migration(a.base),
    "retake_score_change": lambda a: m.retake_score_change(a.base),
    "retake_gaps": lambda a: m.retake_gaps(a.base),
    "retake_medians": lambda a: m.retake_medians(a.base),
    "candidate_integrity": lambda a: m.candidate_integrity(a.base),
    "violation_rate": lambda a: m.violation_rate(a.base),
    "risk_watchlist": lambda a: m.risk_watchlist(a.base),
    "cohort_scorecard": lambda a: m.cohort_scorecard(a.base),
    "cohort_scores": lambda a: m.cohort_scores(a.base),
    "compare_specializations": lambda a: m.compare_groups(a.base, "specialization", "Backend", "Frontend"),
    "compare_cohorts": lambda a: m.compare_groups(a.base, "cohort", "2025 CDC", "2025 NSP"),
    "compare_years": lambda a: m.compare_groups(a.base, "year", "2025", "2026"),
    "question_rankings": lambda a: m.question_rankings(a.qp),
    "training_roster": lambda a: m.training_roster(a.base),
    # Ingest and medallion operators over the derived silver tables / events
    "latest_testresult_snapshot": lambda a: lake.latest_snapshot(a.silver.testresult),
    "gold_assessment_taker": lambda a: medallion.gold_transform(
        "test_creation_assessment_taker", lake.latest_snapshot(a.silver.assessmenttaker)),
    "gold_testresult": lambda a: medallion.gold_transform(
        "test_execution_testresult", lake.latest_snapshot(a.silver.testresult)),
    "gold_category": lambda a: _gold(a, "test_creation_category", a.silver.category),
    "gold_domain": lambda a: _gold(a, "test_creation_domain", a.silver.domain),
    "gold_test": lambda a: _gold(a, "test_creation_test", a.silver.test),
    "gold_question": lambda a: _gold(a, "test_creation_question", a.silver.question),
    "gold_assessment": lambda a: _gold(a, "test_creation_assessment", a.silver.assessment),
    "gold_assessment_dispatch": lambda a: _gold(a, "test_creation_assessment_dispatch", a.silver.dispatch),
    "gold_questionflag": lambda a: _gold(a, "test_execution_questionflag", a.silver.questionflag),
    "gold_skill": lambda a: _gold(a, "test_creation_skill", skills(read_table(a.spark, a.sf_dir, "part"))),
    "weighted_cohort_pass_rate": lambda a: cohort.cohort_specialization_kpis(a.ca()).groupBy("cohort").agg(
        weighted_mean("pass_rate_pct", "attempts").alias("weighted_pass_rate_pct"),
        F.sum("attempts").alias("attempts")),
    "events_incremental": lambda a: ingest.incremental_batch(
        read_table(a.spark, a.sf_dir, "events"), "ts", EVENTS_WATERMARK),
    # Documented-only views (formulas from the KPI dictionary; V24 inferred)
    "growth_tracking": lambda a: doc.growth_tracking(a.cp),
    "senior_insights": lambda a: doc.senior_insights(a.silver),
    "assessment_summary": lambda a: doc.assessment_summary(a.cp, a.silver),
    "kpi_month_deltas": lambda a: doc.kpi_month_deltas(a.cp),
    "integrity_composition": lambda a: doc.integrity_composition(doc.senior_insights(a.silver)),
    "completion_funnel": lambda a: doc.completion_funnel(a.cp),
    "domain_difficulty_heatmap": lambda a: doc.domain_difficulty_heatmap(a.ca()),
    "source_pass_rates": lambda a: doc.source_pass_rates(a.cp),
    "violations_by_severity": lambda a: doc.violations_by_severity(org.quality_violations(a.cp)),
    "violation_audit": lambda a: doc.violation_audit(a.ca()),
    "duration_scores": lambda a: doc.duration_scores(a.cp),
    "assessment_score_distribution": lambda a: m.score_distribution(a.cp, "test_title", "proficiency_level"),
    "cohort_specialization_heatmap": lambda a: doc.cohort_specialization_heatmap(cohort.cohort_specialization_kpis(a.ca())),
    "service_center_roster": lambda a: _service_center(a)[0],
    "service_center_tech": lambda a: _service_center(a)[1],
    "documented_slicers": lambda a: doc.documented_slicers(
        a.ca(), domains=["data engineering", "Aptitude"], proficiency=["Advanced", "Beginner"], sources=["Internal"],
        categories=["Node", "Cypress"], silver=a.silver),
    "attempts_needed_histogram": lambda a: doc.attempts_needed_histogram(a.cp),
    "proficiency_distribution": lambda a: doc.proficiency_distribution(a.cp),
    "assessment_training_summary": lambda a: doc.assessment_training_summary(a.cp),
    "trainer_output_long": lambda a: doc.trainer_output_long(org.trainer_kpis(a.silver)),
    "freshness_alarm": lambda a: doc.freshness_alarm(org.data_freshness(a.silver), FRESHNESS_NOW),
    "candidate_drilldown": lambda a: doc.candidate_drilldown(doc.senior_insights(a.silver),
                                                             doc.growth_tracking(a.cp)),
    "recent_months": lambda a: doc.recent_months(a.cp),
    "cohort_attempt_documented": lambda a: a.ca(force_map=False),
    "coverage_documented": lambda a: cohort.coverage(a.ca(force_map=False)),
    "specialization_kpis_documented": lambda a: cohort.specialization_kpis(a.ca(force_map=False)),
    # Rolled up from the cubes: exact distinct counts by bitmaps, medians by sketches
    "monthly_trend_cube": lambda a: cube.monthly_trend(a.executive_cube),
    "organization_overview_cube": lambda a: cube.organization_overview(a.executive_cube),
    "cohort_kpis_cube": lambda a: cube.cohort_kpis(a.cohort_cube),
    "cohort_specialization_kpis_cube": lambda a: cube.cohort_specialization_kpis(a.cohort_cube),
    "specialization_kpis_cube": lambda a: cube.specialization_kpis(a.cohort_cube),
    "cohort_progression_cube": lambda a: cube.cohort_progression(a.cohort_cube),
    # Load by load: bucketed keep-latest states, the refreshed summary, committed batches
    "incremental_attempts": incremental.attempts,
    "incremental_valid_results": incremental.valid_results,
    "incremental_takers": incremental.takers,
    "incremental_questions": incremental.questions,
    "incremental_dimensions": incremental.dimensions,
    "assessment_summary_refreshed": incremental.assessment_summary,
    "events_committed": incremental.events_committed,
    "reconciled_results": incremental.reconciled_results,
    # Point lookups on the clustered copy, and all option lists of a slicer chain from one scan
    "candidate_history_kpis": lambda a: m.candidate_history(a.lookups, m.busiest_email(a.cp))[0],
    "candidate_history_attempts": lambda a: m.candidate_history(a.lookups, m.busiest_email(a.cp))[1],
    "attempt_lookup_clustered": lambda a: point_lookup(a.lookups, order_by=["start_time_raw"], assessment_taker_id=LOOKED_UP[0], test_id=LOOKED_UP[1], attempt_number=1),
    "cascading_slicers": lambda a: cascading_options(a.ca(), ["attempt_year", "cohort", "specialization"], attempt_year=["2025", "2026"], cohort=["2025 CDC", "2025 NSP"]),
    # Candidate-versus-peer profiles for every candidate
    "profile_summary": lambda a: profile.summary(a.base, hist=a.history),
    "profile_specialization": lambda a: profile.by_specialization(a.history, a.base),
    "profile_difficulty": lambda a: profile.by_difficulty(a.history),
    "profile_retakes": lambda a: profile.retake_effectiveness(a.history),
    "profile_flagged": lambda a: profile.flagged_sittings(a.history),
    "peer_distribution": lambda a: profile.peer_distribution(profile.peer_standing(a.base)),
    "profile_timeline": lambda a: profile.timeline(a.history_rows),
}

# Fixed value: the sitting that the clustered lookup fetches.
LOOKED_UP = ("at-0-0", "t-20")

# Fixed value: reference clock of the freshness alarm query.
FRESHNESS_NOW = "2030-01-09 12:00:00"

# Fixed value: the high-water mark the incremental-extract query resumes from.
EVENTS_WATERMARK = "2024-01-15 00:00:00"


def _gold(a: Analytics, dataset: str, snapshots: DataFrame) -> DataFrame:
    """CLN5-CLN15 on the latest silver snapshot of a table."""
    return medallion.gold_transform(dataset, lake.latest_snapshot(snapshots))


def _service_center(a: Analytics) -> tuple[DataFrame, DataFrame]:
    """DOC19 under the documented mapping, where 'Unmapped' exists."""
    ca = a.ca(force_map=False)
    return doc.service_center(cohort.candidate_specialization_performance(ca, a.candidates("specialization", force_map=False)), cohort.specialization_tech_kpis(a.spark, a.silver))


def _attempt_detail(a: Analytics) -> DataFrame:
    """M11 over every latest attempt (a point lookup is a filter on the keys)."""
    return m.attempt_questions(a.responses, org.latest_attempts_all(a.silver), a.silver.question)

# Catalog view names of the source, per query.
VIEW_NAMES = {
    "candidate_performance": "trainer_candidate_performance",
    "executive_overview": "executive_overview_kpis",
    "monthly_trend": "monthly_assessment_trend",
    "retake_intervals": "candidate_retake_intervals",
    "quality_violations": "trainer_quality_violations",
    "organization_overview": "organization_overview_kpis",
    "organization_catalog": "organization_catalog_kpis",
    "trainer_kpis": "executive_trainer_kpis",
    "data_freshness": "gold_data_freshness",
    "cohort_attempt": "cohort_specialization_attempt",
    "cohort_kpis": "cohort_performance_kpis",
    "cohort_specialization_kpis": "cohort_specialization_kpis",
    "specialization_kpis": "specialization_performance_kpis",
    "specialization_tech_kpis": "specialization_tech_kpis",
    "candidate_cohort_performance": "candidate_cohort_performance",
    "candidate_specialization_performance": "candidate_specialization_performance",
    "cohort_progression": "cohort_progression_trend",
    "coverage": "additional_analytics_coverage",
    "question_performance": "question_performance",
}


def register_all(a: Analytics, only: list[str] | None = None) -> list[str]:
    """Publish the views as temp views in dependency order; returns their names.

    ``only`` restricts to a subset of query names. The views are published as
    plans over the silver tables: no base is written, and apart from the
    sampling of ranking boundaries nothing runs until a view is queried.
    """
    a = Analytics(a.spark, a.silver, persist=False, internal_pattern=a.internal_pattern, sf_dir=a.sf_dir,
                  algo=a.algo, internal_domains=a.internal_domains)
    done = []
    for name, fn in QUERIES.items():
        if only is not None and name not in only:
            continue
        view = VIEW_NAMES.get(name, name)
        fn(a).createOrReplaceTempView(view)
        done.append(view)
    return done
