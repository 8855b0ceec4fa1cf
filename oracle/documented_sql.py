"""DuckDB SQL for the documented-only views (DOC-series, V24)."""

from __future__ import annotations

from oracle.cohort_sql import CA_COLUMNS, CA_CTES, CA_FROM
from oracle.fixtures_sql import with_ctes
from oracle.views_sql import CP_CTES, V5, newest

RISK = "(testwindowviolationcount * 2.0 + testwindowviolationduration / 60.0)"
INSIGHTS = f"""select assessmenttakerid as assessment_taker_id, testid as test_id, title as test_title,
    {RISK} as integrity_risk_score, numberofquestionsanswered / nullif(numberofquestions, 0) as completion_funnel_pct,
    case when {RISK} > 10 then 'High Risk' when {RISK} > 5 then 'Medium Risk' else 'Low Risk' end as integrity_label,
    load_date from sitting"""
GROWTH = """select assessment_taker_id, candidatename, test_id, test_title, attempt_number, score_pct, load_date,
    lag(score_pct) over (partition by assessment_taker_id, test_id order by attempt_number asc nulls last,
      start_time asc nulls last) as previous_score from cp"""


def on_cp(body, extra=None):
    return with_ctes(CP_CTES + (extra or []), body)


D = {}
D["growth_tracking"] = on_cp("select *, score_pct - previous_score as score_improvement from o_g", [("o_g", GROWTH)])
D["senior_insights"] = on_cp("select * from o_si", [("o_si", INSIGHTS)])
D["assessment_summary"] = on_cp("""
select g.assessment_id, a.title as assessment_title, a.organizationid as organization_id,
  a.status, a.duration / 60 as duration_minutes,
  g.total_takers, g.started_takers, g.completed_takers,
  cast(g.completed_takers as double) / nullif(g.total_takers, 0) * 100 as completion_rate_pct,
  g.graded_attempts, g.average_score, g.average_score as average_percentage, g.pass_rate_pct,
  g.average_duration_minutes, g.max_duration_minutes, g.violation_count, coalesce(f.raised, 0) as question_flag_count
from (select assessment_id, count(distinct assessment_taker_id) as total_takers,
        count(distinct case when start_time is not null then assessment_taker_id end) as started_takers,
        count(distinct case when is_complete = 1 then assessment_taker_id end) as completed_takers,
        count(score_pct) as graded_attempts, avg(score_pct) as average_score, avg(is_pass) * 100 as pass_rate_pct,
        avg(duration_min) as average_duration_minutes, max(duration_min) as max_duration_minutes,
        cast(sum(violation_count) as bigint) as violation_count
      from cp group by assessment_id) g
left join o_as a on g.assessment_id = a.id
left join (select person.assessmentid, count(*) as raised from o_flag join person on person.id = o_flag.assessmenttakerid group by 1) f
  on f.assessmentid = g.assessment_id""", [("o_as", newest("s_assessment", ["organizationid", "title", "status", "duration"])),
                                          ("o_flag", newest("s_questionflag", ["questionid", "assessmenttakerid"]))])
D["kpi_month_deltas"] = on_cp("""
select *, avg_score_pct - lag(avg_score_pct) over (order by attempt_month) as avg_score_delta,
  pass_rate_pct - lag(pass_rate_pct) over (order by attempt_month) as pass_rate_delta
from (select attempt_month, avg(score_pct) as avg_score_pct, avg(is_pass) * 100 as pass_rate_pct,
        avg(cast(candidate_source = 'Internal' as double)) * 100 as internal_pct
      from cp where attempt_month is not null and attempt_month <> '' group by attempt_month)""")
D["integrity_composition"] = on_cp("select integrity_label, count(*) as attempts from o_si group by integrity_label",
                                   [("o_si", INSIGHTS)])
D["completion_funnel"] = on_cp("""
select 'Registered' as stage, count(*) as attempts from cp
union all select 'Submitted', count(*) filter (where is_complete = 1) from cp
union all select 'Passed', count(*) filter (where is_pass = 1) from cp""")
D["domain_difficulty_heatmap"] = with_ctes(CA_CTES, """
select domain_name, test_difficulty, avg(score_pct) as avg_score_pct from ca
where domain_name is not null and test_difficulty is not null group by domain_name, test_difficulty""")
D["source_pass_rates"] = on_cp("""
select candidate_source, count(*) as attempts, avg(is_pass) * 100 as pass_rate_pct, 70.0 as target_pct
from cp group by candidate_source""")
D["violations_by_severity"] = on_cp("""
select test_id, test_title, violation_severity_slice, count(*) as attempts,
  cast(sum(test_window_violation_count) as bigint) as violations,
  cast(sum(number_of_questions_failed) as bigint) as questions_failed
from o_v5 group by test_id, test_title, violation_severity_slice""", [("o_v5", V5.split("\nselect", 1)[0] and
    V5[V5.rindex("select test_id"):])])
D["attempts_needed_histogram"] = on_cp("""
select attempts, count(*) as pairs from (
  select assessment_taker_id, test_id, max(total_attempts_before_pass) as attempts from cp
  where total_attempts_before_pass is not null group by assessment_taker_id, test_id) group by attempts""")
D["proficiency_distribution"] = on_cp(
    "select proficiency_level, count(*) as attempts from cp group by proficiency_level")
D["assessment_training_summary"] = on_cp("""
select test_id, test_title, count(distinct assessment_taker_id) as takers, avg(score_pct) as avg_score_pct,
  avg(is_pass) * 100 as pass_rate_pct, avg(duration_min) as avg_duration_min,
  avg(cast(total_attempts_before_pass as double)) as avg_attempts
from cp group by test_id, test_title""")
D["trainer_output_long"] = with_ctes([
    ("qd", newest("s_question", ["creator", "activeversionid", "calibrationscore", "status", "difficultylevel"])),
    ("tk", """select creator as trainer_id, avg(cast(calibrationscore as double)) as avg_calibration_score,
        count(distinct case when difficultylevel = 'hard' then id end) as hard,
        count(distinct case when difficultylevel = 'medium' then id end) as medium,
        count(distinct case when difficultylevel = 'easy' then id end) as easy
        from qd where creator is not null group by creator"""),
], """
select trainer_id, avg_calibration_score, difficulty, questions, avg_calibration_score >= 80.0 as meets_calibration_target
from (select trainer_id, avg_calibration_score, 'hard' as difficulty, hard as questions from tk
      union all select trainer_id, avg_calibration_score, 'medium', medium from tk
      union all select trainer_id, avg_calibration_score, 'easy', easy from tk)""")
D["freshness_alarm"] = with_ctes([], """
select table_name, last_updated, h as hours_behind, h > 24 as is_stale from (
  select table_name, last_updated,
    date_sub('hour', try_cast(last_updated as timestamp), timestamp '2030-01-09 12:00:00') as h
  from (select 'assessmenttaker' as table_name, max(load_date) as last_updated from s_assessmenttaker
        union all select 'testresult', max(load_date) from s_testresult
        union all select 'question', max(load_date) from s_question
        union all select 'assessment', max(load_date) from s_assessment
        union all select 'test', max(load_date) from s_test
        union all select 'organization', max(load_date) from s_organization))""")
D["candidate_drilldown"] = on_cp("""
select coalesce(l.assessment_taker_id, g.assessment_taker_id) as assessment_taker_id,
  l.integrity_label_mode, g.total_score_gain
from (select assessment_taker_id, arg_min(integrity_label, struct_pack(a := -n, b := integrity_label))
        as integrity_label_mode
      from (select assessment_taker_id, integrity_label, count(*) as n from o_si
            where integrity_label is not null group by assessment_taker_id, integrity_label)
      group by assessment_taker_id) l
full join (select assessment_taker_id, sum(score_pct - previous_score) as total_score_gain
           from o_g group by assessment_taker_id) g
  on l.assessment_taker_id = g.assessment_taker_id""", [("o_si", INSIGHTS), ("o_g", GROWTH)])
D["recent_months"] = on_cp("""
select * from cp where attempt_month in (
  select attempt_month from (select attempt_month, dense_rank() over (order by attempt_month desc) as r
    from (select distinct attempt_month from cp where attempt_month is not null and attempt_month <> ''))
  where r <= 3)""")

_CA_DOC = [x for x in CA_CTES if x[0] != "ca"] + [("ca", f"""
select {CA_COLUMNS}, coalesce(specialization, 'Unmapped') as specialization, coalesce(is_excluded, false) as is_excluded, program_type,
  if(program_type is null, 'Unassigned', coalesce(tagged_year, attempt_year, 'Unknown') || ' ' || program_type) as cohort,
  if(program_type is not null, 'Training Center', if(is_excluded = false, 'Service Center', 'Unclassified')) as center,
  if(is_excluded = false, 1, 0) as has_specialization, if(program_type is null, 0, 1) as has_cohort
from {CA_FROM}""")]

D["cohort_attempt_documented"] = with_ctes(_CA_DOC, "select * from ca")

from oracle import cohort_sql as _c  # noqa: E402

D["coverage_documented"] = with_ctes(_CA_DOC, _c.V22[_c.V22.rindex("\nselect count(*) as total_attempts"):])
D["specialization_kpis_documented"] = with_ctes(_CA_DOC, _c.V17[_c.V17.rindex("\nselect specialization, count(*)"):])

D["violation_audit"] = with_ctes(CA_CTES, """
select assessment_taker_id, test_id, attempt_number, test_title, domain_name, test_difficulty, violation_count,
  violation_duration_sec, questions_failed,
  ['No Violations', 'Low Violations', 'High Violations'][1 + cast(violation_count >= 1 as int) + cast(violation_count > 5 as int)] as violation_severity_slice
from ca where violation_count is not null""")
D["duration_scores"] = on_cp("""
select assessment_taker_id, test_id, attempt_number, duration_min, score_pct, proficiency_level
from cp where duration_min is not null and score_pct is not null""")
D["assessment_score_distribution"] = on_cp("""
select test_title, proficiency_level, count(*) as n, min(score_pct) as min, max(score_pct) as max, any_value(a) as q1, any_value(b) as median,
  any_value(c) as q3, min(score_pct) filter (where score_pct >= a - 1.5 * (c - a)) as lower_whisker,
  max(score_pct) filter (where score_pct <= c + 1.5 * (c - a)) as upper_whisker,
  count(*) filter (where score_pct < a - 1.5 * (c - a) or score_pct > c + 1.5 * (c - a)) as outliers
from (select *, quantile_cont(score_pct, 0.25) over w as a, quantile_cont(score_pct, 0.5) over w as b, quantile_cont(score_pct, 0.75) over w as c
      from cp where score_pct is not null and test_title is not null window w as (partition by test_title, proficiency_level))
group by test_title, proficiency_level""")
D["cohort_specialization_heatmap"] = with_ctes(CA_CTES, """
select cohort, specialization, avg(score_pct) as avg_score_pct, count(*) as attempts from ca
group by cohort, cohort_year, program_type, specialization, center""")
D["service_center_roster"] = with_ctes(_CA_DOC, f"select * from ({_c.V20[_c.V20.rindex('select *, rank()'):]}) where specialization <> 'Unmapped'")
D["service_center_tech"] = f"select * from ({_c.V18}) where specialization <> 'Unmapped'"
D["documented_slicers"] = with_ctes(CA_CTES, f"""
select * from ca where domain_name in ('data engineering', 'Aptitude') and proficiency_level in ('Advanced', 'Beginner') and candidate_source = 'Internal'
  and domain_name in (select field.name from ({newest("s_question", ["categoryid", "domainid"])}) q
    join ({newest("s_category", ["name"])}) c on c.id = q.categoryid and c.name in ('Node', 'Cypress')
    join ({newest("s_domain", ["name"])}) field on field.id = q.domainid)""")

ORACLE = D
