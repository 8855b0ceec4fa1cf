"""DuckDB SQL for the load-by-load forms and the cube roll-ups: the same results as in one pass over all snapshots."""

from __future__ import annotations

from oracle.cohort_sql import CA_CTES, ORACLE as COHORT
from oracle.documented_sql import D as DOCUMENTED
from oracle.fixtures_sql import with_ctes
from oracle.views_sql import CP_CTES, ORACLE as VIEWS, SITTING_KEY, newest

_NAMED = [("organization", "s_organization", "organizationname"), ("test", "s_test", "title"), ("dispatch", "s_dispatch", "tags"),
          ("domain", "s_domain", "name"), ("category", "s_category", "name")]

ORACLE = {
    "incremental_attempts": with_ctes(CP_CTES[:1], "select * from sitting"),
    "incremental_valid_results": with_ctes([], newest("s_testresult", ["result", "load_date"], SITTING_KEY, (), "result like '[{%'")),
    "incremental_takers": with_ctes([], newest("s_assessmenttaker", ["email", "assessmentid", "organizationid", "dispatchid", "tags", "load_date"])),
    "incremental_questions": with_ctes([], newest("s_question", ["creator", "status", "difficultylevel", "categoryid", "domainid", "questiontitle", "load_date"])),
    "incremental_dimensions": with_ctes([], " union all ".join(
        f"select '{name}' as \"table\", id, {col} as value from ({newest(table, [col])})" for name, table, col in _NAMED)),
    "assessment_summary_refreshed": DOCUMENTED["assessment_summary"],
    "candidate_history_kpis": with_ctes([*CP_CTES, ("one", "select email from cp where email is not null group by email order by count(*) desc, email desc limit 1")], """
select count(*) as total_attempts, count(distinct test_id) as tests_taken, 100.0 * avg(is_pass) as pass_rate, avg(score_pct) as avg_score,
  avg(duration_min) as avg_duration, coalesce(cast(sum(violation_count) as bigint), 0) as total_violations from cp join one using (email)"""),
    "candidate_history_attempts": with_ctes([*CP_CTES, ("one", "select email from cp where email is not null group by email order by count(*) desc, email desc limit 1")],
                                            "select cp.* from cp join one using (email)"),
    "attempt_lookup_clustered": with_ctes(CP_CTES, "select * from cp where assessment_taker_id = 'at-0-0' and test_id = 't-20' and attempt_number = 1"),
    "cascading_slicers": with_ctes([*CA_CTES, ("pool", """select attempt_year as y, cohort as c, specialization as s,
  attempt_year in ('2025', '2026') as in_y, cohort in ('2025 CDC', '2025 NSP') as in_c from ca""")], """
select 'attempt_year' as slicer, y as value, count(*) as rows, count(*) filter (where in_c) as rows_under_others from pool where y <> '' group by y
union all select 'cohort', c, count(*), count(*) from pool where c <> '' and in_y group by c
union all select 'specialization', s, count(*), count(*) from pool where s <> '' and in_y and in_c group by s"""),
    "reconciled_results": with_ctes([], """
select assessmenttakerid, testid, attemptnumber, cast(duration as varchar) as duration, cast(testpercentage as double) as testpercentage,
  case when load_date > '2030-01-01' then numberofquestionsanswered end as numberofquestionsanswered, load_date from s_testresult"""),
    "events_committed": "select *, date_trunc('hour', ts) as updated_at from events",
    **{f"{v}_cube": (VIEWS | COHORT)[v] for v in ("monthly_trend", "organization_overview", "cohort_kpis", "cohort_specialization_kpis", "specialization_kpis", "cohort_progression")},
}
