"""Independent DuckDB SQL for the dashboard marts (M-series).

pandas semantics restated in SQL: group-bys drop NULL keys (except the
executive roster), ``first``/``last`` pick the first/last non-NULL value in
sitting order, ``mean`` skips NULLs, ``rank(pct=True)`` averages ties.
"""

from __future__ import annotations

from oracle.cohort_sql import CA_CTES, QP_CTES, V23
from oracle.fixtures_sql import with_ctes
from oracle.views_sql import CP_CTES, V4_BODY, V7_BODY, V7_CTES, V9_BODY, newest

SEQ_KEY = ("struct_pack(a := seq, b := coalesce(cast(start_time as varchar), '~'), "
           "c := coalesce(test_id, ''), d := coalesce(assessment_taker_id, ''))")
SHEET_KEY = ("struct_pack(b := coalesce(cast(start_time as varchar), '~'), "
             "c := coalesce(test_id, ''), d := coalesce(assessment_taker_id, ''))")


def pick(value: str, key: str, latest: bool) -> str:
    fn = "arg_max" if latest else "arg_min"
    return f"{fn}({value}, case when {value} is not null then {key} end)"


BASE_CTES = CA_CTES + [
    ("o_base", """select *, substr(attempt_year, 1, 4) as year,
        case when email is not null and test_id is not null then row_number() over (
          partition by email, test_id order by start_time asc nulls last, assessment_taker_id asc nulls last,
          attempt_number asc nulls last) end as seq
        from ca where not coalesce(is_excluded, false)
          and (specialization is null or specialization <> 'Unmapped')"""),
]


def on_cp(body: str, extra=None) -> str:
    return with_ctes(CP_CTES + (extra or []), body)


def on_base(body: str, extra=None) -> str:
    return with_ctes(BASE_CTES + (extra or []), body)


ATT_CTES = QP_CTES + [
    ("o_tra", """select * from (select *, row_number() over (partition by assessmenttakerid, testid, attemptnumber
        order by load_date desc nulls last, finishtime desc nulls last, title asc nulls last, starttime asc nulls last,
          duration asc nulls last) as rn from s_testresult) where rn = 1"""),
    ("o_qdm", newest("s_question", ["questiontype", "difficultylevel", "questiontitle", "questiontext"])),
    ("o_detail", """select p.assessmenttakerid, p.testid, p.attemptnumber, p.pos, p.question_id, p.max_score,
        p.achieved_score, p.idle_time_sec, p.is_answered, p.is_answer_correct,
        t.testwindowviolationcount as violation_count, t.testwindowviolationduration as violation_duration_sec,
        t.numberofquestions as attempt_questions_total, t.numberofquestionsfailed as attempt_questions_failed,
        t.testpercentage, t.passstatus, t.duration as attempt_duration_sec, t.starttime, t.finishtime,
        q.questiontype, q.difficultylevel, q.questiontitle, q.questiontext
        from answer p
        left join o_tra t on p.assessmenttakerid = t.assessmenttakerid and p.testid = t.testid
          and p.attemptnumber = t.attemptnumber
        left join o_qdm q on p.question_id = q.id"""),
]

RATE = "cast(sum(is_pass) as bigint) / nullif(count(test_id), 0) * 100"

M = {}

M["kpi_strip"] = on_cp("""
select o.total_attempts, o.total_pass, o.total_fail,
  coalesce(cast(o.total_pass as double) / nullif(o.total_attempts, 0) * 100, 0.0) as pass_rate_pct,
  o.avg_duration_min, c.assessments_created, c.assessments_dispatched, c.tests_created, c.questions_created,
  o.total_violations, r.avg_retake_days
from (select count(*) as total_attempts, count(*) filter (where pass_status = 'passed') as total_pass,
        count(*) filter (where pass_status = 'failed') as total_fail, avg(duration_min) as avg_duration_min,
        cast(coalesce(sum(violation_count), 0) as bigint) as total_violations from cp) o,
     (select cast(coalesce(sum(assessments_created), 0) as bigint) as assessments_created,
        cast(coalesce(sum(assessments_dispatched), 0) as bigint) as assessments_dispatched,
        cast(coalesce(sum(tests_created), 0) as bigint) as tests_created,
        cast(coalesce(sum(questions_created), 0) as bigint) as questions_created from o_v7) c,
     (select avg(cast(days_between_attempts as double)) as avg_retake_days from o_v4
      where assessment_taker_id in (select assessment_taker_id from cp where assessment_taker_id is not null)) r
""", V7_CTES + [("o_v7", V7_BODY), ("o_v4", V4_BODY)])

for name, period in (("monthly_performance", "attempt_month"),):
    M[name] = on_cp(f"""
select attempt_month, count(test_id) as attempts, cast(sum(is_pass) as bigint) as passes,
  avg(score_pct) as avg_score, avg(duration_min) as avg_duration, {RATE} as pass_rate_pct
from cp where attempt_month is not null group by attempt_month""")

for name, period in (("quarterly_performance", "attempt_quarter"), ("yearly_performance", "attempt_year")):
    M[name] = on_cp(f"""
select {period}, count(test_id) as attempts, cast(sum(is_pass) as bigint) as passes, {RATE} as pass_rate_pct
from cp where {period} is not null group by {period}""")

M["outcome_composition"] = on_cp("""
select pass_status, count(*) as count from cp where pass_status is not null group by pass_status""")

M["outcome_by_level"] = on_cp("""
select test_difficulty, pass_status, count(*) as count from cp
where test_difficulty is not null and pass_status is not null group by test_difficulty, pass_status""")

M["monthly_violations"] = on_cp("""
select attempt_month, cast(coalesce(sum(violation_count), 0) as bigint) as violation_count
from cp where attempt_month is not null group by attempt_month""")

M["retake_interval_histogram"] = on_cp("""
select bin, 0 + bin * 2.0 as bin_start, 0 + (bin + 1) * 2.0 as bin_end, count(*) as count
from (select cast(least(floor((cast(days_between_attempts as double) - 0) / 2.0), 29) as integer) as bin
      from o_v4 where days_between_attempts is not null
        and cast(days_between_attempts as double) between 0 and 60)
group by bin""", [("o_v4", V4_BODY)])

M["executive_roster"] = on_cp(f"""
select *, cast(total_pass as double) / nullif(total_attempts, 0) * 100 as pass_rate from (
  select email, {pick('candidatename', SHEET_KEY, False)} as candidate_name,
    count(test_id) as total_attempts, count(distinct test_id) as tests_taken, avg(score_pct) as avg_score,
    cast(coalesce(sum(is_pass), 0) as bigint) as total_pass, count(*) filter (where is_pass = 0) as total_fail,
    avg(duration_min) as avg_duration, cast(coalesce(sum(violation_count), 0) as bigint) as total_violations,
    max(start_time) as last_attempt
  from cp group by email)
order by total_attempts desc, email asc nulls last limit 2000""")

M["period_progression"] = on_cp("""
select attempt_year, count(test_id) as attempts, avg(score_pct) as avg_score,
  avg(cast(is_pass as double)) * 100.0 as pass_rate
from cp where attempt_year is not null group by attempt_year""")

M["freshness_list"] = with_ctes([], V9_BODY)

M["attempt_questions"] = with_ctes(ATT_CTES, "select * from o_detail")

M["attempt_kpis"] = with_ctes(ATT_CTES, """
select assessmenttakerid, testid, attemptnumber, coalesce(src_total, served) as questions_total,
  answered_derived as answered, coalesce(src_total, served) - answered_derived as unanswered,
  coalesce(coalesce(src_total, served) - src_failed, correct_derived) as correct, idle_sum_sec, idle_mean_sec
from (select assessmenttakerid, testid, attemptnumber, count(*) as served,
        count(*) filter (where coalesce(is_answered, false)) as answered_derived,
        count(*) filter (where coalesce(achieved_score, 0.0) > 0) as correct_derived,
        sum(idle_time_sec) as idle_sum_sec, avg(idle_time_sec) as idle_mean_sec,
        max(attempt_questions_total) as src_total, max(attempt_questions_failed) as src_failed
      from o_detail group by assessmenttakerid, testid, attemptnumber)""")

M["question_outcomes"] = with_ctes(ATT_CTES, """
select *, pos + 1 as question_no,
  case when coalesce(achieved_score, 0.0) > 0 then 'Correct'
       when coalesce(is_answered, false) then 'Wrong' else 'Unanswered' end as outcome,
  coalesce(is_answer_correct, false) <> (coalesce(achieved_score, 0.0) > 0) as marked_correct_differs
from o_detail""")

M["question_type_mix"] = with_ctes(ATT_CTES, """
select coalesce(questiontype, 'Unknown') as question_type, count(*) as questions from o_detail group by 1""")

M["question_score_mix"] = with_ctes(ATT_CTES, """
select assessmenttakerid, testid, attemptnumber, pos, kind, points
from (select assessmenttakerid, testid, attemptnumber, pos, unnest([{'kind': 'Earned', 'points': achieved_score}, {'kind': 'Max', 'points': max_score}], recursive := true)
      from o_detail)""")

M["attempt_lookup"] = on_cp("""
select * from cp where test_id = 't-10' and attempt_number = 1 order by start_time_raw desc nulls last, assessment_taker_id asc nulls last limit 1""")

M["training_base"] = on_base("select * from o_base")

M["data_trust"] = with_ctes(CA_CTES, """
select coalesce(total_attempts, 0) as total_attempts, coalesce(real_specialization_attempts, 0) as real_specialization_attempts,
  case when coalesce(total_attempts, 0) > 0
       then coalesce(real_specialization_attempts, 0) / coalesce(total_attempts, 0) * 100 else 0.0 end as real_pct
from (select count(*) as total_attempts, cast(sum(has_specialization) as bigint) as real_specialization_attempts from ca)""")

M["outcomes_scorecard"] = on_base("""
select candidates, attempts, specializations, first_sitting_pass_pct, overall_pass_pct,
  overall_pass_pct - first_sitting_pass_pct as lift, median_score, avg_score, avg_duration
from (select count(distinct email) as candidates, count(*) as attempts, count(distinct specialization) as specializations,
        avg(case when seq = 1 then cast(is_pass as double) end) * 100.0 as first_sitting_pass_pct,
        avg(cast(is_pass as double)) * 100.0 as overall_pass_pct,
        median(score_pct) as median_score, avg(score_pct) as avg_score, avg(duration_min) as avg_duration
      from o_base)""")

M["attempts_to_pass"] = on_base("""
select avg(first_pass_seq) as avg_attempts_to_pass from (
  select email, test_id, min(seq) as first_pass_seq from o_base
  where is_pass = 1 and email is not null and test_id is not null and seq is not null group by email, test_id)""")

M["question_accuracy"] = on_base("""
select avg(case when questions_total > 0 then (questions_total - questions_failed) / questions_total end) * 100.0
  as question_accuracy_pct from o_base""")

M["integrity_rate"] = on_base("""
select avg(cast(coalesce(violation_count, 0.0) > 0 as double)) * 100.0 as integrity_rate_pct from o_base""")

M["readiness_funnel"] = on_base(f"""
select 'Candidates' as stage, count(*) as n from o_per
union all select 'Passed (ever)', cast(sum(ever) as bigint) from o_per
union all select 'Passed 1st sitting', cast(sum(first) as bigint) from o_per
union all select 'Reached Advanced', count(*) filter (where latest_prof = 'Advanced') from o_per""", [
    ("o_per", f"""select email, coalesce(max(is_pass), 0) as ever,
        max(case when seq = 1 and is_pass = 1 then 1 else 0 end) as first,
        {pick('proficiency_level', SEQ_KEY, True)} as latest_prof
        from o_base where email is not null group by email"""),
])

M["proficiency_mix"] = on_base("""
select specialization, proficiency_level, count(*) as n from o_base
where specialization is not null and proficiency_level is not null group by specialization, proficiency_level""")

M["specialization_summary"] = on_base("""
select specialization, count(*) as attempts, avg(cast(is_pass as double)) * 100.0 as pass_rate_pct,
  avg(score_pct) as avg_score_pct from o_base where specialization is not null group by specialization""")

M["score_distribution"] = on_base("""
select q.specialization, q.n, q.min, q.max, q.q1, q.median, q.q3, w.lower_whisker, w.upper_whisker, w.outliers
from o_q q join (
  select b.specialization,
    min(case when b.score_pct >= q.q1 - 1.5 * (q.q3 - q.q1) then b.score_pct end) as lower_whisker,
    max(case when b.score_pct <= q.q3 + 1.5 * (q.q3 - q.q1) then b.score_pct end) as upper_whisker,
    count(*) filter (where b.score_pct < q.q1 - 1.5 * (q.q3 - q.q1) or b.score_pct > q.q3 + 1.5 * (q.q3 - q.q1))
      as outliers
  from o_base b join o_q q on b.specialization = q.specialization group by b.specialization) w
  on q.specialization = w.specialization""", [
    ("o_q", """select specialization, count(*) as n, min(score_pct) as min, max(score_pct) as max,
        quantile_cont(score_pct, 0.25) as q1, quantile_cont(score_pct, 0.5) as median,
        quantile_cont(score_pct, 0.75) as q3
        from o_base where specialization is not null and score_pct is not null group by specialization"""),
])

M["level_summary"] = on_base("""
select g.test_difficulty, g.attempts, g.pass_rate_pct, o.sort_order
from (select test_difficulty, count(*) as attempts, avg(cast(is_pass as double)) * 100.0 as pass_rate_pct
      from o_base where test_difficulty is not null group by test_difficulty) g
join (values ('Beginner', 0), ('Intermediate', 1), ('Advanced', 2)) as o(test_difficulty, sort_order)
  on g.test_difficulty = o.test_difficulty""")

M["pass_by_sitting"] = on_base("""
select seq, count(*) as attempts, avg(cast(is_pass as double)) * 100.0 as pass_rate_pct
from o_base where seq is not null group by seq having count(*) >= 5""")

M["score_over_time"] = on_base("""
select attempt_month, avg(score_pct) as avg_score_pct, count(*) as attempts
from o_base where length(attempt_month) >= 7 group by attempt_month""")

M["proficiency_migration"] = on_base("""
select l.first_proficiency, l.sort_order,
  coalesce(c.b, 0) as "Beginner", coalesce(c.i, 0) as "Intermediate", coalesce(c.a, 0) as "Advanced"
from (values ('Beginner', 0), ('Intermediate', 1), ('Advanced', 2)) as l(first_proficiency, sort_order)
left join (select first_proficiency,
    count(*) filter (where latest_proficiency = 'Beginner') as b,
    count(*) filter (where latest_proficiency = 'Intermediate') as i,
    count(*) filter (where latest_proficiency = 'Advanced') as a
  from o_fl where first_proficiency in ('Beginner', 'Intermediate', 'Advanced')
    and latest_proficiency in ('Beginner', 'Intermediate', 'Advanced') group by first_proficiency) c
  on l.first_proficiency = c.first_proficiency""", [
    ("o_fl", f"""select email, {pick('proficiency_level', SEQ_KEY, False)} as first_proficiency,
        {pick('proficiency_level', SEQ_KEY, True)} as latest_proficiency
        from o_base where email is not null group by email"""),
])

RETAKEN = ("o_rt", """select * from (select *, count(*) over (partition by email, test_id) as sz
    from o_base where email is not null and test_id is not null) where sz > 1""")

M["retake_score_change"] = on_base("""
select email, test_id, delta,
  case when delta <= -0.001 then 'Declined' when delta <= 0.001 then 'Same' when delta > 0.001 then 'Improved' end
    as direction
from (select email, test_id, """ + pick("score_pct", SEQ_KEY, True) + " - " + pick("score_pct", SEQ_KEY, False)
    + """ as delta from o_rt group by email, test_id) where delta is not null""", [RETAKEN])

M["retake_gaps"] = on_base("""
select email, test_id, seq, gap_days from (
  select email, test_id, seq,
    (epoch_us(start_time) - epoch_us(lag(start_time) over (partition by email, test_id order by seq asc nulls last)))
      / 86400e6 as gap_days
  from o_rt) where gap_days between 0 and 120""", [RETAKEN])

CI = ("o_ci", f"""select *, total_viol / nullif(attempts, 0) as viol_per_attempt from (
    select email, {pick('candidatename', SHEET_KEY, False)} as name, count(*) as attempts,
      avg(score_pct) as avg_score, coalesce(sum(violation_count), 0.0) as total_viol,
      coalesce(sum(violation_duration_sec), 0.0) as viol_dur
    from o_base where email is not null group by email)""")

M["candidate_integrity"] = on_base("select * from o_ci", [CI])

M["violation_rate"] = on_base("""
select specialization, count(*) as attempts,
  avg(cast(coalesce(violation_count, 0.0) > 0 as double)) * 100.0 as violation_rate_pct,
  sum(coalesce(violation_count, 0.0)) as total_violations
from o_base where specialization is not null group by specialization""")

M["risk_watchlist"] = on_base("""
select *, total_viol * 2.0 + viol_dur / 60.0 as integrity_risk, viol_dur / 60 as viol_min from o_ci
where total_viol * 2.0 + viol_dur / 60.0 > 0
order by total_viol * 2.0 + viol_dur / 60.0 desc, email asc nulls last limit 20""", [CI])

M["cohort_scorecard"] = on_base("""
select cohort, count(distinct email) as candidates, count(*) as attempts,
  avg(case when seq = 1 then cast(is_pass as double) end) * 100.0 as first_sit_pass_pct,
  avg(cast(is_pass as double)) * 100.0 as overall_pass_pct, avg(score_pct) as avg_score_pct,
  median(score_pct) as median_pct,
  avg(cast(coalesce(proficiency_level = 'Advanced', false) as double)) * 100.0 as pct_advanced,
  avg(cast(coalesce(violation_count, 0.0) > 0 as double)) * 100.0 as integrity_pct
from o_base where cohort is not null group by cohort""")

M["cohort_scores"] = on_base("""
select cohort, avg(score_pct) as avg_score_pct from o_base
where cohort is not null and cohort <> 'Unassigned' group by cohort""")


def _cmp(metric: str, expr_a: str, expr_b: str) -> str:
    return f"select '{metric}' as metric, {expr_a} as group_a, {expr_b} as group_b, ({expr_a}) - ({expr_b}) as delta from o_base"


def _grp(expr_fn):
    return expr_fn("specialization = 'Backend'"), expr_fn("specialization = 'Frontend'")


M["compare_specializations"] = on_base("\nunion all ".join([
    _cmp("Attempts", *_grp(lambda c: f"cast(count(*) filter (where {c}) as double)")),
    _cmp("Candidates", *_grp(lambda c: f"cast(count(distinct case when {c} then email end) as double)")),
    _cmp("1st-Sit Pass %", *_grp(lambda c: f"avg(case when {c} and seq = 1 then cast(is_pass as double) end) * 100.0")),
    _cmp("Overall Pass %", *_grp(lambda c: f"avg(case when {c} then cast(is_pass as double) end) * 100.0")),
    _cmp("Avg Score %", *_grp(lambda c: f"avg(case when {c} then score_pct end)")),
    _cmp("Integrity %", *_grp(
        lambda c: f"avg(case when {c} then cast(coalesce(violation_count, 0.0) > 0 as double) end) * 100.0")),
]))

def _compare(dimension, first, second):
    each = {"Attempts": "cast(count(*) as double)", "Candidates": "cast(count(distinct email) as double)",
            "1st-Sit Pass %": "100.0 * avg(is_pass) filter (where seq = 1)", "Overall Pass %": "100.0 * avg(is_pass)", "Avg Score %": "avg(score_pct)",
            "Integrity %": "100.0 * avg(cast(coalesce(violation_count, 0.0) > 0 as int))"}
    one = lambda expr, v: f"(select {expr} from o_base where {dimension} = '{v}')"
    rows = [f"select '{m}' as metric, {one(e, first)} as group_a, {one(e, second)} as group_b" for m, e in each.items()]
    return on_base("select *, group_a - group_b as delta from (" + " union all ".join(rows) + ")")


M["compare_cohorts"] = _compare("cohort", "2025 CDC", "2025 NSP")
M["compare_years"] = _compare("year", "2025", "2026")

M["retake_medians"] = on_base("""
select (select median(delta) from (select """ + pick("score_pct", SEQ_KEY, True) + " - " + pick("score_pct", SEQ_KEY, False) + """ as delta
          from o_rt group by email, test_id)) as median_score_change,
  (select median(gap) from (select (epoch_us(start_time) - epoch_us(lag(start_time) over (partition by email, test_id order by seq))) / 86400e6 as gap
          from o_rt) where gap between 0 and 120) as median_gap_days""", [RETAKEN])

# The question text uses two entities, both decoded here.
_PLAIN = ("trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(coalesce({x}, ''), '<br\\s*/?>|</(p|div|li)>', ' ', 'gi'), "
          "'<[^>]+>', '', 'g'), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g'))")
M["question_rankings"] = f"""
with v23 as ({V23})
select question_id, coalesce(nullif({_PLAIN.format(x='question_text')}, ''), nullif({_PLAIN.format(x='question_title')}, ''), '(no text)') as question,
  question_type, question_difficulty, specialization, times_served, answer_rate_pct, correct_rate_pct, avg_idle_sec, ranking
from (select *, 'hardest' as ranking, row_number() over (order by correct_rate_pct asc nulls last, question_id) as place from v23 where times_served >= 20
      union all select *, 'most_skipped', row_number() over (order by answer_rate_pct asc nulls last, question_id) from v23 where times_served >= 20
      union all select *, 'idle_hotspots', row_number() over (order by avg_idle_sec desc nulls last, question_id) from v23 where times_served >= 20)
where place <= 15"""

M["training_roster"] = on_base(f"""
select email, candidatename, attempts, tests_taken, pass_rate_pct, avg_score_pct, best_score_pct,
  latest_proficiency, improvement, integrity_risk,
  case when avg_score_pct is not null then rank() over (order by avg_score_pct desc nulls last) end as rank,
  case when avg_score_pct is not null then
    ((rank() over (order by avg_score_pct asc nulls last) - 1)
      + (count(*) over (partition by avg_score_pct) + 1) / 2.0) / count(avg_score_pct) over () end as percentile
from (select email, {pick('candidatename', SHEET_KEY, False)} as candidatename, count(*) as attempts,
        count(distinct test_id) as tests_taken, avg(cast(is_pass as double)) * 100.0 as pass_rate_pct,
        avg(score_pct) as avg_score_pct, max(score_pct) as best_score_pct,
        coalesce(sum(violation_count), 0.0) * 2 + coalesce(sum(violation_duration_sec), 0.0) / 60 as integrity_risk,
        {pick('proficiency_level', SEQ_KEY, True)} as latest_proficiency,
        {pick('score_pct', SEQ_KEY, True)} - {pick('score_pct', SEQ_KEY, False)} as improvement
      from o_base where email is not null group by email)""")

ORACLE = M
