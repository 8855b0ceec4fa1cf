"""DuckDB SQL for the candidate profile parts (P-series)."""

from __future__ import annotations

from oracle.fixtures_sql import with_ctes
from oracle.marts_sql import BASE_CTES, SHEET_KEY

HKEY = ("struct_pack(a := pseq, b := coalesce(cast(start_time as varchar), '~'), c := coalesce(test_id, ''), "
        "d := coalesce(assessment_taker_id, ''))")

HIST = ("o_hist", """select *, row_number() over (partition by email, test_id order by start_time asc nulls last,
    assessment_taker_id asc nulls last, attempt_number asc nulls last) as pseq
    from o_base where email is not null""")
SPEC = ("o_spec", """select c.*, p.peer_avg from (
      select email, specialization, count(*) as attempts, avg(score_pct) as avg,
        avg(cast(is_pass as double)) * 100 as pass_rate
      from o_hist where specialization is not null group by email, specialization) c
    left join (select specialization, avg(score_pct) as peer_avg from o_base where specialization is not null
               group by specialization) p on c.specialization = p.specialization""")
RET = ("o_ret", f"""select *, latest - first as lift from (
    select email, test_id, arg_min_null(test_title, {HKEY}) as test, count(*) as sittings,
      arg_min_null(score_pct, {HKEY}) as first, arg_max_null(score_pct, {HKEY}) as latest
    from o_hist where test_id is not null group by email, test_id) where sittings > 1""")
STAND = ("o_stand", """select email, cand_avg, avg(cand_avg) over () as peer_avg,
    rank() over (order by cand_avg desc) as rank, count(*) over () as total_peers,
    ((rank() over (order by cand_avg asc) - 1) + (count(*) over (partition by cand_avg) + 1) / 2.0)
      / count(*) over () * 100 as percentile
    from (select email, avg(score_pct) as cand_avg from o_base where score_pct is not null and email is not null
          group by email)""")


def on_hist(body: str, extra=None) -> str:
    return with_ctes(BASE_CTES + [HIST] + (extra or []), body)


P = {}
P["profile_specialization"] = on_hist("select * from o_spec", [SPEC])
P["profile_difficulty"] = on_hist("""
select email, test_difficulty, count(*) as attempts, avg(score_pct) as avg,
  avg(cast(is_pass as double)) * 100 as pass_rate
from o_hist where test_difficulty is not null group by email, test_difficulty""")
P["profile_retakes"] = on_hist("select * from o_ret", [RET])
P["profile_flagged"] = on_hist("""
select email, test_title, start_time, violation_count, violation_duration_sec, score_pct, pass_status
from o_hist where coalesce(violation_count, 0.0) > 0""")
P["profile_timeline"] = on_hist("""
select email, start_time, score_pct, specialization, test_title,
  count(distinct specialization) over (partition by email) > 1 as split_by_specialization
from o_hist""")
P["peer_distribution"] = on_hist("""
select bin, lo + bin * (hi - lo) / 25 as bin_start, count(*) as candidates from (
  select cast(case when hi > lo then least(floor((cand_avg - lo) / ((hi - lo) / 25)), 24) else 0 end as integer) as bin,
    lo, hi
  from (select cand_avg, min(cand_avg) over () as lo, max(cand_avg) over () as hi from o_stand))
group by bin, lo, hi""", [STAND])
P["profile_summary"] = on_hist(f"""
select b.email, coalesce(nullif(trim(b.first_name), ''), b.email) as name, b.n_attempts, b.n_tests,
  s.cand_avg, b.cand_max, b.cand_min, s.peer_avg, s.rank, s.total_peers, s.percentile, b.avg_time, b.pass_rate,
  b.viol_total, b.n_flagged, i.integrity, i.peer_integrity_med, g.avg_retake, b.latest_prof, b.last_active,
  st.strongest_specialization,
  coalesce(e.retakes_improved, 0) as retakes_improved, coalesce(e.retakes_declined, 0) as retakes_declined,
  coalesce(e.retakes_unchanged, 0) as retakes_unchanged,
  concat_ws(' · ',
    case when s.cand_avg is not null and s.peer_avg is not null then
      case when s.cand_avg >= s.peer_avg then 'above peer avg' else 'below peer avg' end end,
    case when st.strongest_specialization is not null then 'strongest in ' || st.strongest_specialization end,
    case when e.retaken_tests > 0 then
      case when coalesce(e.retakes_improved, 0) > coalesce(e.retakes_declined, 0) then 'retakes help'
           when coalesce(e.retakes_declined, 0) > coalesce(e.retakes_improved, 0) then 'retakes don''t help'
           else 'retakes mixed' end end,
    case when b.n_flagged > 0 then cast(b.n_flagged as varchar) || ' flagged sitting(s)' end) as headline
from (select email,
        arg_min(candidatename, case when candidatename is not null and candidatename <> '' then {SHEET_KEY} end)
          as first_name,
        count(*) as n_attempts, count(distinct test_id) as n_tests, max(score_pct) as cand_max,
        min(score_pct) as cand_min, avg(duration_min) as avg_time,
        avg(cast(pass_status = 'passed' as double)) * 100 as pass_rate,
        sum(coalesce(violation_count, 0.0)) as viol_total,
        count(*) filter (where coalesce(violation_count, 0.0) > 0) as n_flagged, max(start_time) as last_active,
        arg_max(proficiency_level, case when proficiency_level is not null then {HKEY} end) as latest_prof
      from o_hist group by email) b
left join o_stand s on b.email = s.email
left join (select email, integrity, median(integrity) over () as peer_integrity_med from (
             select email, coalesce(sum(coalesce(violation_count, 0.0)), 0.0) * 2.0
               + coalesce(sum(coalesce(violation_duration_sec, 0.0)), 0.0) / 60.0 as integrity
             from o_base where email is not null group by email)) i on b.email = i.email
left join (select email, avg(gap) as avg_retake from (
             select email, (epoch_us(start_time) - epoch_us(lag(start_time) over (partition by email, test_id
               order by start_time, assessment_taker_id, attempt_number))) / 86400e6 as gap
             from o_hist where start_time is not null) group by email) g on b.email = g.email
left join (select email, count(*) filter (where lift > 0) as retakes_improved,
             count(*) filter (where lift < 0) as retakes_declined, count(*) filter (where lift = 0) as retakes_unchanged,
             count(*) as retaken_tests from o_ret group by email) e on b.email = e.email
left join (select email, arg_min(specialization, case when avg is not null then
               struct_pack(a := -avg, b := specialization) end)
             as strongest_specialization from o_spec group by email) st on b.email = st.email""",
                                   [SPEC, RET, STAND])

ORACLE = P
