"""DuckDB text of the silver derivation (FIXTURES.md section 6) as CTEs.

Each entry is ``name -> SELECT``; :func:`with_fixtures` prefixes the ones a
query needs. The derivation is data preparation, not the query under test;
the oracle checks the view logic on top of it.
"""

from __future__ import annotations

def _snap(newest="2030-01-08"):
    return f"(select * from (values ('2030-01-01', 0), ('{newest}', 1), ('{newest}', 2)) as v(load_date, n))"


_SNAP = _snap()


def _old(*columns):
    """Columns that the older snapshot (n = 0) states otherwise: (name, old, new)."""
    return ", ".join(f"case when n=0 then {old} else {new} end as {name}" for name, old, new in columns)


_OLD_RESULT = """'[{"questionId":"q-1","score":4,"scored":1,"idleTime":7,"isAnswered":true,"isAnswerCorrect":true}]'"""

_ELEMENT = """'{"questionId":"q-'||cast(l_partkey as string)||'","score":'||cast(cast(l_quantity as int) as string)
    ||',"scored":'||cast(case when l_returnflag='R' then 0 else cast(l_quantity as int) end as string)
    ||',"idleTime":'||cast(l_suppkey%90 as string)
    ||',"isAnswered":'||case when l_linestatus='F' then 'true' else 'false' end
    ||',"isAnswerCorrect":'||case when l_returnflag='A' then 'true' else 'false' end||'}'"""

FIXTURES = {
    "s_result": f"""
select l_orderkey, '['||string_agg({_ELEMENT}, ',' order by l_linenumber, l_partkey, l_suppkey, {_ELEMENT})||']' as result
from lineitem group by l_orderkey""",
    "s_testresult": f"""
select assessmenttakerid, testid, attemptnumber, title,
  {_old(("starttime", "case when k%3=0 then '1999-01-01T00:00:00.000Z' else '2024-06-01T08:30:00.000Z' end", "starttime"))},
  case when n=2 then case when k%2=0 then '2030-01-03T00:00:00.000Z' else '2029-12-31T00:00:00.000Z' end else finishtime end as finishtime,
  cast(case n when 0 then duration+60 when 2 then duration+30 else duration end as bigint) as duration,
  cast(case n when 0 then 100-testpercentage when 2 then testpercentage+1 else testpercentage end as int) as testpercentage,
  {_old(("passstatus", "case when passstatus='PASS' then 'fail' else 'PASS' end", "passstatus"),
        ("testwindowviolationcount", "cast(8 as bigint)", "testwindowviolationcount"))},
  testwindowviolationduration, numberofquestions,
  {_old(("numberofquestionsfailed", "cast(0 as bigint)", "numberofquestionsfailed"))},
  numberofquestionsanswered, status, testtakershotcount,
  case when n=0 and (k%35=0 or k%25=0) then {_OLD_RESULT} when k%35=0 then '[]' else result end as result,
  load_date
from (
select o_orderkey as k, n, case when o_orderkey%41<>5 then 'at-'||cast(o_custkey as string)||'-'||cast(o_orderkey%3 as string) end as assessmenttakerid,
  't-'||substr(o_orderpriority,1,1)||cast(o_orderkey%2 as string) as testid,
  cast(case when o_orderkey%41=5 then o_orderkey else row_number() over (partition by o_custkey, o_orderkey%3,
    substr(o_orderpriority,1,1), o_orderkey%2, n order by o_orderkey) end as bigint) as attemptnumber, 'Test '||substr(o_orderpriority,1,1) as title,
  case when o_orderkey%101=0 then '' else
    cast(year(o_orderdate)+28 as string)||substr(cast(cast(o_orderdate as date) as string),5,6)
    ||'T'||lpad(cast(o_orderkey%24 as string),2,'0')||':'||lpad(cast(o_orderkey%60 as string),2,'0')||':00.000Z' end as starttime,
  case when o_orderkey%17=0 then null else '2030-01-01T00:00:00.000Z' end as finishtime,
  o_orderkey%3600 as duration,
  floor(o_totalprice/5000) as testpercentage,
  case when o_totalprice>=250000 then 'PASS' else 'fail' end as passstatus,
  case when o_orderkey%50=7 then null else cast(o_orderkey%9 as bigint) end as testwindowviolationcount,
  cast((o_orderkey%9)*15 as bigint) as testwindowviolationduration,
  cast(o_orderkey%21 as bigint) as numberofquestions,
  cast(o_orderkey%21 as bigint)-cast(o_orderkey%7 as bigint)*cast(o_orderkey%21>=6 as int) as numberofquestionsfailed,
  cast(greatest(o_orderkey%21-o_orderkey%3,0) as bigint) as numberofquestionsanswered, 'done' as status,
  cast(o_orderkey%4 as bigint) as testtakershotcount,
  r.result as result,
  s.load_date as load_date
from orders left join s_result r on r.l_orderkey = o_orderkey
cross join {_SNAP} s
qualify n=1 or (n=0 and o_orderkey%5=0) or (n=2 and o_orderkey%13=0))""",
    "s_assessmenttaker": f"""
select 'at-'||cast(o_custkey as string)||'-'||cast(g as string) as id,
  {_old(("email", "'old.'||cast(m as string)||'@corp.example'",
         "case when o_custkey%89<>3 then 'user.'||cast(o_custkey as string)||case when o_custkey%3=0 then '@corp.example' when o_custkey%97=1 then '' else '@ext.example' end end"),
        ("assessmentid", "'as-'||cast((m+1)%50 as string)", "'as-'||cast(m%50 as string)"),
        ("organizationid", "'org-1'", "'org-'||cast(c_nationkey as string)"),
        ("dispatchid", "'d-'||cast((m+60)%200 as string)", "'d-'||cast(m%200 as string)"),
        ("tags", """'["2024 Data Batch"]'""", """case m%5 when 0 then '["2025 National Service Personnel","Frontend"]' when 1 then '["CDC December 2025","Aptitude"]'
    when 2 then '[]' when 3 then 'not json' end"""))},
  cast(year(since)+28 as string)||substr(cast(cast(since as date) as string),5,6) as createdat,
  m%2=0 as showresults, '' as starttime, s.load_date as load_date
from (select o_custkey, o_orderkey%3 as g, min(o_orderkey) as m, min(o_orderdate) as since from orders group by 1, 2)
join customer on o_custkey=c_custkey
cross join {_SNAP} s
where n=1 or (n=0 and m%4=0)""",
    "s_organization": f"""
select 'org-'||cast(n_nationkey as string) as id,
  n_name||case when s.load_date='2030-01-01' then ' (old)' else '' end as organizationname, s.load_date as load_date
from nation cross join {_snap('2030-01-07')} s
where n_nationkey<>7 and n<2""",
    "s_test": f"""
select distinct 't-'||substr(o_orderpriority,1,1)||cast(o_orderkey%2 as string) as id,
  {_old(("title", "'Renamed'", "'Test '||substr(o_orderpriority,1,1)"),
        ("difficultylevel", "'Intermediate'", "['easy','Beginner','Intermediate','Advanced','hard'][cast(substr(o_orderpriority,1,1) as int)]"),
        ("domainid", "'dom-3'", "'dom-'||substr(o_orderpriority,1,1)"))},
  'org-'||substr(o_orderpriority,1,1) as organizationid, 'text' as description, false as system, s.load_date as load_date
from orders cross join {_snap('2030-01-05')} s where n<2""",
    "s_domain": f"""
select distinct 'dom-'||substr(o_orderpriority,1,1) as id,
  {_old(("name", "'Aptitude'", """case substr(o_orderpriority,1,1) when '1' then 'Backend Engineering 1781523206632' when '2' then 'data engineering'
    when '3' then 'Aptitude' when '4' then 'AWS_99887766 x' else 'Unlisted Domain' end"""))},
  false as system, s.load_date as load_date
from orders cross join {_SNAP} s where n<2""",
    "s_dispatch": f"""
select distinct 'd-'||cast(o_orderkey%200 as string) as id,
  {_old(("tags", """'["CDC Batch 2023"]'""", """case when o_orderkey%200 between 0 and 49 then '[]' when o_orderkey%200 between 50 and 79 then '["IT Skill Batch 2026"]' end"""),
        ("commencedate", "'2023-01-01'", "case when o_orderkey%200>=100 then '2027-03-01' end"))},
  o_orderkey%200%2=0 as "showResults", 'link' as "dispatchLink", '2026-11-05' as createdat, s.load_date as load_date
from orders cross join {_SNAP} s where n<2""",
    "s_question": f"""
select 'q-'||cast(p_partkey as string) as id,
  case when p_size%4<>0 then 'v-'||cast(p_partkey as string) end as activeversionid,
  {_old(("creator", "'trainer-old'", "'trainer-'||cast(p_size%9 as string)"),
        ("calibrationscore", "'1'", "cast(p_size*2 as string)"),
        ("status", "'draft'", "case when p_size%3=0 then 'draft' else 'active' end"),
        ("difficultylevel", "'easy'", "case p_size%3 when 0 then 'easy' when 1 then 'medium' else 'hard' end"),
        ("categoryid", "'cat-ECONOMY'", "'cat-'||p_type"), ("domainid", "'dom-2'", "'dom-'||cast(p_partkey%6 as string)"),
        ("questiontitle", "'old title'", "p_name"),
        ("questiontext", "'<p>Old</p>'", "case when p_partkey%10=0 then '' else '<p>What is <b>'||p_name||'</b>?<br/>A&nbsp;&amp;&nbsp;B</p>' end"))},
  'org-'||cast(p_partkey%25 as string) as organizationid,
  case p_partkey%2 when 0 then 'mcq' else 'code' end as questiontype, md5(p_name) as hash,
  s.load_date as load_date
from part cross join {_snap('2030-01-06')} s
where n=1 or (n=0 and p_partkey%2=0)""",
    "s_category": f"""
select distinct 'cat-'||p_type as id,
  {_old(("name", "'Cypress'", "case p_type when 'ECONOMY' then 'Node' when 'MEDIUM' then 'React 1234567' when 'SMALL' then 'Cypress' else p_type end"))},
  'about' as description, false as system, s.load_date as load_date
from part cross join {_snap('2030-01-04')} s where n<2""",
    "s_assessment": f"""
select distinct 'as-'||cast(o_orderkey%50 as string) as id,
  {_old(("organizationid", "'org-2'", "'org-'||cast(o_orderkey%50%25 as string)"), ("isdispatched", "false", "o_orderkey%50%4<>0"),
        ("title", "'Untitled'", "'Assessment '||cast(o_orderkey%50 as string)"), ("status", "'new'", "case when o_orderkey%50%3=0 then 'draft' else 'published' end"))},
  case when o_orderkey%50%7<>0 then cast((o_orderkey%50+1)*60 as bigint) end as duration, 'read first' as instructions,
  s.load_date as load_date
from orders cross join {_SNAP} s where n<2""",
    "s_questionflag": f"""
select 'f-'||cast(l_orderkey as string) as id, 'q-'||cast(p as string) as questionid,
  {_old(("assessmenttakerid", "'at-1-0'", "'at-'||cast(o_custkey as string)||'-'||cast(o_orderkey%3 as string)"))},
  'org-'||cast(s%25 as string) as organizationid, 'text' as questiontext, v.load_date as load_date
from (select l_orderkey, min(l_partkey) as p, min(l_suppkey) as s from lineitem where l_returnflag='R' and l_linenumber=1 group by 1)
join orders on l_orderkey=o_orderkey cross join {_SNAP} v
where n=1 or (n=0 and l_orderkey%3=0)""",
    "s_skill": """
select distinct 'skill-'||p_type as id, p_type as name, 'org-1' as organizationid, true as system, 'about' as description,
  '[]' as tags, '2030-01-08' as load_date
from part""",
}

# Dependencies between fixture CTEs.
_DEPS = {"s_testresult": ["s_result"]}


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    """``WITH a AS (...), b AS (...) <body>`` with fixture CTEs resolved first."""
    needed: list[str] = []

    def need(name: str) -> None:
        for d in _DEPS.get(name, []):
            need(d)
        if name not in needed:
            needed.append(name)

    text = " ".join(sql for _, sql in ctes) + " " + body
    for name in FIXTURES:
        if name in text:
            need(name)
    parts = [f"{n} AS ({FIXTURES[n]}\n)" for n in needed] + [f"{n} AS ({sql}\n)" for n, sql in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body
