"""DuckDB SQL for the ingest / medallion operators registered as queries."""

from __future__ import annotations

from oracle.fixtures_sql import with_ctes

TITLE = ("array_to_string(list_transform(regexp_extract_all({x}, '(\\pL+|[^\\pL]+)'), "
         "lambda p: upper(p[1]) || lower(p[2:])), '')")

ORACLE = {
    "latest_testresult_snapshot": with_ctes([], """
select * from s_testresult where load_date = (select max(load_date) from s_testresult)"""),
    "gold_assessment_taker": with_ctes([], f"""
select id, email, assessmentid, organizationid, dispatchid, tags, createdat,
  case when email is not null then {TITLE.format(x="replace(split_part(email, '@', 1), '.', ' ')")} end
    as candidatename
from s_assessmenttaker where load_date = (select max(load_date) from s_assessmenttaker)"""),
    "gold_testresult": with_ctes([], """
select assessmenttakerid, testid, attemptnumber, title, starttime, finishtime, duration / 60 as duration,
  testpercentage, passstatus, testwindowviolationcount, numberofquestions, numberofquestionsfailed, numberofquestionsanswered, load_date
from s_testresult where load_date = (select max(load_date) from s_testresult)"""),
    "events_incremental": """
select * from events where ts > timestamp '2024-01-15 00:00:00'""",
}
