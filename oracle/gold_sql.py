"""DuckDB SQL for the gold dataset transforms on the latest silver snapshots."""

from __future__ import annotations

from oracle.fixtures_sql import with_ctes
from oracle.cohort_sql import CA_CTES
from oracle.views_sql import pct_dec1


def latest(table: str, cols: str) -> str:
    return with_ctes([], f"select {cols} from {table} where load_date = (select max(load_date) from {table})")


G = {
    # category drops description and system; load_date stays
    "gold_category": latest("s_category", "id, name, load_date"),
    "gold_domain": latest("s_domain", "id, name"),
    "gold_test": latest("s_test", "id, title, difficultylevel, domainid"),
    "gold_question": latest("s_question", "id, creator, activeversionid, calibrationscore, status, difficultylevel, "
                                          "categoryid, domainid, questiontype, questiontitle"),
    "gold_assessment": latest("s_assessment", "id, isdispatched, title, status, duration / 60 as duration"),
    "gold_questionflag": latest("s_questionflag", "id, questionid, assessmenttakerid"),
    "gold_skill": latest("s_skill", "id, name"),
    "gold_assessment_dispatch": latest("s_dispatch", "id, tags, commencedate, createdat"),
}

# pass_rate_pct of V16 is DECIMAL(38,1); the weighted mean is computed in DOUBLE
G["weighted_cohort_pass_rate"] = with_ctes(CA_CTES + [
    ("o_v16", f"""select cohort, count(*) as attempts, {pct_dec1('sum(is_pass)', 'count(*)')} as pass_rate_pct
        from ca where not is_excluded group by cohort, cohort_year, program_type, specialization, center"""),
], """
select cohort,
  sum(case when pass_rate_pct is not null and attempts > 0 then cast(pass_rate_pct as double) * attempts end)
    / nullif(sum(case when pass_rate_pct is not null and attempts > 0 then cast(attempts as double) end), 0.0)
    as weighted_pass_rate_pct,
  sum(attempts) as attempts
from o_v16 group by cohort""")

ORACLE = G
