"""Physical-plan properties: pushdown and pruning on a real silver lake, dedup shape, no cartesian products."""

import re
import tempfile

import pytest

import __spark_entry__ as E
from examlytics.plans import org
from examlytics.sources import lake
from examlytics.sources.fixtures import silver_from_driver
from examlytics.sources.silver import SILVER_TABLE_NAMES, Silver
from tests.conftest import SF_SMOKE


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString() + df._sc._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def silver_lake(spark):
    root = tempfile.mkdtemp(prefix="examlytics-lake-")
    s = silver_from_driver(spark, SF_SMOKE)
    tables = {}
    for field, name in SILVER_TABLE_NAMES.items():
        db, table = name.split("_", 1)[0] + "_" + name.split("_", 2)[1], name.split("_", 2)[2]
        df = getattr(s, field)
        for (d,) in df.select("load_date").distinct().collect():
            lake.write_snapshot(df.where(df.load_date == d).drop("load_date"), root, db, table, d)
        tables.setdefault(db, []).append(table)
    lake.register_silver(spark, root, tables, {"test_creation": "test_creation", "test_execution": "test_execution",
                                               "user_mgt": "user_mgt"})
    return Silver.from_catalog(spark)


def test_filters_and_columns_reach_the_scan(silver_lake):
    text = plan_text(org.candidate_performance(silver_lake))
    assert "PushedFilters: [IsNotNull(starttime), Not(EqualTo(starttime,))" in text
    # the big JSON column is never read for the attempt view
    schemas = [ln.split("ReadSchema:", 1)[1] for ln in text.splitlines() if "ReadSchema:" in ln and "testid" in ln]
    assert schemas and all("<result:" not in sc and ",result:" not in sc for sc in schemas)


def test_latest_snapshot_prunes_partitions(silver_lake):
    text = plan_text(lake.latest_snapshot(silver_lake.testresult))
    assert "PartitionFilters: [isnotnull(load_date" in text


def test_dedup_is_a_window_group_limit(silver_lake):
    text = plan_text(org.latest_attempts(silver_lake))
    assert "WindowGroupLimit" in text


def test_candidate_performance_is_one_pass(silver_lake):
    text = org.candidate_performance(silver_lake)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange ", text)) <= 8 and text.count("FileScan") == 4


def test_views_read_few_columns_of_their_base(spark):
    text = plan_text(E.queries()["organization_overview"](spark, SF_SMOKE))
    schema = next(ln for ln in text.splitlines() if "ReadSchema:" in ln)
    assert "start_time_raw" not in schema and schema.count(":") <= 12, schema


def test_no_cartesian_products(spark):
    qs = E.queries()
    for name in ["executive_overview", "kpi_strip", "profile_summary", "outcomes_scorecard", "coverage",
                 "peer_distribution", "cohort_attempt", "training_roster"]:
        text = plan_text(qs[name](spark, SF_SMOKE))
        assert "CartesianProduct" not in text, name
        # the only nested-loop join allowed is the keyword match against the 7-row seed
        assert text.count("BroadcastNestedLoopJoin") <= text.count("keyword"), name


def test_small_dimensions_do_not_shuffle_the_facts(spark):
    """V1 with kept dimensions: broadcast below the bound, by shuffle beyond it, with the same rows."""
    from examlytics.operators.joins import SizedDimensions
    from examlytics.session import keep
    silver = silver_from_driver(spark, SF_SMOKE)
    plans = {}
    for limit in (8 << 20, 0):
        df = org.candidate_performance(silver, dimension=SizedDimensions(keep, limit))
        plans[limit] = df._jdf.queryExecution().executedPlan().toString()
        rows = sorted(str(tuple(r)) for r in df.collect())
        assert limit or rows == first
        first = rows
    by_dimension = re.compile(r"Exchange hashpartitioning\((testid|at_organizationid)#")
    assert not by_dimension.search(plans[8 << 20]) and plans[8 << 20].count("BroadcastHashJoin") == 2
    assert by_dimension.search(plans[0]) and "BroadcastHashJoin" not in plans[0]


def test_rankings_of_candidates_aggregate_the_facts_once(analytics):
    """V19 and V20 read the kept measures, not the attempts, and shuffle less than half as often as on the facts."""
    from examlytics.plans import cohort
    for by, view in (("cohort", cohort.candidate_cohort_performance), ("specialization", cohort.candidate_specialization_performance)):
        count = lambda df: len(re.findall(r"\bExchange ", df._jdf.queryExecution().executedPlan().toString()))
        kept, plain = view(analytics.ca(), analytics.candidates(by)), view(analytics.ca())
        assert count(kept) * 2 < count(plain)
        facts = {f.rsplit("/", 1)[0] for f in analytics.ca().inputFiles()}
        assert not facts & {f.rsplit("/", 1)[0] for f in kept.inputFiles()}


def test_crosswalk_is_joined_to_the_domains_not_to_the_attempts(spark, analytics):
    from examlytics.plans import cohort
    for force_map in (True, False):
        dims = {}
        cohort.cohort_attempt(spark, analytics.cp, analytics.silver, algo="md5", force_map=force_map,
                              dimension=lambda df, name: dims.setdefault(name, df))
        assert {"cw_specialization", "cw_is_excluded"} <= set(dims["domains"].columns)
