"""Load-by-load forms of the batch operators, run over the silver bundle of a context."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examlytics.operators.latest_state import LatestState, merge_loads
from examlytics.plans import materialised, org
from examlytics.plans.cohort import has_results
from examlytics.plans.context import Analytics
from examlytics.session import shared_dir
from examlytics.sources import lake
from examlytics.sources.fixtures import NEW_LOAD, OLD_LOAD, read_table
from examlytics.sources.ingest import CommittedSync

SITTING = ["assessmenttakerid", "testid", "attemptnumber"]


def _root(a: Analytics, name: str) -> str:
    return f"{shared_dir(a.spark)}/{name}-{uuid.uuid4().hex}"


def _state(a: Analytics, name: str, snapshots: DataFrame, keys: list[str], order=("load_date",), where=None) -> LatestState:
    return merge_loads(a.spark, _root(a, name), snapshots, keys, order, where)


def attempts(a: Analytics) -> DataFrame:
    """DED1: the latest attempt among those with a valid start."""
    rows = a.silver.testresult.select(*org.TESTRESULT_COLS, *org.OPTIONAL_COLS)
    return _state(a, "attempts", rows, SITTING, ("load_date", "finishtime"), org.valid_start()).current()


def valid_results(a: Analytics) -> DataFrame:
    """DED9: the latest result that looks like an array of objects."""
    rows = a.silver.testresult.select(*SITTING, "result", "load_date")
    return _state(a, "valid-results", rows, SITTING, where=has_results()).current()


def takers(a: Analytics) -> DataFrame:
    """DED2."""
    rows = a.silver.assessmenttaker.select("id", "email", "assessmentid", "organizationid", "dispatchid", "tags", "load_date")
    return _state(a, "takers", rows, ["id"]).current()


def questions(a: Analytics) -> DataFrame:
    """DED7."""
    rows = a.silver.question.select("id", "creator", "status", "difficultylevel", "categoryid", "domainid", "questiontitle", "load_date")
    return _state(a, "questions", rows, ["id"]).current()


def dimensions(a: Analytics) -> DataFrame:
    """DED3 to DED6 and DED8 as (table, id, value): the latest name, title or tags of organizations, tests, dispatches, domains and categories."""
    s = a.silver
    tables = {"organization": (s.organization, "organizationname"), "test": (s.test, "title"), "dispatch": (s.dispatch, "tags"),
              "domain": (s.domain, "name"), "category": (s.category, "name")}
    latest = [_state(a, name, df.select("id", F.col(col).alias("value"), "load_date"), ["id"]).current().select(F.lit(name).alias("table"), "id", "value")
              for name, (df, col) in tables.items()]
    return reduce(DataFrame.unionByName, latest)


def assessment_summary(a: Analytics) -> DataFrame:
    """V24 refreshed load by load."""
    view = materialised.AssessmentSummary(a.spark)
    for load in materialised.loads(a.silver):
        view.refresh(load)
    return view.summary()


# Fixed value: where the first extract of the committed events ends.
FIRST_EXTRACT = "2024-01-15 00:00:00"


def events_committed(a: Analytics) -> DataFrame:
    """SRC5 in three committed batches, by an hour that many events share: up to an hour whose odd ids come late, all, and nothing new."""
    events = read_table(a.spark, a.sf_dir, "events").withColumn("updated_at", F.date_trunc("hour", "ts"))
    sync = CommittedSync(a.spark, _root(a, "bronze"), "events", ["event_id"])
    end = events.where(F.col("updated_at") <= F.lit(FIRST_EXTRACT).cast("timestamp")).agg(F.max("updated_at")).scalar()
    late = (F.col("updated_at") == end) & (F.col("event_id") % 2 == 1)
    sync.sync(events.where((F.col("updated_at") <= end) & ~late))
    sync.sync(events)
    sync.sync(events)
    return sync.read()


def reconciled_results(a: Analytics) -> DataFrame:
    """SRC10: results whose older partition lacks a column and holds narrower and other types."""
    rows = a.silver.testresult.select(*SITTING, "duration", "testpercentage", "numberofquestionsanswered", "load_date")
    path = _root(a, "drifting")
    older = F.col("load_date") == OLD_LOAD
    lake.write_snapshot(rows.where(older).select("assessmenttakerid", "testid", F.col("attemptnumber").cast("int"), F.col("duration").cast("string"),
                                                 F.col("testpercentage").cast("float")), path, "test_execution", "TestResult", OLD_LOAD)
    lake.write_snapshot(rows.where(~older).drop("load_date"), path, "test_execution", "TestResult", NEW_LOAD)
    return lake.read_reconciled(a.spark, lake.table_path(path, "test_execution", "TestResult"))
