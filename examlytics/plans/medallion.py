"""Silver and gold jobs (CLN1-CLN15, SRC16, SRC17).

Silver: latest bronze snapshot -> per-table cleaning rule (pass-through by
default) -> silver snapshot. Gold: latest silver snapshot -> dataset
transform (case-sensitive tolerant column prune, seconds to minutes, a name
derived from the e-mail) -> gold snapshot. Each table / dataset is one Spark
job; the driver only sequences them and records a status per dataset.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examlytics.functions.scalar import candidate_name
from examlytics.sources.lake import read_latest, write_snapshot

Rule = Callable[[DataFrame], DataFrame]


def clean(df: DataFrame, database: str, table: str, rules: Mapping[tuple[str, str], Rule] | None = None) -> DataFrame:
    """CLN1: apply the (database, table) cleaning rule; pass-through when none."""
    rule = (rules or {}).get((database, table))
    return df.transform(rule) if rule else df


def _positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The frame with positional column names, and its original names."""
    names = df.columns
    return df.toDF(*[f"_c{i}" for i in range(len(names))]), names


def prune(df: DataFrame, drops: Iterable[str]) -> DataFrame:
    """CLN2: drop listed columns that exist, matching names case-sensitively.

    Selection is by position, so ``organizationid`` never removes
    ``organizationId`` (``DataFrame.drop`` and name resolution are
    case-insensitive by default) and two names differing only in case stay
    distinguishable.
    """
    gone = set(drops)
    tmp, names = _positional(df)
    keep = [i for i, c in enumerate(names) if c not in gone]
    return tmp.select(*[f"_c{i}" for i in keep]).toDF(*[names[i] for i in keep])


def to_minutes(df: DataFrame, col: str = "duration") -> DataFrame:
    """CLN3: seconds -> minutes when the (exactly named) column exists."""
    if col not in df.columns:
        return df
    tmp, names = _positional(df)
    cols = [(F.col(f"_c{i}") / 60) if c == col else F.col(f"_c{i}") for i, c in enumerate(names)]
    return tmp.select(*cols).toDF(*names)


def with_candidate_name(df: DataFrame, email: str = "email") -> DataFrame:
    """CLN4: add ``candidatename`` (local part, dots to spaces, Python title case)."""
    if email not in df.columns:
        return df
    return df.withColumn("candidatename", candidate_name(F.col(f"`{email}`")))


# ---------------------------------------------------------------------------
# Per-dataset column drop lists and source tables.
# ---------------------------------------------------------------------------
GOLD_DROPS = {
    "test_creation_category": ["description", "organiizationid", "system"],
    "test_creation_assessment_taker": [
        "showresults", "showclock", "conductsurvey", "commencedate", "expirydate", "assessmentlink",
        "starttime", "endtime", "invalid", "proctor", "estimatedendtime", "genericid",
        "screenshotsinterval", "camerashotsinterval", "dispatcher", "submissiontype",
        "reportcallbackurl", "originalassessmenttakerid", "load_date"],
    "test_creation_domain": ["organizationid", "system", "load_date"],
    "test_execution_questionflag": ["organizationid", "load_date", "questiontext"],
    "test_execution_testresult": [
        "organizationid", "order", "testwindowviolationduration", "testtakershotcount",
        "testwindowshotcount", "status", "draftintervalassessmenttakershots",
        "draftintervaltestwindowshots", "result"],
    "test_creation_test": ["organizationid", "system", "description", "instructions", "passage", "hash",
                           "archivedat", "archivedby", "load_date"],
    "test_creation_question": ["organizationid", "system", "questiontext", "hash", "archivedat", "archivedby",
                               "load_date"],
    "test_creation_assessment": ["organizationid", "system", "instructions", "hash", "archivedat", "archivedby",
                                 "load_date"],
    "test_creation_skill": ["organizationid", "system", "description", "tags", "load_date"],
    "test_creation_assessment_dispatch": [
        "dispatcher", "screenshotsInterval", "camerashotsInterval", "showResults", "conductSurvey", "showClock",
        "dispatchLink", "reportCallbackURL", "retakeDelayHours", "recallReason", "recalledAt", "recalledBy",
        "load_date"],
}
TO_MINUTES = {"test_creation_assessment_taker", "test_execution_testresult", "test_creation_test",
              "test_creation_assessment"}
WITH_NAME = {"test_creation_assessment_taker"}
GOLD_SOURCES = {
    "test_creation_category": ("test_creation", "Category"),
    "test_creation_assessment_taker": ("test_creation", "AssessmentTaker"),
    "test_creation_domain": ("test_creation", "Domain"),
    "test_execution_questionflag": ("test_execution", "QuestionFlag"),
    "test_execution_testresult": ("test_execution", "TestResult"),
    "test_creation_test": ("test_creation", "Test"),
    "test_creation_question": ("test_creation", "Question"),
    "test_creation_assessment": ("test_creation", "Assessment"),
    "test_creation_skill": ("test_creation", "Skill"),
    "test_creation_assessment_dispatch": ("test_creation", "AssessmentDispatch"),
}


def gold_transform(name: str, df: DataFrame) -> DataFrame:
    """CLN5-CLN15: the named gold dataset transform; ValueError when unknown."""
    if name not in GOLD_DROPS:
        raise ValueError(f"Unknown gold dataset: {name}")
    out = prune(df, GOLD_DROPS[name])
    if name in TO_MINUTES:
        out = to_minutes(out)
    if name in WITH_NAME:
        out = with_candidate_name(out)
    return out


def run_silver(spark: SparkSession, bronze_root: str, silver_root: str, database: str, table: str,
               rules: Mapping[tuple[str, str], Rule] | None = None, idempotent: bool = False) -> dict:
    """One silver table: latest bronze snapshot -> clean -> silver snapshot at the same load_date."""
    load_date, df = read_latest(spark, bronze_root, database, table)
    path = write_snapshot(clean(df.drop("load_date"), database, table, rules), silver_root, database, table,
                          load_date, idempotent)
    return {"table": f"{database}/{table}", "status": "ok", "load_date": load_date, "path": path}


def run_gold(spark: SparkSession, silver_root: str, gold_root: str, datasets: Sequence[str],
             sources: Mapping[str, tuple[str, str]] = GOLD_SOURCES, load_date: str | None = None) -> list[dict]:
    """SRC16: every dataset in turn; a failing dataset is reported, the rest still run.

    A gold snapshot carries the date of the silver snapshot it was made from
    (``load_date`` overrides it), so reruns and backfills replace their own
    partition and freshness stays true.
    """
    out = []
    for name in datasets:
        try:
            if name not in sources:
                raise ValueError(f"Unknown gold dataset: {name}")
            db, table = sources[name]
            silver_date, df = read_latest(spark, silver_root, db, table)
            date = load_date or silver_date
            path = write_snapshot(gold_transform(name, df.drop("load_date")), gold_root, db, table, date,
                                  idempotent=True)
            out.append({"dataset": name, "status": "ok", "load_date": date, "path": path})
        except Exception as exc:  # isolate failures per dataset
            out.append({"dataset": name, "status": "error", "error": str(exc).splitlines()[0]})
    return out


def run_pipeline(spark: SparkSession, bronze_root: str, silver_root: str, gold_root: str,
                 tables: Sequence[tuple[str, str]], datasets: Sequence[str], **kw) -> dict:
    """SRC17: silver for every table, then gold for every dataset."""
    silver = []
    for db, table in tables:
        try:
            silver.append(run_silver(spark, bronze_root, silver_root, db, table, kw.get("rules")))
        except Exception as exc:
            silver.append({"table": f"{db}/{table}", "status": "error", "error": str(exc).splitlines()[0]})
    gold = run_gold(spark, silver_root, gold_root, datasets, load_date=kw.get("load_date"))
    return {"silver": silver, "gold": gold}
