"""V24 / DOC3 as a materialised view that is refreshed from each new load.

Keep-latest replaces attempts, so sums over assessments cannot only be added
up. The state is kept where a change is local: the latest row of every attempt,
taker, assessment and flag (:class:`LatestState`, one bucketed merge per load),
and per taker the partial figures of that taker's attempts (counts, sums,
maximum; they merge into any assessment's row). A load rewrites the partials of
the takers it names; the summary adds partials up per assessment, so its cost
follows the number of takers, not of attempts, and a taker who moves between
assessments takes the figures along.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from examlytics.functions import scalar as fx
from examlytics.operators.latest_state import LatestState
from examlytics.plans import org
from examlytics.plans.documented import flag_counts
from examlytics.session import keep, shared_dir
from examlytics.sources.commits import delete_folder
from examlytics.sources.silver import Silver

ATTEMPT_COLS = ["assessmenttakerid", "testid", "attemptnumber", "starttime", "finishtime", "duration", "testpercentage", "passstatus",
                "testwindowviolationcount", "load_date"]


def partials() -> dict[str, Column]:
    """Figures of one taker's attempts that add up (or have a maximum) over takers."""
    minutes = F.col("duration").try_cast("double") / F.lit(60.0)
    return {
        "attempts": F.count(F.lit(1)), "started": F.count_if(fx.iso_to_timestamp(F.col("starttime")).isNotNull()),
        "completed": F.count_if(fx.nonblank("finishtime")), "graded": F.count(F.col("testpercentage")),
        "score_sum": F.sum(F.col("testpercentage").cast("double")), "passes": F.count_if(fx.normalise_pass("passstatus") == "passed"),
        "timed": F.count(minutes), "minutes_sum": F.sum(minutes), "minutes_max": F.max(minutes), "violations": F.sum("testwindowviolationcount"),
    }


class AssessmentSummary:
    """The view's state under ``root`` (default: a fresh folder of the shared folder)."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or f"{shared_dir(spark)}/assessment-summary-{uuid.uuid4().hex}"
        state = lambda name, keys, order=("load_date",), where=None: LatestState(spark, f"{self.root}/{name}", keys, order, where)
        self.attempts = state("attempts", ["assessmenttakerid", "testid", "attemptnumber"], ("load_date", "finishtime"), org.valid_start())
        self.takers = state("takers", ["id"])
        self.assessments = state("assessments", ["id"])
        self.flags = state("flags", ["id"])
        self.partials = state("partials", ["taker"], ("version",))

    def refresh(self, load: Silver) -> None:
        """Take one load: any subset of the tables, each with its new rows only."""
        for table, state, cols in ((load.assessmenttaker, self.takers, ["id", "assessmentid", "load_date"]),
                                   (load.assessment, self.assessments, ["id", "title", "organizationid", "status", "duration", "load_date"]),
                                   (load.questionflag, self.flags, ["id", "questionid", "assessmenttakerid", "load_date"])):
            if table is not None:
                state.merge(table.select(*cols))
        if load.testresult is not None:
            rows = load.testresult.select(*ATTEMPT_COLS)
            latest = self.attempts.merge(rows)
            named = keep(rows.where(org.valid_start()).select(F.col("assessmenttakerid").alias("taker")).distinct(), "named-takers")
            own = latest.join(named, F.col("assessmenttakerid").eqNullSafe(F.col("taker")), "left_semi")
            version = self.partials.log.last()
            number = 1 if version is None else len(self.partials.log.all()) + 1
            self.partials.merge(own.groupBy(F.col("assessmenttakerid").alias("taker")).agg(*[c.alias(k) for k, c in partials().items()])
                                .withColumn("version", F.lit(number)))

    def summary(self) -> DataFrame:
        """The 17 columns, as :func:`examlytics.plans.documented.assessment_summary` computes them from all snapshots."""
        takers = self.takers.current().select("id", F.col("assessmentid").alias("assessment_id"))
        p = self.partials.current().join(takers, F.col("taker") == F.col("id"), "left")
        known = F.col("taker").isNotNull()
        g = p.groupBy("assessment_id").agg(
            F.count_if(known).alias("total_takers"), F.count_if(known & (F.col("started") > 0)).alias("started_takers"),
            F.count_if(known & (F.col("completed") > 0)).alias("completed_takers"), F.sum("graded").alias("graded_attempts"),
            (F.sum("score_sum") / F.nullif(F.sum("graded"), F.lit(0))).alias("average_score"),
            (F.sum("passes") / F.sum("attempts") * 100).alias("pass_rate_pct"),
            (F.sum("minutes_sum") / F.nullif(F.sum("timed"), F.lit(0))).alias("average_duration_minutes"),
            F.max("minutes_max").alias("max_duration_minutes"), F.sum("violations").alias("violation_count"))
        a = self.assessments.current().select(F.col("id").alias("a_id"), "title", "organizationid", "status", "duration")
        flags = flag_counts(self.flags.current(), takers)
        return (g.join(a, F.col("assessment_id") == F.col("a_id"), "left").join(flags, F.col("assessment_id") == F.col("f_id"), "left").select(
            "assessment_id", F.col("title").alias("assessment_title"), F.col("organizationid").alias("organization_id"), "status",
            (F.col("duration").cast("double") / 60).alias("duration_minutes"), "total_takers", "started_takers", "completed_takers",
            fx.pct("completed_takers", "total_takers").alias("completion_rate_pct"), "graded_attempts", "average_score",
            F.col("average_score").alias("average_percentage"), "pass_rate_pct", "average_duration_minutes", "max_duration_minutes",
            "violation_count", F.coalesce("question_flag_count", F.lit(0)).cast("long").alias("question_flag_count")))

    def drop(self) -> None:
        for state in (self.attempts, self.takers, self.assessments, self.flags, self.partials):
            state.drop()
        delete_folder(self.spark, self.root)


def loads(silver: Silver) -> list[Silver]:
    """The loads of a snapshot bundle, oldest first: one bundle per load date (one row per date reaches the driver)."""
    names = ("testresult", "assessmenttaker", "assessment", "questionflag")
    tables = {n: getattr(silver, n) for n in names if getattr(silver, n) is not None}
    dates = {n: {r[0] for r in t.select("load_date").distinct().collect()} for n, t in tables.items()}
    return [replace(silver, **{n: tables[n].where(F.col("load_date") == d) if n in tables and d in dates[n] else None for n in names})
            for d in sorted(set().union(*dates.values()))]
