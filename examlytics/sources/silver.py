"""The silver table bundle every view reads.

Silver tables hold every snapshot of every key (a ``load_date`` per load);
views deduplicate them. :class:`Silver` names the tables the analytics
use. It can be built from a lake (:func:`examlytics.sources.lake.register_silver`)
or derived from the benchmark tables (:mod:`examlytics.sources.fixtures`).
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

# Catalog names of the silver tables, with their source prefix.
SILVER_TABLE_NAMES = {
    "testresult": "test_execution_testresult",
    "assessmenttaker": "test_creation_assessmenttaker",
    "dispatch": "test_creation_assessmentdispatch",
    "test": "test_creation_test",
    "assessment": "test_creation_assessment",
    "question": "test_creation_question",
    "category": "test_creation_category",
    "domain": "test_creation_domain",
    "organization": "user_mgt_organizations",
    "questionflag": "test_execution_questionflag",
}


@dataclass(frozen=True)
class Silver:
    testresult: DataFrame
    assessmenttaker: DataFrame
    dispatch: DataFrame
    test: DataFrame
    assessment: DataFrame
    question: DataFrame
    category: DataFrame
    domain: DataFrame
    organization: DataFrame
    questionflag: DataFrame | None = None  # only the assessment summary reads it

    def register(self, spark: SparkSession | None = None) -> None:
        """Expose the tables under their catalog names as temp views."""
        for f in fields(self):
            if getattr(self, f.name) is not None:
                getattr(self, f.name).createOrReplaceTempView(SILVER_TABLE_NAMES[f.name])

    @classmethod
    def from_catalog(cls, spark: SparkSession) -> "Silver":
        return cls(**{k: spark.table(v) for k, v in SILVER_TABLE_NAMES.items() if k != "questionflag" or spark.catalog.tableExists(v)})
