"""Remaining public functions: dataset reader, CSV export, view registration, joins, weighted mean, drill-down."""

import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from examlytics.functions.html import clean_text
from examlytics.operators.combine import weighted_mean
from examlytics.operators.joins import keyword_join, point_lookup, semi_filter
from examlytics.plans import marts, registry
from examlytics.plans.seeds import cohort_tag_vocabulary
from examlytics.session import configure
from examlytics.sources import lake


def test_read_dataset_fallback_and_export(spark):
    root = tempfile.mkdtemp(prefix="examlytics-ds-")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    df.write.parquet(f"{root}/legacy/things")
    assert lake.read_dataset(spark, root, "things", legacy_prefixes=["legacy"]).count() == 1
    empty = lake.read_dataset(spark, root, "missing", schema=df.schema)
    assert empty.count() == 0 and empty.columns == ["id", "v"]
    out = lake.export_csv(df, f"{root}/csv")
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["id", "v"] and back.first().v == "a"


def test_register_all_publishes_views(spark, analytics):
    names = registry.register_all(analytics, only=["monthly_trend", "trainer_kpis", "coverage"])
    assert names == ["monthly_assessment_trend", "executive_trainer_kpis", "additional_analytics_coverage"]
    assert spark.table("additional_analytics_coverage").count() == 1


def test_join_helpers_and_weighted_mean(spark):
    tags = spark.createDataFrame([("t1", "2025 National Service Personnel"), ("t2", "Frontend"),
                                  ("t3", "IT Skill Batch")], "taker_id string, tag string")
    got = sorted((r.taker_id, r.program) for r in keyword_join(tags, cohort_tag_vocabulary(spark)).collect())
    assert got == [("t1", "NSP"), ("t3", "Upskilling")]
    keys = spark.createDataFrame([("t1",), (None,)], "taker_id string")
    assert [r.taker_id for r in semi_filter(tags, keys, "taker_id").collect()] == ["t1"]
    assert point_lookup(tags, taker_id="t2", tag="Frontend").count() == 1
    many = spark.createDataFrame([("t", 1, "x"), ("t", 3, "b"), ("t", 3, "a"), ("u", 9, "z")], "id string, n int, v string")
    assert [tuple(r) for r in point_lookup(many, order_by=["n"], id="t").collect()] == [("t", 3, "a")]
    w = spark.createDataFrame([(50.0, 2), (80.0, 1), (None, 5), (10.0, 0)], "v double, w int")
    assert w.agg(weighted_mean("v", "w").alias("m")).first().m == 60.0
    none = spark.createDataFrame([(None, 1)], "v double, w int")
    assert none.agg(weighted_mean("v", "w").alias("m")).first().m is None


def test_candidate_history_and_clean_text(spark, analytics):
    cp = analytics.cp
    email = cp.where(F.col("email").isNotNull()).select("email").orderBy("email").first().email
    kpis, attempts = marts.candidate_history(cp, email)
    k = kpis.first()
    assert k.total_attempts == attempts.count() == cp.where(F.col("email") == email).count()
    q = clean_text(analytics.silver.question.select("id", "questiontext"), ["questiontext"])
    row = q.where(F.col("questiontext") != "").first()
    assert "<" not in row.questiontext_text and "&" not in row.questiontext_text.replace(" & ", "")


def test_what_a_task_sorts_does_not_follow_the_table(spark):
    """More bytes make more tasks of a shuffle than spark.sql.shuffle.partitions has, not larger ones."""
    cols = [F.xxhash64("id", F.lit(i)).alias(f"v{i}") for i in range(4)]
    rows = configure(spark).range(6_000_000).select("id", *cols)
    numbered = rows.withColumn("n", F.row_number().over(Window.partitionBy("v3").orderBy("id"))).withColumn("task", F.spark_partition_id())
    got = numbered.agg(*[F.max(f"v{i}") for i in range(4)], F.sum("n").alias("n"), F.count_distinct("task").alias("tasks")).first()
    assert got.n == 6_000_000
    assert got.tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
