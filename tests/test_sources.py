"""Lake I/O, incremental sync, medallion jobs and the streaming extract, in scratch folders."""

import tempfile

import pytest
from pyspark.sql import functions as F

from examlytics.plans import medallion as md
from examlytics.sources import ingest, lake
from examlytics.streaming.incremental import deduplicated, start_bronze_sync, stream_source
from tests.conftest import SF_SMOKE


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="examlytics-test-")


def test_snapshot_write_and_read_latest(spark, scratch):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    lake.write_snapshot(df, scratch, "db", "T", "2030-01-01")
    lake.write_snapshot(df.where("id = 'a'"), scratch, "db", "T", "2030-01-08")
    lake.write_snapshot(df.where("id = 'a'"), scratch, "db", "T", "2030-01-08")  # same-day rerun appends
    d, latest = lake.read_latest(spark, scratch, "db", "T")
    assert d == "2030-01-08" and latest.count() == 2
    lake.write_snapshot(df.where("id = 'a'"), scratch, "db", "T", "2030-01-08", idempotent=True)
    assert lake.read_latest(spark, scratch, "db", "T")[1].count() == 1
    with pytest.raises(FileNotFoundError):
        lake.read_latest(spark, scratch, "db", "Missing")
    names = lake.register_silver(spark, scratch, {"db": ["T"]}, {"db": "src"})
    assert names == ["src_t"] and spark.table("src_t").count() == 3


def test_latest_snapshot_scalar_subquery(spark):
    df = spark.createDataFrame([("a", "2030-01-01"), ("b", "2030-01-08")], "id string, load_date string")
    assert [r.id for r in lake.latest_snapshot(df).collect()] == ["b"]


def test_sync_twice_and_crash_between(spark, scratch):
    events = spark.read.parquet(f"{SF_SMOKE}/events.parquet")
    bronze, state = f"{scratch}/bronze", f"{scratch}/state"
    n1 = ingest.sync_table(spark, events, "events", bronze, state, wm_col="ts", run_date="2030-01-01")
    assert n1 == events.count()
    assert ingest.get_watermark(spark, state, "events") is not None
    assert ingest.sync_table(spark, events, "events", bronze, state, wm_col="ts", run_date="2030-01-02") == 0
    # new rows after the watermark are picked up once
    later = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 3650 DAYS")).limit(5)
    assert ingest.sync_table(spark, later, "events", bronze, state, wm_col="ts", run_date="2030-01-03") == 5
    with pytest.raises(ValueError):
        ingest.validate_table_name("bad-name;drop")


def test_incremental_extract_strict(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "updated_at int")
    b, wm = ingest.incremental_extract(df, "updated_at", 2)
    assert [r[0] for r in b.collect()] == [3] and wm == 3
    b, wm = ingest.incremental_extract(df, "updated_at", 3)
    assert b.count() == 0 and wm == 3
    b, wm = ingest.incremental_extract(df, "updated_at", None, table="t_1")
    assert b.count() == 3 and wm == 3


def test_gold_transforms_case_sensitive(spark):
    df = spark.createDataFrame([("o.neil.x@a.com", 120.0, "keep", "x", "d")],
                               "email string, duration double, organizationId string, showclock string, load_date string")
    out = md.gold_transform("test_creation_assessment_taker", df)
    assert out.columns == ["email", "duration", "organizationId", "candidatename"]
    r = out.first()
    assert r.duration == 2.0 and r.candidatename == "O Neil X"
    disp = spark.createDataFrame([(1, 2)], "showResults int, showresults int")
    assert md.gold_transform("test_creation_assessment_dispatch", disp).columns == ["showresults"]
    with pytest.raises(ValueError):
        md.gold_transform("nope", df)


def test_pipeline_isolates_failures(spark, scratch):
    bronze, silver, gold = f"{scratch}/b", f"{scratch}/s", f"{scratch}/g"
    taker = spark.createDataFrame([("t1", "a.b@x.com", 60.0)], "id string, email string, duration double")
    lake.write_snapshot(taker, bronze, "test_creation", "AssessmentTaker", "2030-01-01")
    res = md.run_pipeline(spark, bronze, silver, gold, [("test_creation", "AssessmentTaker")],
                          ["test_creation_assessment_taker", "test_creation_category"], load_date="2030-01-02")
    assert res["silver"][0]["status"] == "ok"
    st = {g["dataset"]: g["status"] for g in res["gold"]}
    assert st == {"test_creation_assessment_taker": "ok", "test_creation_category": "error"}
    _, g = lake.read_latest(spark, gold, "test_creation", "AssessmentTaker")
    assert g.first().candidatename == "A B" and g.first().duration == 1.0


def test_infer_numeric_and_query_view(spark):
    df = spark.createDataFrame([("1", "a"), (" 2.5", "3"), ("", None)], "x string, y string")
    out = lake.infer_numeric(df)
    assert dict(out.dtypes) == {"x": "double", "y": "string"}
    df.createOrReplaceTempView("tmp_v")
    assert lake.query_view(spark, "tmp_v", limit=2, order_by=["x"]).count() == 2
    assert lake.run_sql(spark, "select count(*) c from tmp_v where y = :y", {"y": "3"}).first().c == 1


def test_streaming_bronze_sync(spark, scratch):
    schema = spark.read.parquet(f"{SF_SMOKE}/events.parquet").schema
    src = stream_source(spark, f"{SF_SMOKE}/events*.parquet", schema)
    q = start_bronze_sync(deduplicated(src, "event_id", "ts"), f"{scratch}/bronze", "events",
                          f"{scratch}/ckpt", run_date="2030-01-01")
    q.awaitTermination(120)
    got = spark.read.parquet(f"{scratch}/bronze/table=events")
    assert got.count() == spark.read.parquet(f"{SF_SMOKE}/events.parquet").select("event_id").distinct().count()
    # a second run with the same checkpoint finds nothing new
    q2 = start_bronze_sync(deduplicated(stream_source(spark, f"{SF_SMOKE}/events*.parquet", schema), "event_id", "ts"),
                           f"{scratch}/bronze", "events", f"{scratch}/ckpt", run_date="2030-01-02")
    q2.awaitTermination(120)
    assert spark.read.parquet(f"{scratch}/bronze/table=events").count() == got.count()


def test_replayed_micro_batch_replaces_itself(spark, scratch):
    schema = spark.read.parquet(f"{SF_SMOKE}/events.parquet").schema
    # a new checkpoint delivers the same first batch again, as after a crash before its commit
    for ckpt in ("ckpt-a", "ckpt-b"):
        start_bronze_sync(stream_source(spark, f"{SF_SMOKE}/events*.parquet", schema), f"{scratch}/bronze", "events",
                          f"{scratch}/{ckpt}", run_date="2030-01-01").awaitTermination(120)
    got = spark.read.parquet(f"{scratch}/bronze/table=events")
    assert got.count() == spark.read.parquet(f"{SF_SMOKE}/events.parquet").count()


def test_gold_keeps_the_silver_date(spark, scratch):
    silver, gold = f"{scratch}/s", f"{scratch}/g"
    lake.write_snapshot(spark.createDataFrame([("c1", "Node")], "id string, name string"), silver, "test_creation", "Category", "2030-01-08")
    for _ in range(2):  # a rerun replaces its own partition
        out = md.run_gold(spark, silver, gold, ["test_creation_category"])
    assert out[0]["load_date"] == "2030-01-08"
    date, rows = lake.read_latest(spark, gold, "test_creation", "Category")
    assert date == "2030-01-08" and rows.count() == 1


def test_crash_between_write_and_watermark_resyncs(spark, scratch):
    events = spark.read.parquet(f"{SF_SMOKE}/events.parquet")
    bronze, state = f"{scratch}/bronze", f"{scratch}/state"
    # a run that wrote its batch but died before advancing the watermark
    lake.write_bronze(events, bronze, "events", "2030-01-01")
    assert ingest.get_watermark(spark, state, "events") is None
    # the next run re-reads the same rows (at-least-once) and then advances
    assert ingest.sync_table(spark, events, "events", bronze, state, wm_col="ts", run_date="2030-01-02") == events.count()
    assert ingest.sync_table(spark, events, "events", bronze, state, wm_col="ts", run_date="2030-01-03") == 0


def test_result_parse_failfast(spark):
    from examlytics.operators.nested import parse_results
    df = spark.createDataFrame([('[{"questionId":"q1","score":1}]',), ("[{",)], "r string")
    ok = df.select(parse_results("r").alias("p")).collect()
    assert ok[0].p[0].questionId == "q1" and ok[1].p is None
    with pytest.raises(Exception):
        df.select(parse_results("r", mode="FAILFAST").alias("p")).collect()


def test_drifting_partitions_are_reconciled(spark, tmp_path):
    """Partitions that disagree in columns, integer width and kind; partitions of equal schema share a scan."""
    from examlytics.sources import lake
    root = str(tmp_path / "t")
    for day, frame in (("2030-01-01", "1 as id, 2 as n, 'x' as a"), ("2030-01-02", "cast(3 as bigint) as id, 1.5D as n"), ("2030-01-03", "cast(4 as bigint) as id, 2.5D as n"),
                       ("2030-01-04", "cast(5 as smallint) as id, 'many' as n, true as b")):
        spark.sql(f"select {frame}").write.parquet(f"{root}/load_date={day}")
    df = lake.read_reconciled(spark, root)
    assert dict(df.dtypes) == {"id": "bigint", "n": "string", "a": "string", "b": "boolean", "load_date": "string"}
    got = {r.load_date[-2:]: (r.id, r.n, r.a, r.b) for r in df.collect()}
    assert got == {"01": (1, "2", "x", None), "02": (3, "1.5", None, None), "03": (4, "2.5", None, None), "04": (5, "many", None, True)}
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 3
    assert lake.common_type(["int", "bigint"]) == "bigint" and lake.common_type(["int", "float"]) == "double" and lake.common_type(["date", "timestamp"]) == "timestamp"


def test_response_lists_are_made_after_the_shuffle(spark):
    """Lines travel as numbers; neither element texts nor partial lists are shuffled."""
    from examlytics.sources.fixtures import result_json
    lines = spark.createDataFrame(
        [(1, 2, 8, 9, 5.0, "R", "F"), (1, 1, 7, 9, 6.0, "A", "O"), (None, 1, 7, 9, 6.0, "A", "O")],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string, l_linestatus string")
    made = result_json(lines)
    plan = made._jdf.queryExecution().sparkPlan().toString() + made._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" in plan and "collect_list" not in plan.rsplit("Exchange", 1)[1]
    assert "questionId" not in plan.rsplit("Exchange", 1)[1]
    got = {r.l_orderkey: r.result for r in made.collect()}
    first = '{"questionId":"q-7","score":6,"scored":6,"idleTime":9,"isAnswered":false,"isAnswerCorrect":true}'
    second = '{"questionId":"q-8","score":5,"scored":0,"idleTime":9,"isAnswered":true,"isAnswerCorrect":false}'
    assert got == {1: f"[{first},{second}]", None: f"[{first}]"}
