"""Load-by-load keep-latest, committed batches, the refreshed summary and the cubes, against the one-pass forms."""
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from examlytics.operators.dedup import dedup_latest
from examlytics.operators.latest_state import LatestState
from examlytics.plans import cohort, cube, documented, materialised, org
from examlytics.sources import commits, ingest
from examlytics.sources.fixtures import silver_from_driver
from tests.conftest import SF_SMOKE

SCHEMA = "taker string, attempt long, load_date string, finished string, score int, result string"


def snapshots(seed, n=400):
    """Rows of three loads with NULL keys, repeated keys, equal order values and reloads."""
    rng = random.Random(seed)
    rows = [(rng.choice([None, "a", "b", 'q"', "null"]), rng.choice([None, 1, 2, 3]), rng.choice(["2030-01-01", "2030-01-08", "2030-01-15"]),
             rng.choice([None, "x", "y"]), rng.choice([None, 1, 2]), rng.choice(["[{", "", None])) for _ in range(n)]
    return rows + rows[:20]


def rows_of(df):
    return sorted((str(tuple(r)) for r in df.collect()))


@pytest.mark.parametrize("dates", [("2030-01-01", "2030-01-08", "2030-01-15"), ("2030-01-15", "2030-01-01", "2030-01-08", "2030-01-15")])
def test_merged_loads_equal_the_pick_over_all(spark, tmp_path, dates):
    """Also when loads come in another order, and one comes twice."""
    df = spark.createDataFrame(snapshots(1), SCHEMA)
    where = F.coalesce(F.col("result").startswith("[{"), F.lit(False))
    state = LatestState(spark, str(tmp_path), ["taker", "attempt"], ("load_date", "finished"), where, buckets=4)
    for d in dates:
        state.merge(df.where(F.col("load_date") == d))
    want = dedup_latest(df, ["taker", "attempt"], ["load_date", "finished"], where)
    assert rows_of(state.current()) == rows_of(want.select(*df.columns)) and state.current().columns == df.columns
    again = LatestState(spark, str(tmp_path), ["taker", "attempt"], ("load_date", "finished"), where)
    assert again.buckets == 4 and rows_of(again.current()) == rows_of(want)
    again.vacuum()
    assert rows_of(again.current()) == rows_of(want)
    state.drop()


def test_state_side_has_no_exchange(spark, tmp_path):
    """Only the load is shuffled, into the state's buckets."""
    df = spark.createDataFrame(snapshots(2), SCHEMA)
    state = LatestState(spark, str(tmp_path), ["taker", "attempt"], buckets=4)
    state.merge(df.where("load_date = '2030-01-01'"))
    load = spark.createDataFrame(snapshots(3), SCHEMA)
    plan = state.merged(load)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("SortMergeJoin", 1)[1].split("\n")[1:]
    second = next(i for i, line in enumerate(lines) if i and line.lstrip().startswith("+- ") and line.index("+") == lines[0].index(":"))
    left, right = "\n".join(lines[:second]), "\n".join(lines[second:])
    assert "Bucketed: true" in left and "Exchange" not in left
    assert "Exchange" in right
    state.drop()


def test_crash_before_the_commit_keeps_the_old_state(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame(snapshots(4), SCHEMA)
    state = LatestState(spark, str(tmp_path), ["taker", "attempt"], buckets=2)
    state.merge(df.where("load_date = '2030-01-01'"))
    before = rows_of(state.current())
    monkeypatch.setattr(commits.CommitLog, "commit", lambda self, **f: (_ for _ in ()).throw(IOError("lost")))
    with pytest.raises(IOError):
        state.merge(df.where("load_date = '2030-01-08'"))
    monkeypatch.undo()
    opened = LatestState(spark, str(tmp_path), ["taker", "attempt"])
    assert rows_of(opened.current()) == before
    opened.merge(df.where("load_date = '2030-01-08'"))
    assert rows_of(opened.current()) == rows_of(dedup_latest(df.where("load_date < '2030-01-15'"), ["taker", "attempt"]))


EVENTS = "id long, updated_at timestamp, v string"


def events(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, at string, v string").select("id", F.col("at").cast("timestamp").alias("updated_at"), "v")


def test_committed_batches_survive_crashes(spark, tmp_path):
    """A crash after the data, after the ids at the mark, or inside the commit; rows that share the watermark come late."""
    a, b, c = (1, "2024-01-01 10:00:00", "a"), (2, "2024-01-01 11:00:00", "b"), (3, "2024-01-01 11:00:00", "c")
    d, e = (4, "2024-01-01 11:00:00", "d"), (5, "2024-01-01 12:00:00", "e")
    sync = ingest.CommittedSync(spark, str(tmp_path), "events", ["id"])
    with pytest.raises(FileNotFoundError):
        sync.read()
    assert sync.sync(events(spark, a, b)) == 2
    assert sync.sync(events(spark, a, b)) == 0
    # Data and ids are written, the commit is not.
    assert sync.stage(events(spark, a, b, c))["rows"] == "1"
    assert sorted(r.id for r in sync.read().collect()) == [1, 2]
    # The commit's folder is there without its marker.
    spark.range(1).write.parquet(f"{tmp_path}/table=events/_commits/{2:012d}")
    commits.delete_folder(spark, f"{tmp_path}/table=events/_commits/{2:012d}/_SUCCESS")
    assert sorted(r.id for r in sync.read().collect()) == [1, 2]
    assert sync.sync(events(spark, a, b, c)) == 1
    assert sync.sync(events(spark, a, b, c, d, e)) == 2
    assert sync.sync(events(spark, a, b, c, d, e)) == 0
    assert sorted(r.id for r in sync.read().collect()) == [1, 2, 3, 4, 5]
    other = ingest.CommittedSync(spark, str(tmp_path), "events", ["id"])
    assert other.log.last()["watermark"].startswith("2024-01-01 12")


@pytest.fixture(scope="module")
def silver(spark):
    return silver_from_driver(spark, SF_SMOKE)


def test_refreshed_summary(spark, silver, tmp_path):
    """Load by load it equals the recomputation after every load; no column is NULL throughout."""
    view = materialised.AssessmentSummary(spark, str(tmp_path))
    steps = materialised.loads(silver)
    assert len(steps) == 2 and steps[0].testresult is not None
    for n, load in enumerate(steps, 1):
        view.refresh(load)
        seen = replace(silver, **{t: getattr(silver, t).where(F.col("load_date") <= ("2030-01-01" if n == 1 else "2030-01-31"))
                                  for t in ("testresult", "assessmenttaker", "assessment", "questionflag")})
        want = documented.assessment_summary(org.candidate_performance(seen), seen)
        key = lambda df: sorted(str(tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r)) for r in df.collect())
        assert key(view.summary()) == key(want.select(*view.summary().columns))
    got = view.summary().agg(*[F.count(c).alias(c) for c in view.summary().columns]).first()
    assert all(got[c] > 0 for c in got.__fields__)
    view.drop()


#: Keep-latest pick -> table, and a query whose rows change when the oldest snapshot is taken instead.
DECIDES = {
    "DED1": ("testresult", lambda s, s_: org.latest_attempts(s_).select("assessmenttakerid", "testid", "attemptnumber", "testpercentage", "passstatus")),
    "DED2": ("assessmenttaker", lambda s, s_: org.candidate_performance(s_).select("assessment_taker_id", "email", "assessment_id")),
    "DED3": ("organization", lambda s, s_: org.candidate_performance(s_).select("organization_name")),
    "DED4": ("test", lambda s, s_: org.candidate_performance(s_).select("test_difficulty")),
    "DED5": ("dispatch", lambda s, s_: cohort.cohort_attempt(s, org.candidate_performance(s_), s_, algo="md5").select("cohort")),
    "DED6": ("domain", lambda s, s_: cohort.cohort_attempt(s, org.candidate_performance(s_), s_, algo="md5").select("specialization")),
    "DED7": ("question", lambda s, s_: org.trainer_kpis(s_)),
    "DED8": ("category", lambda s, s_: cohort.specialization_tech_kpis(s, s_)),
    "DED9": ("testresult", lambda s, s_: cohort.latest_valid_results(s_).select("assessmenttakerid", "result")),
}


@pytest.mark.parametrize("pick", DECIDES)
def test_fixtures_make_the_latest_snapshot_decide(spark, silver, pick):
    table, view = DECIDES[pick]
    flipped = getattr(silver, table).withColumn("load_date", F.when(F.col("load_date") == "2030-01-01", "2030-02-01").otherwise(F.col("load_date")))
    assert rows_of(view(spark, silver)) != rows_of(view(spark, replace(silver, **{table: flipped})))


def test_fixtures_make_the_filter_before_the_pick_decide(silver):
    """Keeping the latest first and filtering afterwards loses attempts whose newest row is unusable."""
    keys = ["assessmenttakerid", "testid", "attemptnumber"]
    for rows, where in ((silver.testresult.select(*org.TESTRESULT_COLS), org.valid_start()),
                        (silver.testresult.select(*keys, "result", "load_date"), cohort.has_results())):
        assert dedup_latest(rows, keys, pre_filter=where).count() > dedup_latest(rows, keys).where(where).count()


def test_dense_ids(spark):
    rows = spark.createDataFrame([(f"t{i % 700}", f"g{i % 7}") for i in range(3000)] + [(None, "g1")], "v string, g string")
    got = cube.dense_ids(rows, "v", "g").collect()
    assert sorted(r.id for r in got) == list(range(700)) and len({r.v for r in got}) == 700


def test_rollups_read_the_cube_only(spark, analytics):
    """No view of the cube scans the facts, and none shuffles more than its cube."""
    facts = {f.rsplit("/", 1)[0] for f in analytics.cp.inputFiles() + analytics.ca().inputFiles()}
    for df in (cube.monthly_trend(analytics.executive_cube), cube.organization_overview(analytics.executive_cube), cube.cohort_kpis(analytics.cohort_cube),
               cube.specialization_kpis(analytics.cohort_cube), cube.cohort_progression(analytics.cohort_cube)):
        assert not facts & {f.rsplit("/", 1)[0] for f in df.inputFiles()}


def test_median_sketches_keep_their_rank_bound(spark):
    """Merged from many small groups, against exact ranks; small groups are exact."""
    k, rng = 200, random.Random(3)
    data = [(f"g{i % 3}", f"m{i % 50}", float(rng.randrange(100_000))) for i in range(60_000)] + [("one", "m", 5.0), ("none", "m", None)]
    facts = spark.createDataFrame(data, "cohort string, attempt_month string, score double")
    c = cube.Cube(facts, ["cohort", "attempt_month"], {"attempts": F.count(F.lit(1))}, {}, "cohort", sketched="score", k=k)
    got = {r.cohort: r.m for r in c.rollup(["cohort"], median="m").collect()}
    assert got["one"] == 5.0 and got["none"] is None
    for g in ("g0", "g1", "g2"):
        x = sorted(v for a, _, v in data if a == g)
        rank = sum(v <= got[g] for v in x) / len(x)
        assert abs(rank - 0.5) <= 2.296 / k ** 0.9021


def rows_scanned(df):
    """Rows that the scans of an executed plan put out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookups_open_few_row_groups(spark, tmp_path):
    """A lookup by the clustering key, and one by a bloom-filtered key that lies all over, read a small share of the rows."""
    from examlytics.sources.lake import write_lookup
    n = 200_000
    df = spark.range(n).select(F.concat(F.lit("user."), F.col("id") % 5000).alias("email"), F.md5(F.col("id").cast("string")).alias("taker"), F.col("id").alias("n"))
    copy = write_lookup(df, str(tmp_path / "copy"), ["email"], ["taker"], row_group_bytes=1 << 16)
    assert copy.count() == n and copy.columns == df.columns
    by_email, taker = copy.where("email = 'user.77'"), df.where("n = 4242").first().taker
    by_taker = copy.where(F.col("taker") == taker)
    assert sorted(r.n for r in by_email.collect()) == list(range(77, n, 5000)) and [r.n for r in by_taker.collect()] == [4242]
    assert rows_scanned(by_email) < n / 5 and rows_scanned(by_taker) < n / 5


def test_option_lists_of_a_chain_come_from_one_scan(spark, tmp_path):
    from examlytics.operators.slicers import cascading_options, slicer_options
    rng = random.Random(6)
    rows = [(rng.choice(["24", "25", "", None]), rng.choice(["a", "b", "c"]), rng.choice(["x", "y", "z", None])) for _ in range(300)]
    spark.createDataFrame(rows, "year string, cohort string, spec string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    picked = {"year": ["25"], "cohort": ["a", "b"]}
    got = cascading_options(df, ["year", "cohort", "spec"], **picked)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    table = {(r.slicer, r.value): (r.rows, r.rows_under_others) for r in got.collect()}
    for c, upstream in (("year", {}), ("cohort", {"year": picked["year"]}), ("spec", picked)):
        assert sorted(v for s, v in table if s == c) == [r[0] for r in slicer_options(df, c, **upstream).collect()]
    assert table["year", "24"] == (sum(r[0] == "24" for r in rows), sum(r[0] == "24" and r[1] in "ab" for r in rows))
    assert table["spec", "x"][0] == sum(r[0] == "25" and r[1] in "ab" and r[2] == "x" for r in rows)
