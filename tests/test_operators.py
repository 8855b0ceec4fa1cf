"""Operators: dedup, ranking, slicers, one-row combine, reshaping."""

import random

from pyspark.sql import functions as F

from examlytics.operators.combine import one_row
from examlytics.operators.dedup import dedup_latest
from examlytics.operators.slicers import apply_slicers, slicer_options, top_n
from examlytics.operators.windows import pct_rank_avg, percent_rank_asc, rank_over


def test_dedup_latest_and_idempotent(spark):
    rows = [("k1", "2030-01-01", "a"), ("k1", "2030-01-08", "b"), ("k1", "2030-01-08", "c"),
            ("k2", None, "z"), ("k2", "2030-01-01", "y")]
    df = spark.createDataFrame(rows, "id string, load_date string, v string")
    d1 = dedup_latest(df, ["id"])
    got = sorted((r.id, r.v) for r in d1.collect())
    # same load_date twice: the tiebreak (remaining columns ascending) decides
    assert got == [("k1", "b"), ("k2", "y")]
    assert sorted(d1.collect()) == sorted(dedup_latest(d1, ["id"]).collect())
    # permutation invariance
    shuffled = df.repartition(3).orderBy(F.rand(7))
    assert sorted(dedup_latest(shuffled, ["id"]).collect()) == sorted(d1.collect())


def test_dedup_pre_filter_changes_latest(spark):
    df = spark.createDataFrame([("k", "2030-01-08", ""), ("k", "2030-01-01", "2025")], "id string, load_date string, s string")
    got = dedup_latest(df, ["id"], pre_filter=F.col("s") != "").collect()
    assert [r.s for r in got] == ["2025"]


def _brute_rank(vals, desc=True):
    nn = [v for v in vals if v is not None]
    out = []
    for v in vals:
        if v is None:
            out.append((None, None, None))
            continue
        better = sum(1 for w in nn if (w > v if desc else w < v))
        ties = sum(1 for w in nn if w == v)
        out.append((better + 1, ties, len(nn)))
    return out


def test_rank_over_matches_brute_force(spark):
    rnd = random.Random(3)
    vals = [rnd.choice([None, 1.0, 2.0, 2.0, 3.5]) if i % 7 else None for i in range(300)]
    vals = [v if v is None else v + rnd.choice([0, 0, 0.25]) for v in vals]
    rows = [(i, f"g{i % 3}", v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "id int, g string, v double")
    got = {r.id: (r.rank_min, r.ties, r.n) for r in rank_over(df, "v", parts=7).collect()}
    exp = _brute_rank(vals)
    assert all(got[i] == exp[i] for i in range(len(vals)))
    # partitioned
    gp = {r.id: (r.rank_min, r.ties, r.n) for r in rank_over(df, "v", ["g"], parts=5).collect()}
    for g in ("g0", "g1", "g2"):
        ids = [i for i in range(len(vals)) if f"g{i % 3}" == g]
        e = _brute_rank([vals[i] for i in ids])
        assert [gp[i] for i in ids] == e


def test_percentiles_from_rank(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, 2.0, 4.0])], "id int, v double")
    r = rank_over(df, "v", parts=2)
    got = {x.id: (x.p, x.q) for x in r.select(
        "id", pct_rank_avg(F.col("rank_min"), F.col("ties"), F.col("n")).alias("p"),
        percent_rank_asc(F.col("rank_min"), F.col("ties"), F.col("n")).alias("q")).collect()}
    # pandas rank(pct=True): [0.25, 0.625, 0.625, 1.0]; SQL percent_rank: [0, 1/3, 1/3, 1]
    assert [got[i][0] for i in range(4)] == [0.25, 0.625, 0.625, 1.0]
    assert [round(got[i][1], 6) for i in range(4)] == [0.0, 0.333333, 0.333333, 1.0]


def test_slicers_and_options(spark):
    df = spark.createDataFrame([("2024", "A"), ("2025", "B"), ("2025", ""), (None, "C")], "year string, spec string")
    assert apply_slicers(df, year=[], spec=None).count() == 4
    assert apply_slicers(df, year=["2025"], missing=["x"]).count() == 2
    assert [r.spec for r in slicer_options(df, "spec", year=["2025"]).collect()] == ["B"]
    assert [r.year for r in top_n(df, 2, [F.col("year").desc_nulls_last()], ["spec"]).collect()] == ["2025", "2025"]


def test_one_row_combines_without_join(spark):
    a = spark.range(5).agg(F.count("*").alias("n"))
    b = spark.range(3).agg(F.max("id").alias("m"), F.lit(None).cast("double").alias("z"))
    r = one_row(a, b).first()
    assert (r.n, r.m, r.z) == (5, 2, None)


def test_sequence_over_matches_window_with_hot_and_null_keys(spark):
    import datetime as dt

    from pyspark.sql import Window

    from examlytics.operators.windows import sequence_over
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        # a third of the rows share one key; some keys are NULL; some times are NULL
        email = "hot@x" if i % 3 == 0 else (None if i % 7 == 0 else f"u{i % 40}@x")
        ts = None if i % 29 == 0 else dt.datetime(2025, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 10_000))
        rows.append((email, f"t{i % 2}", f"k{i}", ts, float(i)))
    df = spark.createDataFrame(rows, "email string, test_id string, taker string, ts timestamp_ntz, v double")
    got = {r.taker: (r.seq, r.prev_v) for r in
           sequence_over(df, ["email", "test_id"], ["ts", "taker"], prev=["v"], parts=6).collect()}
    w = Window.partitionBy("email", "test_id").orderBy(df.ts.asc_nulls_last(), df.taker.asc_nulls_last())
    from pyspark.sql import functions as F
    exp = {r.taker: (r.seq, r.prev_v) for r in
           df.select("taker", F.row_number().over(w).alias("seq"), F.lag("v").over(w).alias("prev_v")).collect()}
    assert got == exp


def _window_sequence(df, order):
    from pyspark.sql import Window
    w = Window.partitionBy("k").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return {r.id: (r.seq, r.prev_v) for r in df.select("id", F.row_number().over(w).alias("seq"), F.lag("v").over(w).alias("prev_v")).collect()}


def test_sequence_over_text_order_narrow_values_and_many_slices(spark):
    from examlytics.operators.windows import sequence_over
    rnd = random.Random(5)
    words = ["", "a", "aa", "ab", "é", "zz", None] + [f"w{i}" for i in range(60)]
    rows = [(i, "hot" if i % 3 else None, rnd.choice(words), 70.0 + rnd.random() / 1000, float(i)) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, k string, word string, score double, v double")
    for order in (["word", "id"], ["score", "id"]):
        for parts in (1, 7, 100):  # 100 slices need several blocks of bounds
            got = {r.id: (r.seq, r.prev_v) for r in sequence_over(df, ["k"], order, prev=["v"], parts=parts).collect()}
            assert got == _window_sequence(df, order), (order, parts)


def test_slices_spread_a_narrow_cluster_of_values(spark):
    from examlytics.operators.windows import _with_slice, numeric_image
    df = spark.range(4000).select((F.lit(70.0) + F.col("id") / 1e6).alias("v"))
    sizes = [r["count"] for r in _with_slice(df.withColumn("b", numeric_image(df, "v")), "b", 40).groupBy("__slice").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 300


def test_rankings_run_nothing_before_an_action(spark):
    from examlytics.operators.windows import sequence_over
    boom = F.udf(lambda x: 1 / 0, "double")
    df = spark.range(10).select("id", boom("id").alias("v"))
    rank_over(df, "v")
    sequence_over(df.withColumn("k", F.lit(1)), ["k"], ["v"])


def test_exact_quantiles_match_numpy(spark):
    import numpy as np

    from examlytics.operators.windows import exact_quantiles
    rng = np.random.default_rng(2)
    rows = [(f"g{i % 3}", float(x)) for i, x in enumerate(rng.normal(size=400).round(1))] + [("one", 5.0), ("one", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.a, r.m, r.z) for r in exact_quantiles(df, "v", ["g"], {"a": 0.25, "m": 0.5, "z": 0.9}, parts=9).collect()}
    for g in ("g0", "g1", "g2", "one"):
        v = [x for k, x in rows if k == g and x is not None]
        assert np.allclose(got[g], np.quantile(v, [0.25, 0.5, 0.9]))


def test_slice_search_is_compiled_and_finds_every_place(spark):
    from examlytics.operators.windows import _with_slice
    df = spark.createDataFrame([(float(i % 50),) for i in range(400)] + [(None,), (float("nan"),)], "v double").withColumn("b", F.col("v"))
    for parts in (2, 7, 33, 200):
        out = _with_slice(df, "b", parts)
        assert "lambda" not in out._jdf.queryExecution().executedPlan().toString()
        rows = [(r.v, r["__slice"]) for r in out.collect()]
        assert {s for v, s in rows if v is None} == {parts}
        numbers = sorted((v, s) for v, s in rows if v is not None and v == v)
        places = [s for _, s in numbers]
        assert places == sorted(places) and max(places) < parts and len(set(places)) > min(parts, 50) // 2
        assert all(places[-1] <= s < parts for v, s in rows if v is not None and v != v)
