"""Neighbours against brute force; classifiers by held-out accuracy; the pipeline stage by stage."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from examlytics.llm import neighbours, quality, toxicity


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, tile string")


def nearest_by_force(rows, modulus, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(np.float32(x)) for x in v) and any(v):
            v = [float(np.float32(x)) for x in v]
            good[i] = min(good.get(i, v), v)
    out = []
    for q in good:
        if q % modulus == 0:
            d = sorted((float(np.sqrt(np.cumsum((np.array(good[q]) - np.array(good[c])) ** 2)[-1])), c) for c in good if c != q and len(good[c]) == len(good[q]))
            out += [(q, r + 1, c, s) for r, (s, c) in enumerate(d[:k])]
    return sorted(out)


@pytest.mark.parametrize("tile,columns,k", [(16, 3, 5), (1000, 1, 10), (7, 8, 300)])
def test_nearest_equals_brute_force(spark, tile, columns, k):
    rng = np.random.default_rng(tile)
    rows = [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(200)]
    rows += [(200 + i, rows[5][1]) for i in range(20)] + [(300, [1e30] + [0.0] * 11), (302, [1e-30] * 12), (310, [1.0, 2.0]), (311, [2.0, 1.0]), (320, [3.0, 1.0])]
    rows += [(400, None), (401, []), (402, [0.0] * 12), (403, [float("nan")] + [1.0] * 11), (404, [float("inf")] + [1.0] * 11), (405, [None] + [1.0] * 11), (None, [1.0] * 12), (10, rows[10][1]), (10, rows[11][1])]
    got = neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 10 == 0, k, tile, columns)
    assert sorted(tuple(r) for r in got.collect()) == nearest_by_force(rows, 10, k)


def test_nearest_of_nothing(spark):
    assert neighbours.nearest(vectors(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert neighbours.nearest(vectors(spark, [(10, [1.0])]), F.col("vec_id") % 10 == 0).count() == 0


@pytest.mark.parametrize("scale", [1.0, 1e-25])  # by float32 and by float64 products
def test_nearest_in_a_cell_of_copies(scale):
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(3000, 6)) * scale).astype(np.float32)
    x[500:1500] = x[1]  # one vector a thousand times, and vectors next to it
    x[1500:1600] = np.nextafter(x[1], np.float32(1))
    ids = rng.permutation(3000)
    asked = np.flatnonzero(ids % 4 == 0)
    cell = neighbours._Cell([6, 0, 0], 512, 10)
    for side, rows in ((neighbours.QUERY, asked), (neighbours.CANDIDATE, np.arange(3000))):
        for s in range(0, len(rows), 400):
            cell.add(side, ids[rows[s:s + 400]], x[rows[s:s + 400]])
    got = sorted((s["query_id"], s["score"], s["vec_id"]) for b in cell.result() for s in b.to_pylist())
    want = []
    for q in asked:
        d = np.sqrt(np.cumsum((x[q].astype(float) - x.astype(float)) ** 2, axis=1)[:, -1])
        want += [(ids[q], d[c], ids[c]) for c in np.lexsort((ids, d))[:11] if c != q][:10]
    assert got == sorted(want)


def test_nearest_grid_follows_the_tables():
    # 6 GB of embeddings: no copy of a candidate, and copies of the queries below a quarter of the candidates.
    size = 5 * 64 + 32 + 160
    assert neighbours.grid(236_000, 236_000 * size, 23_600_000, 600) == (1, 46)
    for n, parallel in ((2_000, 12), (615_000, 600), (23_600_000, 4000), (100_000_000, 4000)):
        rows, columns = neighbours.grid(n // 100, n // 100 * size, n, parallel)
        assert n // 100 * size / rows <= neighbours.QUERY_BYTES and n / columns <= neighbours.CANDIDATE_ROWS
        assert n // 100 * (columns - 1) <= max(rows * n / 4, n // 100 * n / neighbours.CANDIDATE_ROWS)
    assert neighbours.grid(0, 0, 0, 8) == (1, 1)


def test_nearest_broadcasts_no_vectors(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(100)]
    try:
        # Spark's default: before, the few queries were broadcast with a copy for each column.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        got = neighbours.nearest(vectors(spark, rows), F.col("vec_id") % 10 == 0, 3, columns=20)
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(tuple(r) for r in got.collect()) == nearest_by_force(rows, 10, 3)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def corpus(seed, n=240):
    """Clean prose, junk of several kinds, and toxic words inside prose, in two languages."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["the", "on", "er", "in", "ti", "re", "st"]) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randint(20, 80))]
        good, toxic = rng.random() < 0.6, rng.random() < 0.4
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["vilest", "vileur", "scumbag", "scumbags"])
        if not good:
            kind = rng.randrange(3)
            w = [x + "$$$" for x in w] if kind == 0 else [x.upper() + "!!" for x in w] if kind == 1 else [x for x in w[:8] for _ in range(6)] + w[8:20]
        docs.append((i, " ".join(w), "en" if i % 3 else "fr", "s", 1))
        labels.append((i, int(good), int(toxic)))
    docs += [(n, "", "en", "s", 0), (n + 1, None, "fr", "s", 0), (None, "the on er", "en", "s", 9), (0, docs[0][1], "en", "s", 1)]
    return docs, labels + [(None, 1, 1), (3, None, None), (10**6, 1, 0)]


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus(1)
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").cache(),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache())


def held_out_accuracy(rows, labels, column, cut, modulus):
    truth = {r.doc_id: r[column] for r in labels.collect() if r.doc_id is not None and r[column] is not None}
    held = [(r.score >= cut) == truth[r.doc_id] for r in rows if r.doc_id in truth and r.doc_id % modulus == 0]
    return np.mean(held)


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    model = quality.fit(docs, labels, F.col("doc_id") % 3 != 0, per_class=100)
    rows = quality.score(docs, model).collect()
    assert len(rows) == 244 and all(0 <= r.score <= 1 for r in rows)
    assert held_out_accuracy(rows, labels, "quality", 0.5, 3) >= 0.9


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels, F.col("doc_id") % 3 != 0, per_class=100)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 244 and all(0 <= r.score <= 1 for r in rows)
    assert held_out_accuracy(rows, labels, "toxic", 0.5, 3) >= 0.9


def test_toxicity_trained_in_several_shards(tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels, F.col("doc_id") % 3 != 0, shard=40)
    assert held_out_accuracy(toxicity.score(docs, model).collect(), labels, "toxic", 0.5, 3) >= 0.9


def test_toxicity_learns_from_every_labelled_row(spark):
    """A word that only labelled rows of the largest hashes have is learned too."""
    rng = random.Random(5)
    ids = [r.id for r in spark.range(4400).orderBy(F.xxhash64("id"), "id").collect()]
    docs, labels = [], []
    for place, i in enumerate(ids):
        toxic = place % 2
        words = [rng.choice(["the", "river", "stone", "paper", "green"]) for _ in range(8)]
        if toxic:
            words[rng.randrange(8)] = "scumbag" if place < 3900 else "vilest"
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    probe = spark.createDataFrame([(1, "the green vilest river stone paper"), (2, "the green river stone paper"), (3, "scumbag green river")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score(probe, model).collect()}
    assert scores[1] > 0.5 and scores[3] > 0.5 and scores[2] < 0.5


def test_scores_do_not_depend_on_slices_or_language(tables, spark):
    docs, labels = tables
    model = toxicity.fit(docs, labels, F.col("doc_id") % 3 != 0, per_class=60)
    one = {r.doc_id: r.score for r in toxicity.score(docs.repartition(7), model).collect()}
    two = {r.doc_id: r.score for r in toxicity.score(docs.coalesce(1).withColumn("lang", F.lit("xx")), model).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-6 for k in one)


def test_models_without_labels(tables):
    docs, labels = tables
    for fit, score in ((quality.fit, quality.score), (toxicity.fit, toxicity.score)):
        rows = score(docs, fit(docs, labels.filter("false"), F.lit(True))).collect()
        assert len(rows) == 244 and len({round(r.score, 9) for r in rows}) == 1


def test_calibration_picks_the_separating_cut():
    overall, each = toxicity.calibrate(np.array([0.1, 0.2, 0.6, 0.9] * 10), np.array([0.0, 0, 1, 1] * 10), ["en"] * 20 + ["fr"] * 20)
    assert 0.2 < overall < 0.6 and set(each) == {"en", "fr"}


def test_pipeline_stages(spark, tables, tmp_path):
    docs, labels = tables
    passage = " ".join(f"bench{i}" for i in range(20))
    clean = "the oner retire stonin tion " * 12
    extra = [(1000, clean + "alpha one two three", "en", "s", 1), (1001, clean + "alpha one two three", "en", "s", 1), (1002, "on the stre " + passage + " retion er", "en", "s", 1),
             (1003, clean + " beta token = abcdefghijklmnop99 " + clean, "en", "s", 1)]
    table = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    d = str(tmp_path)
    table.write.parquet(f"{d}/documents.parquet")
    labels.write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    cur = spark.read.parquet(f"{d}/documents.parquet").withColumn("key", F.lit("clash"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        cur = stage(spark, cur, d)
        assert cur.columns == [*docs.columns, "key"]
        rows = cur.collect()
        cur = spark.createDataFrame(rows, cur.schema)
        seen[name] = {r.doc_id: r for r in rows}
    junk = {r.doc_id for r in labels.collect() if r.quality == 0}
    assert len(junk & set(seen["quality classifier"])) <= 0.1 * len(junk)
    near = seen["MinHash near-dedup"]
    assert (1000 in near) != (1001 in near) or not {1000, 1001} & set(seen["quality classifier"])
    assert 1002 not in seen["benchmark decontamination"]
    if 1003 in seen["secret scans"]:
        r = seen["secret scans"][1003]
        assert "abcdefghijklmnop99" not in r.text and corpus_pipeline.REDACTED in r.text and r.n_chars == len(r.text)
    assert corpus_pipeline.token_stage(spark, cur, d).count() == cur.count()


def test_near_duplicates_go_by_row_not_by_id(spark, docs_of):
    rng = random.Random(3)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(5))
    rows = [(7, a), (3, a), (7, b), (8, c), (8, d), (9, e), (9, e), (5, a + " end"), (None, a), (None, a), (10, None), (10, "")]
    got = corpus_pipeline.near_duplicate_stage(spark, docs_of(rows), "")
    assert got.columns == docs_of(rows).columns
    assert sorted(((r.doc_id or -1, r.text or "") for r in got.collect())) == sorted([(3, a), (7, b), (8, c), (8, d), (9, e), (-1, a), (-1, a), (10, "")])


def test_pipeline_on_empty_documents(spark, tables, tmp_path):
    docs, labels = tables
    d = str(tmp_path)
    docs.filter("false").write.parquet(f"{d}/documents.parquet")
    labels.write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0
