"""Registered queries of the operators, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from examlytics.llm import alignment, byte_bpe, decontaminate, induced, minhash, neighbours, periodic, pii, quality, secret_scan, substring, token_count, toxicity
from examlytics.llm.store import text_batches
from examlytics.llm.training import crc_remainder

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 4096
KEEP_QUALITY = 0.7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256(col):
    return F.sha2(F.encode(col, "UTF-8"), 256)


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.personal_data(_table(spark, sf_dir, "documents"))
    counts = [pii.count_of("base", i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return out.select("doc_id", *counts, sha256(pii.joined("base")).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _table(spark, sf_dir, "documents"), F.coalesce(crc_remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = quality.fit(docs, _table(spark, sf_dir, "labels"), ~held_out)
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= KEEP_QUALITY).cast("int").alias("predicted"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = byte_bpe.round_trip(_table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return out.drop("ids")


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = _table(spark, sf_dir, "documents"), F.coalesce(crc_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "toxic")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_count.count_tokens(_table(spark, sf_dir, "documents"), PIECE_MODEL)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", sha256("kept").alias("kept_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", sha256(F.array_join(F.array_sort("items"), ",")).alias("items_sha256"), "contaminated", F.size("near").cast("bigint").alias("n_near"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.secrets(_table(spark, sf_dir, "documents"))
    counts = [pii.count_of("base", i).alias(f"n_{k}") for i, k in enumerate(secret_scan.KINDS)]
    names = (*secret_scan.KINDS, secret_scan.ADDED)
    return out.select("doc_id", *counts, sha256(pii.joined("base", names)).alias("base_sha256"), pii.joined("spans", names).alias("spans"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alignment.align(_table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_MODEL)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def planted_repeats(doc_id: int | None, x: np.ndarray) -> np.ndarray:
    """The contract's words: in one document of ten a tail repeats its first words."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not len(x):
        return x
    g = h // 10
    a = g % len(x)
    p = 1 + (len(x) - a) // (3 + g % 8)
    at = np.arange(len(x))
    return x[np.where(at < a, at, a + (at - a) % p)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic.collapsed(_table(spark, sf_dir, "documents"), planted_repeats)
    # The exact ratio, by cross products.
    best = F.expr("""get(array_sort(runs, (l, r) -> CASE
        WHEN l.length * r.period <> r.length * l.period THEN IF(l.length * r.period > r.length * l.period, -1, 1)
        WHEN l.start <> r.start THEN IF(l.start < r.start, -1, 1)
        ELSE CAST(sign(l.period - r.period) AS INT) END), 0)""")
    listed = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return out.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 DIV best.period").alias("exponent_milli"), sha256(listed).alias("runs_sha256"), sha256("collapsed").alias("collapsed_sha256"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = induced.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_personal_data": op1_personal_data,
    "op2_quality": op2_quality,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_minhash": op5_minhash,
    "op6_toxicity": op6_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_secret_scan": op10_secret_scan,
    "op11_alignment": op11_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_suffix_dedup": op13_suffix_dedup,
}

ORACLE = {
    "op4_nearest_neighbours": r"""
WITH v AS (SELECT vec_id, min(embedding::DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0 GROUP BY vec_id),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank, vec_id, score FROM p)
SELECT * FROM r WHERE rank <= 10
""",
    "op8_substring_dedup": r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM t WHERE len(w) >= 50),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM pos),
low AS (SELECT h, min(doc_id) AS d FROM win GROUP BY h),
hit AS (SELECT DISTINCT win.doc_id, win.i + o.k AS p FROM win JOIN low USING (h), (SELECT unnest(range(50)) AS k) o WHERE low.d < win.doc_id),
gone AS (SELECT doc_id, list(p) AS ps FROM hit GROUP BY doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN w ELSE [w[k] FOR k IN range(1, len(w) + 1) IF NOT list_contains(ps, k)] END, ' '), '')) AS kept_sha256
FROM t LEFT JOIN gone USING (doc_id)
""",
    "op9_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
pos AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k),
occ AS (SELECT pos.doc_id, pos.i, pos.k, bw.item_id FROM pos JOIN bw ON bw.k = pos.k AND bw.s = array_to_string(pos.w[pos.i:pos.i + pos.k - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM occ) GROUP BY doc_id),
place AS (SELECT doc_id, w, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d),
often AS (SELECT t, count(*) AS n FROM place GROUP BY t),
win AS (SELECT item_id, w[i:i + k - 1] AS ws, k FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
rare AS (SELECT item_id, ws, k, arg_min(t, n) AS t FROM (SELECT *, unnest(ws) AS t FROM win) JOIN often USING (t) GROUP BY ALL HAVING count(*) = k),
around AS (SELECT doc_id, item_id, ws, w[unnest(range(greatest(1, p - k - 1), p + 1)):p + k + 1][:k + 2] AS x FROM rare JOIN place USING (t)),
nr AS (SELECT doc_id, count(DISTINCT item_id) AS n FROM around
  WHERE list_has_all(x, ws) AND len([y FOR y IN ws IF len([z FOR z IN x IF z = y]) < len([z FOR z IN ws IF z = y])]) = 0 GROUP BY doc_id)
SELECT d.doc_id, coalesce(nr.n, 0) AS n_near, len(d.w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
       sha256(coalesce(it.s, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id) LEFT JOIN nr USING (doc_id)
""",
}
