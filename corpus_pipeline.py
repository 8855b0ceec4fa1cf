"""From raw documents to token ids: the operators of examlytics.llm as one pipeline.

Stages, each on all that the one before kept: quality classifier (rejected
documents go), near-duplicate removal (one document of each group stays),
benchmark decontamination (contaminated documents go), secret scan (secrets are
cut out of the text, the document stays), byte-level BPE (ids of each text).
Every stage's result is written as Parquet to the shared folder and read again.

Edge cases: an empty table gives an empty result; a null text counts as empty;
a null doc_id is kept as its own document; rows that share a doc_id with
different texts are documents of their own, of rows that repeat id and text one
stays after the second stage (ids and texts are compared by a 64-bit hash);
further columns of documents are passed on.
"""

from __future__ import annotations

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from examlytics.llm import byte_bpe, decontaminate, minhash, quality, secret_scan
from examlytics.llm.marks import bitmap, marked
from examlytics.llm.store import keep, text_batches
from examlytics.llm.training import crc_remainder

KEEP_QUALITY = 0.7
REDACTED = "<SECRET>"
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DROP_BITS = 1 << 25

#: No SQL: the classifier is a trained model.
ORACLE_SQL = None


def row_key() -> Column:
    """Tells rows apart by id and text, also where the id is null."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def without(docs: DataFrame, gone: DataFrame, key: Column) -> DataFrame:
    """Rows whose key is not in ``gone`` (key).

    Only rows that a bitmap of fixed size marks are joined; all others pass
    without a shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(gone, DROP_BITS))
    named = docs.select(F.struct("*").alias("row"), key.alias("key"))

    @F.pandas_udf("boolean")
    def hit(key: pd.Series) -> pd.Series:
        return pd.Series(marked(shared.value, key.to_numpy().view("u8")))

    split = named.withColumn("hit", hit("key"))
    passed = split.filter("not hit").select("row.*")
    checked = split.filter("hit").join(gone.select("key").distinct(), "key", "left_anti").select("row.*")
    return passed.unionByName(checked)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, ~F.coalesce(crc_remainder(F.col("doc_id"), 4) == 2, F.lit(False)))
    name = "_quality" + "_" * max(map(len, docs.columns))  # longer than any column there is
    return quality.with_score(docs, model, name).filter(F.col(name) >= KEEP_QUALITY).drop(name)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: the smallest doc_id, among its texts the one of the smallest key."""
    own = F.when(F.col("doc_id").isNotNull(), row_key())  # a row without an id is never linked
    classes = keep(minhash.near_duplicates(docs.select(own.alias("doc_id"), "text")), "classes").withColumnRenamed("doc_id", "key")
    others = classes.filter("key <> class_id").select("key", "class_id")
    members = keep(others.unionByName(others.select(F.col("class_id").alias("key"), "class_id")).distinct(), "members")
    ids = docs.select(own.alias("key"), F.col("doc_id").cast("bigint").alias("id"))
    first = members.join(ids, "key").groupBy("class_id").agg(F.min(F.struct("id", "key")).alias("least")).select("least.key")
    gone = keep(members.join(first, "key", "left_anti").select("key"), "near-copies")
    kept = without(docs, gone, row_key())
    again = keep(classes.filter("key is not null").groupBy("key").count().filter("count > 1").select("key"), "repeated-rows")
    if again.isEmpty():
        return kept
    # One row of each repeated id and text.
    rows = kept.select(own.alias("key"), F.struct(*kept.columns).alias("row"))
    first = rows.join(again, "key", "left_semi").groupBy("key").agg(F.min("row").alias("row")).select("row.*")
    return rows.join(again, "key", "left_anti").select("row.*").unionByName(first)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.select(row_key().alias("doc_id"), F.col("text"))
    hits = decontaminate.contamination(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = keep(hits.filter("contaminated").select(F.col("doc_id").alias("key")), "contaminated")
    return without(docs, gone, row_key())


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs, REDACTED)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers), their number and the digests of ids and decoded bytes."""
    return byte_bpe.round_trip(docs, BYTE_RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("byte-level BPE", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
