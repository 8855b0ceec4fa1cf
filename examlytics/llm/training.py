"""Labelled training rows for the classifiers, and training over all of them.

:func:`averaged_rounds` trains by local gradient descent: the rows are dealt to
shards by a hash of the id, in every round each shard continues from the same
model, and the changes of the shards are averaged row by row of the parameters
(over the shards that changed the row). A task holds one shard and sums of the
size of the model; what it passes on is bounded by the model, not by the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from examlytics.llm.marks import bitmap, marked

ID_BITS = 1 << 25
BLOCK = 1 << 13
CHANGES = "name string, block int, first bigint, at binary, shards binary, change binary"


def usable_labels(labels: DataFrame, label: str, usable: Column) -> DataFrame:
    """(doc_id, label) of all ids that ``usable`` allows; an id with two labels takes the smaller one."""
    return (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & usable)
            .groupBy("doc_id").agg(F.min("label").alias("label")))


def labelled_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, label, lang, text) of every document in ``chosen`` (doc_id, label), whole texts.

    An id with several rows takes the smallest text and the smallest language.
    Only rows that a bitmap of fixed size marks are shuffled.
    """
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), lang.alias("lang"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(chosen.select(F.xxhash64("doc_id").alias("key")), ID_BITS))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = marked(shared.value, b.column("key").to_numpy(zero_copy_only=False).view(np.uint64))
            yield b.drop_columns(["key"]).filter(pa.array(own))

    likely = texts.filter("doc_id is not null").withColumn("key", F.xxhash64("doc_id")).mapInArrow(near, texts.schema)
    return likely.join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("lang").alias("lang"), F.min("text").alias("text"))


def in_shards(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` with a column ``shard``, the rows of a shard together in a partition of their own, in a fixed order."""
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).cast("int"))
    return dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.xxhash64("doc_id"), "doc_id")


def _summed(batches: Iterator[pa.RecordBatch], shapes: dict[str, tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """One row per block of a parameter: in how many shards each row changed, and the sum of the changes (blocks arrive sorted)."""
    key, total, shards = None, None, None

    def done() -> pa.RecordBatch:
        at = np.flatnonzero(shards).astype(np.int32)
        return _change_rows([(*key, 0, at, shards[at], total[at])])

    for b in batches:
        for r in b.to_pylist():
            if (r["name"], r["block"]) != key:
                if key is not None:
                    yield done()
                key = (r["name"], r["block"])
                total, shards = np.zeros((BLOCK, shapes[key[0]][1]), np.float32), np.zeros(BLOCK, np.int32)
            at = np.frombuffer(r["at"], np.int32)
            shards[at] += np.frombuffer(r["shards"], np.int32)
            total[at] += np.frombuffer(r["change"], np.float32).reshape(len(at), -1)
    if key is not None:
        yield done()


def _change_rows(rows: list[tuple]) -> pa.RecordBatch:
    names, blocks, firsts, at, shards, change = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(blocks, pa.int32()), pa.array(firsts, pa.int64()),
         *(pa.array([x.tobytes() for x in part], pa.binary()) for part in (at, shards, change))],
        ["name", "block", "first", "at", "shards", "change"])


def averaged_rounds(rows: DataFrame, state: dict[str, np.ndarray], rounds: int,
                    learn: Callable[[dict[str, np.ndarray], list[dict], int, int], None]) -> dict[str, np.ndarray]:
    """The parameters (float32 matrices by name) after ``rounds`` passes over all ``rows`` (kept :func:`in_shards`).

    ``learn(state, rows, round, shard)`` changes the parameters in place.
    """
    shapes = {name: x.shape for name, x in state.items()}
    for turn in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast(state)

        def run(batches: Iterator[pa.RecordBatch], turn: int = turn, shared=shared) -> Iterator[pa.RecordBatch]:
            start, first, held = shared.value, None, []
            total = {name: np.zeros_like(x) for name, x in start.items()}
            shards = {name: np.zeros(len(x), np.int32) for name, x in start.items()}

            def close() -> None:
                own = {name: x.copy() for name, x in start.items()}
                learn(own, held, turn, held[0]["shard"])
                for name, x in own.items():
                    at = np.flatnonzero((x != start[name]).any(1))
                    total[name][at] += x[at] - start[name][at]
                    shards[name][at] += 1

            for b in batches:
                for r in b.to_pylist():
                    if held and r["shard"] != held[0]["shard"]:
                        close()
                        held = []
                    first = r["shard"] if first is None else first
                    held.append(r)
            if held:
                close()
            for name, n in shards.items():
                for block in range(-(-len(n) // BLOCK)):
                    at = np.flatnonzero(n[block * BLOCK:(block + 1) * BLOCK])
                    if len(at):
                        yield _change_rows([(name, block, first, at.astype(np.int32), n[at + block * BLOCK], total[name][at + block * BLOCK])])

        sums = (rows.mapInArrow(run, CHANGES).repartition("name", "block").sortWithinPartitions("name", "block", "first")
                .mapInArrow(lambda batches: _summed(batches, shapes), CHANGES))
        state = {name: x.copy() for name, x in state.items()}
        for r in sums.collect():  # at most the size of the model, in one job
            at = np.frombuffer(bytes(r.at), np.int32)
            mean = np.frombuffer(bytes(r.change), np.float32).reshape(len(at), -1) / np.frombuffer(bytes(r.shards), np.int32)[:, None]
            state[r.name][at + r.block * BLOCK] += mean.astype(np.float32)
        shared.unpersist()
    return state


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int) -> DataFrame:
    """(doc_id, text, label): at most ``per_class`` documents of each label, whole texts.

    The rows are those of the smallest hash of the id among the labels that
    ``usable`` (a condition on doc_id) allows, so the sample is the same in
    every run and its size has a fixed bound (``2 * per_class`` rows). An id
    with two labels takes the smaller one, an id with several rows the
    smallest text.
    """
    chosen = usable_labels(labels, label, usable)
    parts = [chosen.filter(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)]
    picked = parts[0].unionByName(parts[1])  # a bounded number of rows
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % modulus
