"""Quality classifier on supervised subword embeddings.

Features of a text are its white-space separated words and the character
n-grams (``NGRAMS`` code units of UTF-8 bytes) of each word between word marks;
a word that repeats the one before it also gives a repetition mark. Features
are hashed to ``BUCKETS`` rows of a learned embedding table, averaged per
document, and a softmax layer turns the average into class probabilities.
Table and layer are learned together by stochastic gradient descent in numpy
(per-parameter step sizes) on a bounded sample of labelled documents
(``PER_CLASS`` of each label, whole texts).

Scale: training reads the bounded sample only. Scoring is narrow: as the
output layer is linear, a bucket is one number, a distinct word one sum, and a
text the mean over its words; the broadcast model has ``BUCKETS`` numbers.

Edge cases: null and empty texts get the score of a text without features
(the bias alone); without labelled rows of both classes every score is the
share of label 1 among the usable labels, or 0.5 without any; repeated rows
and null ids give one row each; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from examlytics.llm.text import NON_SPACE, Words, buffer_of, mix, range_hash, slices
from examlytics.llm.training import labelled_sample

BUCKETS = 1 << 17
DIM = 16
NGRAMS = (2, 3, 4)
PER_CLASS = 2500
EPOCHS = 6
BATCH = 32
STEP = 0.3


def distinct_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word of each distinct hash, and the number of the distinct word of each word."""
    _, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
    return first, number


def word_features(words: Words, pick: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of the picked words, and the first feature of each."""
    begin, size = words.starts[pick], words.ends[pick] - words.starts[pick]
    # Each word between two marks, in one buffer.
    edge = np.concatenate([[0], np.cumsum(size + 2)])
    marked = np.full(edge[-1], 1, np.uint8)
    place = np.arange(edge[-1]) - np.repeat(edge[:-1], size + 2)
    inner = (place > 0) & (place <= np.repeat(size, size + 2))
    marked[inner] = words.buf[(np.repeat(begin, size + 2) + place - 1)[inner]]
    parts = [(range_hash(marked, edge[:-1], edge[1:], 0x2545F4914F6CDD1D), np.arange(len(pick)))]
    for n in NGRAMS:
        many = np.maximum(size + 2 - n + 1, 0)
        of = np.repeat(np.arange(len(pick)), many)
        at = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many) + edge[:-1][of]
        parts.append((range_hash(marked, at, at + n, 0x2545F4914F6CDD1D), of))
    h, of = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(of, kind="stable")
    # Bucket 0 is the repetition mark.
    return (mix(h[order]) % np.uint64(buckets - 1)).astype(np.int64) + 1, np.searchsorted(of[order], np.arange(len(pick) + 1))


def repeats(words: Words) -> np.ndarray:
    """Which words equal the word before them in the same text."""
    h, owner = words.hashes(), words.owner()
    out = np.zeros(len(words), bool)
    out[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    return out


def document_features(texts: pa.Array, buckets: int = BUCKETS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct buckets and their shares of all features."""
    words = Words(*buffer_of(texts), NON_SPACE)
    if not len(words):
        return [(np.zeros(0, np.int64), np.zeros(0))] * len(texts)
    first, number = distinct_words(words)
    feature, cut = word_features(words, first, buckets)
    again = repeats(words)
    out = []
    for s, e in zip(words.first[:-1], words.first[1:], strict=True):
        kinds, times = np.unique(number[s:e], return_counts=True)
        many = cut[kinds + 1] - cut[kinds]
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(cut[kinds], many)
        bucket, place = np.unique(feature[at], return_inverse=True)
        count = np.bincount(place, np.repeat(times, many), minlength=len(bucket))
        same = int(again[s:e].sum())
        if same:
            bucket, count = np.append(bucket, 0), np.append(count, 20.0 * same)
        out.append((bucket, count / max(1.0, count.sum())))
    return out


@dataclass
class QualityModel:
    """One number per bucket (its embedding times the difference of the softmax rows) and the bias."""

    weight: np.ndarray
    bias: float
    buckets: int

    def score(self, texts: pa.Array) -> np.ndarray:
        words = Words(*buffer_of(texts), NON_SPACE)
        total, n = np.zeros(len(texts)), np.zeros(len(texts))
        if len(words):
            first, number = distinct_words(words)
            feature, cut = word_features(words, first, self.buckets)
            value, many = np.add.reduceat(self.weight[feature], cut[:-1]), np.diff(cut)
            some = np.flatnonzero(words.counts())
            at = words.first[:-1][some]
            same = repeats(words) * 20.0
            total[some] = np.add.reduceat(value[number] + same * self.weight[0], at)
            n[some] = np.add.reduceat(many[number] + same, at)
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + self.bias, -30, 30)))


def train(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS, seed: int = 7) -> QualityModel:
    """Learn embeddings and softmax by stochastic gradient descent."""
    if len(set(labels.tolist())) < 2:
        share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
        return QualityModel(np.zeros(buckets), float(np.log(share / (1 - share))), buckets)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    out = rng.normal(0, 0.1, (dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen, seen_out, seen_bias = np.full(buckets, 1e-8, np.float32), np.full((dim, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    for epoch in range(epochs):
        step = STEP * (1 - epoch / epochs)
        order = rng.permutation(len(labels))
        for s in range(0, len(order), BATCH):
            pick = order[s:s + BATCH]
            rows = [features[i] for i in pick]
            size = np.array([len(b) for b, _ in rows])
            bucket, share = np.concatenate([b for b, _ in rows]), np.concatenate([c for _, c in rows]).astype(np.float32)
            of = np.repeat(np.arange(len(rows)), size)
            mean = np.zeros((len(rows), dim), np.float32)
            full = np.flatnonzero(size)
            if len(full):
                mean[full] = np.add.reduceat(table[bucket] * share[:, None], (np.cumsum(size) - size)[full], axis=0)
            z = mean @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), labels[pick]] -= 1
            g_out, g_bias, g_mean = mean.T @ p / len(rows), p.mean(0), p @ out.T / len(rows)
            kinds, place = np.unique(bucket, return_inverse=True)
            g = np.zeros((len(kinds), dim), np.float32)
            np.add.at(g, place, share[:, None] * g_mean[of])
            seen[kinds] += np.square(g).mean(1)
            table[kinds] -= step * g / np.sqrt(seen[kinds])[:, None]
            seen_out += g_out**2
            out -= step * g_out / np.sqrt(seen_out)
            seen_bias += g_bias**2
            bias -= 0.3 * step * g_bias / np.sqrt(seen_bias)
    return QualityModel((table @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0]), buckets)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", per_class: int = PER_CLASS) -> QualityModel:
    """Train on labelled documents whose id satisfies ``usable``; features are made by Spark, bounded by the sample."""
    sample = labelled_sample(docs, labels, label, usable, per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows = document_features(b.column("text"))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("label"), pa.array([x.astype(np.int32).tobytes() for x, _ in rows], pa.binary()),
                pa.array([c.astype(np.float32).tobytes() for _, c in rows], pa.binary())], ["doc_id", "label", "buckets", "shares"])

    made = sample.select("doc_id", "label", "text").mapInArrow(run, "doc_id bigint, label int, buckets binary, shares binary")
    rows = sorted(made.toLocalIterator(), key=lambda r: r.doc_id)
    features = [(np.frombuffer(bytes(r.buckets), np.int32), np.frombuffer(bytes(r.shares), np.float32)) for r in rows]
    return train(features, np.array([r.label for r in rows], np.int64))


def with_score(docs: DataFrame, model: QualityModel, name: str = "score", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the score of every whole text in the new column ``name``."""
    if name in docs.columns:
        raise ValueError(f"the documents have a column {name} already")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.score(b.column(text)))], [*b.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score of every whole text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_score(rows, model).select("doc_id", "score")
