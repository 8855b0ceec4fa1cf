"""Toxicity by a convolutional text classifier.

A text is its words (lower-case letters and digits). A word is embedded as the
sum of learned vectors from independently hashed tables: one for the whole
word and one per stem length in ``STEMS`` (its first bytes), so inflected forms
share a part and a hash collision in one table is outvoted. Filters of the widths
``WIDTHS`` slide over the word vectors, each filter keeps its maximum over the
text, and a dense layer with a sigmoid gives the score. Everything is trained
in numpy on the whole texts of all usable labelled documents (four in five of
them). After training, a decision threshold is calibrated for every language
on all the others; a language without enough of them takes the overall
threshold. The score never sees the language; only the calibrated decision does.

Scale: training is local gradient descent on shards of about ``SHARD`` rows,
one task each, whose changes are averaged after every pass
(:func:`examlytics.llm.training.averaged_rounds`); calibration counts labels by
language and score to four places. Scoring is narrow, in slices of bounded
size, with a broadcast model of fixed size (a table of ``BUCKETS`` x ``DIM``
numbers for words and each stem length).

Edge cases: a null or empty text, or one without words, scores as if no filter
fired; texts shorter than a filter are padded with zero vectors; without
labelled rows of both classes all scores are the share of label 1 (0 without
any); repeated rows and null ids give one row each; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from examlytics.llm.store import discard, keep
from examlytics.llm.text import ASCII_LOWER, LOWER_ALNUM, Words, buffer_of, mix, range_hash, slices
from examlytics.llm.training import averaged_rounds, in_shards, labelled_rows, labelled_sample, usable_labels

BUCKETS = 1 << 16
DIM = 8
STEMS = (4, 5)
WIDTHS = (1, 2, 3)
FILTERS = 8
SHARD = 3000
EPOCHS = 8
BATCH = 32
STEP = 0.1
LEAST_PER_LANGUAGE = 20
SCORE_PLACES = 10_000


def word_rows(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Table rows (words x tables) of all words, and the first word of each text."""
    buf, off = buffer_of(texts)
    words = Words(ASCII_LOWER[buf], off, LOWER_ALNUM)
    hashes = [words.hashes()]
    for n in STEMS:
        hashes.append(mix(range_hash(words.buf, words.starts, np.minimum(words.ends, words.starts + n), 0xA0761D6478BD642F) + np.uint64(n)))
    return (np.stack(hashes, 1) % np.uint64(buckets)).astype(np.int32), words.first


@dataclass
class ToxicityModel:
    tables: np.ndarray  # tables x buckets x dim
    filters: list[np.ndarray]  # per width: (width * dim) x filters
    offsets: list[np.ndarray]  # per width: filters
    dense: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def embed(self, rows: np.ndarray) -> np.ndarray:
        out = self.tables[0][rows[:, 0]]
        for t in range(1, len(self.tables)):
            out += self.tables[t][rows[:, t]]
        return out

    def pooled(self, rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Maximum of every filter per text (before the rectifier), and the word where it is reached."""
        texts, vectors, out, where = len(first) - 1, self.embed(rows), [], []
        size = np.diff(first)
        some = np.flatnonzero(size)
        owner_end = np.repeat(first[1:], size)
        for width, weights, offset in zip(WIDTHS, self.filters, self.offsets, strict=True):
            value = np.tile(offset, (len(rows), 1)).astype(np.float32)
            for k in range(width):
                part = vectors[k:] @ weights[k * DIM:(k + 1) * DIM]
                at = np.arange(len(part))
                inside = at + k < owner_end[: len(part)]  # beyond the end of the text stand zero vectors
                value[: len(part)] += np.where(inside[:, None], part, 0)
            top, place = np.full((texts, FILTERS), -np.inf, np.float32), np.zeros((texts, FILTERS), np.int64)
            if len(some):
                top[some] = np.maximum.reduceat(value, first[:-1][some], axis=0)
                hit = value == np.repeat(top, size, axis=0)
                for f in range(FILTERS):
                    at = np.flatnonzero(hit[:, f])
                    place[some, f] = at[np.searchsorted(at, first[:-1][some])]
            out.append(top)
            where.append(place)
        return np.concatenate(out, 1), where

    def score(self, texts: pa.Array) -> np.ndarray:
        return self.score_rows(*word_rows(texts, self.tables.shape[1]))

    def score_rows(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        active = np.maximum(self.pooled_values(rows, first), 0)
        return 1 / (1 + np.exp(-np.clip(active @ self.dense + self.bias, -30, 30)))

    def pooled_values(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """As ``pooled``, without places: one matrix product for all widths."""
        texts, size = len(first) - 1, np.diff(first)
        some = np.flatnonzero(size)
        top = np.full((texts, FILTERS * len(WIDTHS)), -np.inf, np.float32)
        if not len(some):
            return top
        every = np.concatenate([w[k * DIM:(k + 1) * DIM] for w, n in zip(self.filters, WIDTHS, strict=True) for k in range(n)], 1)
        parts, at, col = self.embed(rows) @ every, first[:-1][some], 0
        left = np.repeat(first[1:], size) - np.arange(len(rows))
        for i, width in enumerate(WIDTHS):
            value = parts[:, col * FILTERS:(col + 1) * FILTERS].copy()
            for k in range(1, width):
                further = parts[k:, (col + k) * FILTERS:(col + k + 1) * FILTERS]
                value[: len(further)] += np.where((left[: len(further)] > k)[:, None], further, 0)
            col += width
            top[some, i * FILTERS:(i + 1) * FILTERS] = np.maximum.reduceat(value, at, axis=0) + self.offsets[i]
        return top


def new_state(buckets: int = BUCKETS, seed: int = 11) -> dict[str, np.ndarray]:
    """Parameters before training, by name, and the sums of squares (``seen_``) that set their steps."""
    rng = np.random.default_rng(seed)
    tables = rng.normal(0, 0.02, (1 + len(STEMS), buckets, DIM)).astype(np.float32)
    state = {f"table{t}": x for t, x in enumerate(tables)}
    state |= {f"filter{i}": rng.normal(0, 0.5, (w * DIM, FILTERS)).astype(np.float32) for i, w in enumerate(WIDTHS)}
    state |= {f"offset{i}": np.zeros((1, FILTERS), np.float32) for i in range(len(WIDTHS))}
    state |= {"dense": rng.normal(0, 0.3, (FILTERS * len(WIDTHS), 1)).astype(np.float32), "bias": np.zeros((1, 1), np.float32)}
    return state | {f"seen_{k}": np.full((len(x), 1) if k.startswith("table") else x.shape, 1e-6, np.float32) for k, x in state.items()}


def model_of(state: dict[str, np.ndarray]) -> ToxicityModel:
    """The model over the parameters (filters, offsets and dense layer are shared with ``state``)."""
    each = range(len(WIDTHS))
    return ToxicityModel(np.stack([state[f"table{t}"] for t in range(1 + len(STEMS))]), [state[f"filter{i}"] for i in each],
                         [state[f"offset{i}"][0] for i in each], state["dense"][:, 0], float(state["bias"][0, 0]))


def constant_model(share: float, buckets: int = BUCKETS) -> ToxicityModel:
    """Scores everything with the share of label 1."""
    model = model_of(new_state(buckets))
    model.dense[:], model.bias = 0, float(np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3))))
    return model


def learn(state: dict[str, np.ndarray], docs: list[dict], epoch: int, shard: int, epochs: int = EPOCHS, seed: int = 11) -> None:
    """One pass of stochastic gradient descent with per-parameter steps over ``docs`` (word rows and label); changes ``state``."""
    rows = [np.frombuffer(r["rows"], np.uint16).reshape(-1, 1 + len(STEMS)).astype(np.int32) for r in docs]
    labels = np.array([r["label"] for r in docs], np.float32)
    model, step = model_of(state), STEP * (1 - epoch / epochs)
    order = np.random.default_rng([seed, epoch, shard]).permutation(len(labels))

    def move(name: str, g: np.ndarray) -> None:
        state[f"seen_{name}"] += g**2
        state[name] -= step * g / np.sqrt(state[f"seen_{name}"])

    for s in range(0, len(order), BATCH):
        pick = order[s:s + BATCH]
        size = np.array([len(rows[i]) for i in pick])
        first = np.concatenate([[0], np.cumsum(size)])
        words = np.concatenate([rows[i] for i in pick]) if first[-1] else np.zeros((0, len(model.tables)), np.int32)
        top, where = model.pooled(words, first)
        active = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-np.clip(active @ model.dense + model.bias, -30, 30)))
        error = ((p - labels[pick]) / len(pick)).astype(np.float32)
        g_dense, g_bias = active.T @ error, float(error.sum())
        back = np.where(top > 0, error[:, None] * model.dense[None, :], 0).astype(np.float32)
        touched, pushes = [], []
        for i, width in enumerate(WIDTHS):
            g = back[:, i * FILTERS:(i + 1) * FILTERS]
            doc, f = np.nonzero(g)
            value, at = g[doc, f], where[i][doc, f]
            g_filter = np.zeros_like(model.filters[i])
            for k in range(width):
                inside = at + k < first[doc + 1]
                word, amount, which = words[at[inside] + k], value[inside], f[inside]
                vector = model.embed(word)
                np.add.at(g_filter.T, (which, slice(k * DIM, (k + 1) * DIM)), vector * amount[:, None])
                touched.append(word)
                pushes.append(model.filters[i][k * DIM:(k + 1) * DIM].T[which] * amount[:, None])
            move(f"filter{i}", g_filter)
            move(f"offset{i}", g.sum(0)[None, :])
        move("dense", g_dense[:, None])
        move("bias", np.array([[g_bias]], np.float32))
        model.bias = float(state["bias"][0, 0])
        word, push = np.concatenate(touched), np.concatenate(pushes)
        for t in range(len(model.tables)):
            kinds, place = np.unique(word[:, t], return_inverse=True)
            g = np.zeros((len(kinds), DIM), np.float32)
            np.add.at(g, place, push)
            seen = state[f"seen_table{t}"]
            seen[kinds] += np.square(g).mean(1)[:, None]
            model.tables[t][kinds] -= step * g / np.sqrt(seen[kinds])
    for t in range(len(model.tables)):
        state[f"table{t}"][:] = model.tables[t]


def best_cut(low: np.ndarray, high: np.ndarray, n: np.ndarray, true: np.ndarray) -> float:
    """The cut with the best F1 between groups of scores (range, rows and rows of label 1 of each), halfway to the next score."""
    order = np.argsort(-low, kind="stable")
    low, high, n, true = low[order], high[order], n[order], true[order]
    f1 = 2 * np.cumsum(true) / (np.cumsum(n) + true.sum())
    i = int(np.argmax(f1))
    return float((low[i] + (high[i + 1] if i + 1 < len(low) else 0.0)) / 2)


def thresholds(langs: list[str], low: np.ndarray, high: np.ndarray, n: np.ndarray, true: np.ndarray) -> tuple[float, dict[str, float]]:
    """Overall threshold and one per language, from groups of scores of each language."""
    enough = lambda own: LEAST_PER_LANGUAGE <= n[own].sum() and 0 < true[own].sum() < n[own].sum()
    names, every = np.array(langs), np.ones(len(n), bool)
    overall = 0.5
    if enough(every):
        place, group = np.unique(np.floor(low * SCORE_PLACES), return_inverse=True)
        lows, highs = np.full(len(place), np.inf), np.full(len(place), -np.inf)
        np.minimum.at(lows, group, low)
        np.maximum.at(highs, group, high)
        overall = best_cut(lows, highs, np.bincount(group, n), np.bincount(group, true))
    each = {}
    for lang in sorted(set(names.tolist())):
        own = names == lang
        if enough(own):
            each[lang] = best_cut(low[own], high[own], n[own], true[own])
    return overall, each


def calibrate(scores: np.ndarray, labels: np.ndarray, langs: list[str | None]) -> tuple[float, dict[str, float]]:
    """Overall threshold and one per language of some scored rows."""
    groups: dict[tuple[str, float], list[float]] = {}
    for s, y, lang in zip(scores.tolist(), labels.tolist(), langs, strict=True):
        group = groups.setdefault((lang or "", float(np.floor(s * SCORE_PLACES))), [s, s, 0, 0])
        group[:] = min(group[0], s), max(group[1], s), group[2] + 1, group[3] + y
    return thresholds([lang for lang, _ in groups], *np.array(list(groups.values()), np.float64).reshape(-1, 4).T)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", per_class: int | None = None, shard: int = SHARD) -> ToxicityModel:
    """Train on one part of the usable labelled documents and calibrate thresholds on another (by a hash of the id).

    All of them take part, unless the caller asks for ``per_class`` rows of each label.
    """
    part = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(5))
    chosen = usable_labels(labels, label, usable)
    if per_class is not None:
        chosen = keep(labelled_sample(docs, labels, label, usable, per_class).select("doc_id", "label"), "chosen-labels")
    rows = labelled_rows(docs, chosen).withColumn("learns", part != 0)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            found, first = word_rows(b.column("text"))
            yield pa.RecordBatch.from_arrays([
                *(b.column(c) for c in ("doc_id", "label", "lang", "learns")),
                pa.array([found[s:e].astype(np.uint16).tobytes() for s, e in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                ["doc_id", "label", "lang", "learns", "rows"])

    made = rows.select("doc_id", "label", "lang", "learns", "text").mapInArrow(read, "doc_id bigint, label int, lang string, learns boolean, rows binary")
    known = chosen.count()
    kept = keep(in_shards(made, max(1, -(-known // shard))), "word-rows")
    counts = {r.label: r.n for r in kept.filter("learns").groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        model = constant_model(counts.get(1, 0) / max(1, sum(counts.values())))
    else:
        model = model_of(averaged_rounds(kept.filter("learns").select("shard", "label", "rows"), new_state(), EPOCHS, learn))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "rows"):
            found = [np.frombuffer(r, np.uint16).reshape(-1, 1 + len(STEMS)).astype(np.int32) for r in b.column("rows").to_pylist()]
            first = np.concatenate([[0], np.cumsum([len(r) for r in found])])
            scores = shared.value.score_rows(np.concatenate(found), first)
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("label"), pa.array(scores.astype(np.float64))], ["lang", "label", "score"])

    scored = kept.filter("not learns").select("lang", "label", "rows").mapInArrow(check, "lang string, label int, score double")
    groups = scored.groupBy(F.coalesce("lang", F.lit("")).alias("lang"), F.floor(F.col("score") * SCORE_PLACES).alias("place")).agg(
        F.min("score").alias("low"), F.max("score").alias("high"), F.count("*").alias("n"), F.sum("label").alias("true")).collect()  # bounded per language
    columns = np.array([(r.low, r.high, r.n, r.true) for r in groups], np.float64).reshape(-1, 4).T
    model.threshold, model.thresholds = thresholds([r.lang for r in groups], *columns)
    discard(kept)
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score of every whole text, and toxic: the decision by the threshold of its language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, "text"):
            s = m.score(b.column("text"))
            limit = np.array([m.thresholds.get(x or "", m.threshold) for x in b.column("lang").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s.astype(np.float64)), pa.array(s >= limit)], ["doc_id", "score", "toxic"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), lang.alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double, toxic boolean")
