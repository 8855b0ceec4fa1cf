"""Cross-tokenizer alignment with exact-text deduplication.

Two tokenisations A and B of the same bytes are cut into groups at the byte
offsets where tokens of both end; the two tokens that end there are linked.
Rows are shuffled by full text; each distinct text is tokenised and aligned
once, its links count as often as the text occurs, and its measures are joined
to every doc_id by the SHA-256 of the text.

A is a byte-level vocabulary file of the tokenizers library and reads a space
and the text; B is a sentencepiece model, which adds that space itself. Neither
library merges across a single space between two visible characters (A's
pre-tokens never go from visible to white, B has no piece with the space mark
after another character; this is checked when the model is loaded), so texts
are cut there, and the parts that a worker does not remember (a bounded memo) are given
to the libraries, in batches, and aligned. A vocabulary without that property gets whole texts.

Scale: ``groupBy`` on the text merges copies in each map task first, so a text
that a third of all rows share arrives once per task. Of two linked tokens one
is a suffix of the other, so there are at most as many id pairs as the tokens
of both vocabularies have bytes (times the few ids of equal bytes), a few
100,000 here: their counts are summed per task, then by Spark, and the sums
are broadcast. The links themselves never shuffle. Long texts are handled in
pieces of ``PIECE`` characters.

Edge cases: texts that are null, empty, or not reproduced by either tokeniser
have no tokens, zero measures and groups ''; copies, repeated rows and null ids
give one row each, with equal measures; ties for the highest count of a B id
all count as best; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from examlytics.llm.store import discard, keep
from examlytics.llm.text import slices

MARK = "▁"
PIECE = 1 << 20
#: Parts in each of the two generations that a worker remembers, and the longest of them in characters.
MEMO, LONGEST = 300_000, 48
#: Bits of a B id in a pair key; A's id is above them.
SHIFT = 32

BETWEEN = re.compile(r"(?<=\S) (?=\S)")
BYTE = re.compile("<0x([0-9A-F]{2})>")


def _byte_of_symbol() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for code points from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Tokenises and aligns texts; one per worker process."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        byte = _byte_of_symbol()
        self.a_bytes = [bytes(byte[c] for c in self.a.id_to_token(i)) if set(self.a.id_to_token(i)) <= byte.keys() else self.a.id_to_token(i).encode() for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := BYTE.fullmatch(p)) else p.replace(MARK, " ").encode() for p in pieces]
        self.a_size, self.b_size = list(map(len, self.a_bytes)), list(map(len, self.b_bytes))
        self.parted = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.number = list(map(str, range(max(len(self.a_bytes), len(self.b_bytes)))))
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def _aligned(self, part: str, a: list[int], b: list[int]) -> tuple[int, int, int, str, bytes] | None:
        """n_a, n_b, n_groups, the groups and the linked pairs' keys of a tokenised part; None if a tokeniser changed the bytes."""
        raw = b" " + part.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        a_size, b_size, number, groups, links = self.a_size, self.b_size, self.number.__getitem__, [], []
        i = j = x = y = a_end = b_end = 0
        while i < len(a):
            a_end += a_size[a[i]]
            i += 1
            while b_end < a_end:
                b_end += b_size[b[j]]
                j += 1
            if a_end == b_end:
                groups.append(",".join(map(number, a[x:i])) + "|" + ",".join(map(number, b[y:j])))
                links.append(a[i - 1] << SHIFT | b[j - 1])
                x, y = i, j
        return len(a), len(b), len(groups), ";".join(groups), struct.pack(f"{len(links)}q", *links)

    def known(self, parts: set[str]) -> dict[str, tuple | None]:
        """The alignments of parts, remembered or made; of two generations the older is forgotten when the younger is full."""
        own = {p: self.young[p] for p in parts & self.young.keys()}
        again = {p: self.old[p] for p in (parts - own.keys()) & self.old.keys()}
        new = list(parts - own.keys() - again.keys())
        encoded = self.a.encode_batch([" " + p for p in new], add_special_tokens=False)
        made = {p: self._aligned(p, a.ids, b) for p, a, b in zip(new, encoded, self.b.encode(new, num_threads=1), strict=True)}
        if len(self.young) + len(again) + len(made) > MEMO:
            self.young, self.old = {}, self.young
        self.young |= again
        self.young |= {p: m for p, m in made.items() if len(p) <= LONGEST}
        return own | again | made

    def parts(self, text: str) -> Iterator[list[str]]:
        """A text cut at its single spaces, some parts at a time."""
        if not self.parted:
            yield [text]
            return
        at = 0
        while at < len(text):
            cut = BETWEEN.search(text, at + PIECE) if at + PIECE < len(text) else None
            end = cut.start() if cut else len(text)
            yield BETWEEN.split(text[at:end])
            at = end + 1

    def texts(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, bytes, Iterator[str]] | None]:
        """Per text n_a, n_b, n_groups, pair keys and its groups in pieces; None: the text has no tokens."""
        first = [next(self.parts(t), []) if t else [] for t in texts]
        known = self.known(set(itertools.chain.from_iterable(first)))
        for text, parts in zip(texts, first, strict=True):
            found = list(map(known.__getitem__, parts))
            if text and len(text) > PIECE:
                for more in itertools.islice(self.parts(text), 1, None):
                    found += map(self.known(set(more)).__getitem__, more)
            if not found or None in found:
                yield None
                continue
            n_a, n_b, n, groups, links = zip(*found, strict=True)
            yield sum(n_a), sum(n_b), sum(n), b"".join(links), groups


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def groups_of(text: str, a_path: str, b_path: str) -> str:
    """The alignment of one text, ``a1,a2|b1;a3|b2,b3``; '' if it has no tokens."""
    got = next(aligner(a_path, b_path).texts([text]))
    return ";".join(got[4]) if got else ""


MEASURES = "digest binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links binary"


def _aligned(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Measures and linked pairs (64-bit keys) of distinct texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(a_path, b_path)
        for b in slices(batches, "text"):
            rows = [(*got[:4], hashlib.sha256(";".join(got[4]).encode()).hexdigest()) if got else (0, 0, 0, b"", "")
                    for got in align.texts(b.column("text").to_pylist())]
            n_a, n_b, n, links, sha = zip(*rows, strict=True)
            count = pa.array(n, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("digest"), b.column("copies"), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), count, count,
                                              pa.array(sha, pa.string()), pa.array(links, pa.binary())],
                                             ["digest", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    return texts.mapInArrow(run, MEASURES)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many links corpus-wide join the two ids; copies of a text count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in slices(batches, "links", 1 << 23):
            keys, off = np.frombuffer(b"".join(b.column("links").to_pylist()), np.int64), b.column("n_links").to_numpy()
            new, of = np.unique(keys, return_inverse=True)
            times = np.zeros(len(new), np.int64)
            np.add.at(times, of, np.repeat(b.column("copies").to_numpy(), off))
            pair, of = np.unique(np.concatenate([pair, new]), return_inverse=True)
            total = np.zeros(len(pair), np.int64)
            np.add.at(total, of, np.concatenate([n, times]))
            n = total
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])

    return aligned.mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def _scored(aligned: DataFrame, counts) -> DataFrame:
    """n_best and count_sum of each distinct text, from the broadcast pair counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = counts.value
        for b in slices(batches, "links", 1 << 22):
            keys = np.frombuffer(b"".join(b.column("links").to_pylist()), np.int64)
            at = np.searchsorted(pair, keys)
            off = np.concatenate([[0], np.cumsum(b.column("n_links").to_numpy())])
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (best[at], n[at])]
            n_best, count_sum = (pa.array((s[off[1:]] - s[off[:-1]]).astype(np.int64)) for s in sums)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("digest", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")), n_best, count_sum],
                                             ["digest", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"])

    return aligned.drop("copies").mapInArrow(run, "digest binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint")


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    digest = F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("digest")
    texts = rows.groupBy("text").agg(F.count(F.lit(1)).alias("copies")).select("text", "copies", digest)
    aligned = keep(_aligned(texts, a_path, b_path), "aligned-texts")
    got = pair_counts(aligned).toPandas().sort_values("pair")  # bounded by the two vocabularies
    pair, n = got["pair"].to_numpy(np.int64), got["n"].to_numpy(np.int64)
    b_id = pair & ((1 << SHIFT) - 1)
    most = np.zeros(int(b_id.max(initial=0)) + 1, np.int64)
    np.maximum.at(most, b_id, n)
    counts = spark.sparkContext.broadcast((pair, n, (n == most[b_id]).astype(np.int64)))
    measures = keep(_scored(aligned, counts), "alignments")
    discard(aligned)
    return rows.select("doc_id", digest).join(measures, "digest").drop("digest")
