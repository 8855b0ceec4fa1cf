"""Byte-level BPE encoding and decoding with overlapping chunks.

A text up to ``chunk`` characters is encoded where it lies (narrow, no
shuffle). A longer text is cut into chunks of ``chunk`` characters plus
``overlap`` characters of the next; all chunks are pre-tokenised in parallel.
The pattern never looks back, so two chunks that share a pre-token boundary
agree from there on: each seam is the first boundary in the overlap that both
chunks have (the last pre-token of a chunk may be cut short and does not
count). Between seams the pieces are encoded, again in parallel, and the ids of
a document are joined in order. Where a seam is missing (one pre-token longer
than the overlap) the piece goes on to the next seam; whether that one is a
boundary of the piece as well is checked when the piece is pre-tokenised, and
only a document where it is not is encoded in one piece. Decoding concatenates the bytes of the ids.

Scale: only texts over ``chunk`` characters are shuffled, and only whole ids of
one document ever meet in one row. The memo of distinct pieces is bounded.

Edge cases: null and empty texts have no ids; repeated rows and null ids give
one row each; special strings inside a text are plain text; further columns
are ignored; an id outside the ranks fails to decode.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from examlytics.llm.merging import Memo, merge, merge_short
from examlytics.llm.store import keep
from examlytics.llm.text import slices

CHUNK = 1 << 16
OVERLAP = 1 << 10
SCANNED = 64  # bytes of a piece up to which a scan for the lowest rank beats the heap
REMEMBERED = 300_000  # pieces of a memo's generation


class ByteBpe:
    """Encoder and decoder for one rank file and pre-token pattern."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex

        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        # White space as the Unicode property; Python's class also has \x1c-\x1f.
        unicode_space = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"[^\p{White_Space}]").replace(r"\s", r"[\p{White_Space}]")
        self.pattern = regex.compile(unicode_space)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.single = [bytes([i]) for i in range(256)]
        self.memo = Memo(self._encode_piece, limit=REMEMBERED)

    def _encode_piece(self, piece: str) -> bytes:
        raw = piece.encode()
        whole = self.ranks.get(raw)
        join = merge_short if len(raw) <= SCANNED else merge
        ids = [whole] if whole is not None else [self.ranks[s] for s in join([self.single[b] for b in raw], self.ranks)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def boundaries(self, text: str) -> list[int]:
        """Ends of the pre-tokens of a text."""
        return [m.end() for m in self.pattern.finditer(text)]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def model(ranks_path: str, pattern: str) -> ByteBpe:
    """One model per worker process."""
    return ByteBpe(ranks_path, pattern)


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(doc, doc_id, idx, text): the chunks of long texts, with the overlap at their end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for b in slices(batches, "text"):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                doc, number = f"{part}-{number}", number + 1
                for idx, at in enumerate(range(0, len(text), chunk)):
                    yield pa.RecordBatch.from_pydict({
                        "doc": [doc], "doc_id": pa.array([doc_id], pa.int64()), "idx": pa.array([idx], pa.int32()),
                        "last": [at + chunk >= len(text)], "text": [text[at: at + chunk + overlap]]})

    return long.mapInArrow(run, "doc string, doc_id bigint, idx int, last boolean, text string")


def _edges(chunks: DataFrame, ranks_path: str, pattern: str, chunk: int) -> DataFrame:
    """Pre-token boundaries of each chunk that a neighbour can share, counted from the chunk's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(ranks_path, pattern)
        for b in slices(batches, "text"):
            head, tail = [], []
            for text, last in zip(b.column("text").to_pylist(), b.column("last").to_pylist(), strict=True):
                ends = bpe.boundaries(text)
                if not last:
                    ends = ends[:-1]  # may be cut short
                head.append([e for e in ends if e <= OVERLAP or e <= len(text) - chunk])
                tail.append([e for e in ends if e >= chunk])
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("idx"), pa.array(head, pa.list_(pa.int32())), pa.array(tail, pa.list_(pa.int32()))], ["doc", "idx", "head", "tail"])

    return chunks.repartition("doc", "idx").select("doc", "idx", "last", "text").mapInArrow(run, "doc string, idx int, head array<int>, tail array<int>")


def _seams(edges: DataFrame, chunk: int) -> DataFrame:
    """Per chunk: its seam (offset where it starts to count) and the region it belongs to.

    A region is one chunk, or several where seams between them are missing.
    """

    def stitch(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        tails, region, out = None, 0, []
        for r in rows.itertuples():
            both = {x - chunk for x in tails} & set(r.head) if r.idx else {0}
            if both:
                region = r.idx
            out.append((r.doc, r.idx, region, min(both, default=0)))
            tails = r.tail
        return pd.DataFrame(out, columns=["doc", "idx", "region", "seam"])

    return edges.groupBy("doc").applyInPandas(stitch, "doc string, idx int, region int, seam int")


def _encode_long(long: DataFrame, ranks_path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    chunks = keep(_chunks(long, chunk, overlap), "chunks")
    seams = keep(_seams(_edges(chunks, ranks_path, pattern, chunk), chunk), "seams")
    nxt = seams.select("doc", (F.col("idx") - 1).alias("idx"), F.col("seam").alias("stop"), F.col("region").alias("next_region"))
    joined = chunks.join(seams, ["doc", "idx"]).join(nxt, ["doc", "idx"], "left")

    def encode(rows: pd.DataFrame) -> pd.DataFrame:
        bpe = model(ranks_path, pattern)
        rows = rows.sort_values("idx")
        pieces, beyond = [], ""
        for r in rows.itertuples():
            begin = int(r.seam) if r.idx == r.region else 0
            if pd.isna(r.stop):
                pieces.append(r.text[begin:])
            else:
                stop = chunk + (int(r.stop) if r.next_region != r.region else 0)
                pieces.append(r.text[begin:stop])
                beyond = r.text[stop:] if r.next_region != r.region else ""
        piece = "".join(pieces)
        met = len(rows) == 1 or not beyond or len(piece) in bpe.boundaries(piece + beyond)
        return pd.DataFrame({"doc": [rows.doc.iloc[0]], "doc_id": [rows.doc_id.iloc[0]], "region": [rows.region.iloc[0]], "ids": [bpe.encode(piece) if met else b""],
                             "met": [met]}).astype({"doc_id": "Int64"})

    kind = "doc string, doc_id bigint, region int, ids binary, met boolean"
    regions = keep(joined.groupBy("doc", "region").applyInPandas(encode, kind), "regions")
    unmet = regions.filter("not met").select("doc").distinct()
    # No region of theirs is known to start at a boundary.
    whole = chunks.join(unmet, "doc", "left_semi").select("doc", "doc_id", "idx", "last", "text", F.lit(0).alias("region"), F.lit(0).alias("seam"),
                                                          F.when(~F.col("last"), F.lit(0)).alias("stop"), F.when(~F.col("last"), F.lit(0)).alias("next_region"))
    regions = regions.join(unmet, "doc", "left_anti").unionByName(whole.groupBy("doc", "region").applyInPandas(encode, kind))
    return (regions.groupBy("doc").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("region", "ids"))).alias("r"))
            .select("doc_id", F.expr("aggregate(r.ids, cast('' as binary), (a, x) -> concat(a, x))").alias("ids")))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def encode(docs: DataFrame, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of every text."""
    rows = _texts(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(ranks_path, pattern)
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([bpe.encode(t) for t in b.column("text").to_pylist()], pa.binary())], ["doc_id", "ids"])

    short = rows.filter(F.length("text") <= chunk).mapInArrow(run, "doc_id bigint, ids binary")
    return short.unionByName(_encode_long(rows.filter(F.length("text") > chunk), ranks_path, pattern, chunk, overlap))


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and the raw bytes that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(ranks_path, pattern)
        for b in slices(batches, "ids"):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([bpe.decode(i) for i in b.column("ids").to_pylist()], pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded binary")


DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids binary"


def _digest(bpe: ByteBpe, doc_ids: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        doc_ids, pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
        pa.array([hashlib.sha256(bpe.decode(i)).hexdigest() for i in ids], pa.string()), pa.array(ids, pa.binary())],
        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])


def digests(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per row: number of ids, the SHA-256 of the ids and of the bytes they decode to, and the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(ranks_path, pattern)
        for b in slices(batches, "ids"):
            yield _digest(bpe, b.column("doc_id"), b.column("ids").to_pylist())

    return encoded.select("doc_id", "ids").mapInArrow(run, DIGESTS)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``digests`` of ``encode``, in one Python pass for the texts that need no chunks."""
    rows = _texts(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(ranks_path, pattern)
        for b in slices(batches, "text"):
            yield _digest(bpe, b.column("doc_id"), [bpe.encode(t) for t in b.column("text").to_pylist()])

    short = rows.filter(F.length("text") <= chunk).mapInArrow(run, DIGESTS)
    long = _encode_long(rows.filter(F.length("text") > chunk), ranks_path, pattern, chunk, overlap)
    return short.unionByName(digests(long, ranks_path, pattern))
