"""Token counts by heap-and-linked-list byte-pair merging.

The count of a text is its number of initial symbols (characters; a character
that the vocabulary lacks counts as its UTF-8 bytes) minus the number of
merges; no identifiers are made. Spaces become the piece mark and one mark
precedes the text, as the model's normaliser does. No piece of the vocabulary
has a mark after another character, so merges never cross the start of a word
and words are merged apart, each distinct one once (a bounded memo per
worker); the property is checked when the model is loaded, and a vocabulary
without it merges whole texts.

Scale: narrow, one pass, no shuffle; memory is one batch and the memo.

Edge cases: null and empty texts have 0 tokens and 0 bytes; repeated rows and
null ids give one row each; special strings inside a text are plain text;
further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from examlytics.llm.merging import Memo, merge
from examlytics.llm.text import slices

MARK = "▁"


class PieceCounter:
    """Counts tokens of texts under one sentencepiece BPE model."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        plain = [i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.rank = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        split = not any(MARK in p.lstrip(MARK) for p in self.rank)
        lines = split and not any("\n" in p and len(p) > 1 for p in self.rank)
        # Where pieces never cross: words, and line ends if no piece holds one.
        self.parts = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+" if lines else f"{MARK}*[^{MARK}]+|{MARK}+" if split else "(?s).+").findall
        self.memo = Memo(self._count)

    def _count(self, part: str) -> int:
        left = merge(list(part), self.rank)
        return sum(1 if s in self.rank else len(s.encode()) for s in left)

    def count(self, text: str) -> int:
        return sum(map(self.memo.__getitem__, self.parts(MARK + text.replace(" ", MARK)))) if text else 0


@lru_cache(maxsize=2)
def counter(model_path: str) -> PieceCounter:
    """One model per worker process."""
    return PieceCounter(model_path)


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every text; ``model_path`` is a file that every worker has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_path).count
        for b in slices(batches, "text"):
            texts = b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("n_bytes"), pa.array([count(t) if t else 0 for t in texts], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"))
    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
