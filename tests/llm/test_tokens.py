"""Token counts and byte-level BPE against the tokenizer libraries."""
import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from examlytics.llm import byte_bpe, token_count
from examlytics.llm.byte_bpe import ByteBpe
from examlytics.llm.merging import merge

RANKS, MODEL = P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model")
ALPHABET = "ab  \n\n\t'sé日ﬁ\x1c\x85　 ٣½!?,.''ll▁THE<s>0123\U0001F600\r"


def texts(n, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_equal_the_library():
    model, counter = sentencepiece.SentencePieceProcessor(model_file=MODEL), token_count.PieceCounter(MODEL)
    for t in texts(3000, 60, 1) + ["", " ", "   ", "\n\n", "a" * 5000, "<s>a</s><unk>", " x " * 500]:
        assert counter.count(t) == len(model.encode(t)), t


def test_encoding_equals_the_library(library):
    bpe = ByteBpe(RANKS, P.PATTERN)
    for t in texts(3000, 60, 2) + ["", "<|endoftext|>", "x" * 3000, "  \n  a"]:
        ids = bpe.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t), t
        assert bpe.decode(ids) == t.encode()


def test_merge_prefers_low_rank_then_left():
    assert merge(list("aaaa"), {"aa": 0, "aaaa": 1}) == ["aaaa"]
    assert merge(list("aaa"), {"aa": 0}) == ["aa", "a"]
    assert merge(list("abc"), {"bc": 0, "ab": 1}) == ["a", "bc"]
    assert merge([], {}) == []


def test_memo_is_bounded():
    from examlytics.llm.merging import Memo
    memo = Memo(len, limit=3, longest=4)
    assert [memo[k] for k in ("a", "bb", "ccc", "dddd", "eeeee")] == [1, 2, 3, 4, 5]
    assert len(memo) <= 3 and "eeeee" not in memo


def test_memo_keeps_the_generation_before():
    from examlytics.llm.merging import Memo
    computed = []
    memo = Memo(lambda k: computed.append(k) or len(k), limit=3, longest=4)
    for k in ("a", "b", "c", "d", "c", "a", "d", "b"):
        assert memo[k] == 1
    assert computed == ["a", "b", "c", "d"]
    assert len(memo) <= 3 and len(memo.older) <= 3


def test_short_merge_equals_the_heap():
    from examlytics.llm.merging import merge_short
    rng = random.Random(7)
    for _ in range(2000):
        alphabet = "ab" if rng.random() < 0.5 else "abc"
        rank = {"".join(rng.choice(alphabet) for _ in range(rng.randint(2, 5))): i for i in range(rng.randint(0, 12))}
        symbols = [rng.choice(alphabet) for _ in range(rng.randint(0, 40))]
        assert merge_short(symbols, rank) == merge(symbols, rank), (symbols, rank)


def test_chunks_meet_where_pre_tokens_agree(spark, docs_of, library):
    long = texts(25, 900, 3) + ["ab " * 400, "x" * 700, " " * 500, "y" * 90 + " z" * 300, "", None]
    rows = [(i, t) for i, t in enumerate(long)] + [(3, long[3]), (None, "null id " * 30)]
    out = byte_bpe.encode(docs_of(rows), RANKS, P.PATTERN, chunk=100, overlap=30).collect()
    assert len(out) == len(rows)
    want = sorted((i if i is not None else -1, library.encode_ordinary(t or "")) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, np.frombuffer(r.ids, "<u4").tolist()) for r in out) == want


def test_digests_round_trip(docs_of):
    rows = [(1, "Hello, wörld  \n"), (2, None), (2, ""), (3, "日本" * 40)]
    ids = byte_bpe.encode(docs_of(rows), RANKS, P.PATTERN)
    got = {(r.doc_id, r.decoded_sha256) for r in byte_bpe.digests(ids, RANKS, P.PATTERN).collect()}
    assert got == {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows}
    decoded = byte_bpe.decode(ids, RANKS, P.PATTERN).filter("doc_id = 3").first().decoded
    assert bytes(decoded).decode() == "日本" * 40


def test_count_tokens_edges(docs_of):
    rows = [(1, "a b"), (1, "a b"), (None, None), (4, ""), (5, "\U0001F600")]
    out = sorted(((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in token_count.count_tokens(docs_of(rows), MODEL).collect()))
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert out == sorted((i or 0, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows)
    assert token_count.count_tokens(docs_of([]).filter(F.lit(False)), MODEL).count() == 0


def test_encoding_goes_on_after_a_missing_seam(docs_of, library, monkeypatch):
    """One pre-token longer than chunk and overlap: only the gap is one piece, the chunks after it are pieces again."""
    text = " ".join(f"word{i}" for i in range(60)) + " " + "x" * 450 + " " + " ".join(f"more{i}" for i in range(120))
    sizes = []
    monkeypatch.setattr(byte_bpe, "keep", lambda df, name, keep=byte_bpe.keep: sizes.append(df.count()) or keep(df, name) if name == "regions" else keep(df, name))
    out = byte_bpe.encode(docs_of([(1, text), (2, "y" * 900)]), RANKS, P.PATTERN, chunk=100, overlap=30).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in out} == {1: library.encode_ordinary(text), 2: library.encode_ordinary("y" * 900)}
    assert sizes and sizes[0] >= len(text) // 100 - 4


@pytest.mark.parametrize("n", [byte_bpe.CHUNK - 1, byte_bpe.CHUNK, byte_bpe.CHUNK + 1])
def test_both_sides_of_the_chunk_size(docs_of, library, n):
    text = ("Prose, 12 words;\n" * (n // 17 + 1))[:n]
    row = byte_bpe.encode(docs_of([(1, text)]), RANKS, P.PATTERN).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == library.encode_ordinary(text)
