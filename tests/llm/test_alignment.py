"""Cross-tokenizer alignment against the libraries on whole texts."""
import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from examlytics.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def by_force(rows):
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte = alignment._byte_of_symbol()
    assert len(byte) == 256 and sorted(byte.values()) == list(range(256))

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    docs = []
    for i, text in rows:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        ax = [bytes(byte[c] for c in a.id_to_token(t)) for t in x]
        by = [piece(t) for t in y]
        if not text or b"".join(ax) != b" " + text.encode() or b"".join(by) != b" " + text.encode():
            docs.append((i, [], [], []))
            continue
        ends = lambda raw: [sum(map(len, raw[: k + 1])) for k in range(len(raw))]
        ea, eb = ends(ax), ends(by)
        groups, s, t = [], 0, 0
        for e in sorted(set(ea) & set(eb)):
            p, q = ea.index(e) + 1, eb.index(e) + 1
            groups.append((x[s:p], y[t:q]))
            s, t = p, q
        docs.append((i, x, y, groups))
    count = Counter((g[0][-1], g[1][-1]) for *_, groups in docs for g in groups)
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for i, x, y, groups in docs:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        said = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        out.append((str(i), len(x), len(y), len(groups), len(links), sum(count[k] == most[k[1]] for k in links), sum(count[k] for k in links),
                    hashlib.sha256(said.encode()).hexdigest() if said else ""))
    return sorted(out)


@pytest.mark.parametrize("piece", [alignment.PIECE, 7])
def test_alignment(spark, docs_of, monkeypatch, piece):
    """Prose in several scripts, odd white space, marks and special strings, copies; long texts in pieces."""
    monkeypatch.setattr(alignment, "PIECE", piece)
    alignment.aligner.cache_clear()
    prose = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()]
    odd = [None, "", " ", "  two  spaces ", "tabs\t\tand\nlines\n\n end ", "mark ▁ here", "é ﬁ ǆ", "\x00 x \x1c y z　w\x85v", "<|endoftext|> <s> </s> <unk> <0x41>", "日本語のテキスト と русский текст", "a" * 300, "it's we'll 123 4567 ::: !!", "x ' y", "\r\n z", " lead", "trail "]
    rows = list(enumerate(prose + odd)) + [(900, odd[3]), (901, odd[3]), (0, prose[0]), (None, odd[8]), (None, odd[8])]
    got = alignment.align(docs_of(rows), A, B).collect()
    assert sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got) == by_force(rows)
    assert alignment.align(docs_of([]), A, B).collect() == []
    assert alignment.groups_of("a b", A, B).count("|") >= 2
