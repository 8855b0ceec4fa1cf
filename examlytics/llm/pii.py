"""Personal data by bootstrapped contextual extraction.

Strict forms (e-mail, ip, card, phone) are found in every text and always
stay. They are also the seeds of a bootstrap that finds identifiers whose form
alone proves nothing (a number without its plus sign, "name at host dot org"):

1. One pass collects strict matches and looser candidates with their
   patterns: the word before (L1), the two words before (L2), the word after
   (R1), and the form (S: digits as 0, letters as a) of those that pass their
   kind's test, such as the card check digit. Strict matching drops a match that
   runs into its neighbour (a phone number right before a card number); both
   parts are candidates here.
2. A second pass counts every occurrence of those words and word pairs in the
   whole corpus, so a pattern's precision is measured against all text, not
   only against candidates: "the" before a phone number proves nothing.
3. Spark scores the bipartite graph of patterns and instances in rounds: a
   pattern scores the share of its occurrences that stand at accepted
   instances (with ``SUPPORT`` different ones at least); a candidate instance
   scores the noisy-or of its good patterns; instances over ``ACCEPT`` are
   accepted and induce patterns in the next round, until a round accepts
   nothing new (accepted instances only grow, so this ends). All mentions of
   accepted instances become spans.

Scale: both passes are narrow; what they emit is pre-aggregated. Patterns are
marked in a bitmap of fixed size for the second pass; it is the only thing
broadcast, and false positives only add rows that no pattern joins. Texts never
shuffle.

Edge cases: a null text is empty; rows that repeat or lack a doc_id give one
row each; empty texts have no spans; further columns are ignored. Offsets are
code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from examlytics.llm.marks import bitmap, marked
from examlytics.llm.store import discard, keep
from examlytics.llm.text import ASCII_LOWER, LOWER_ALNUM, Words, buffer_of, ngram_hashes, slices

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 3
PRECISION = 0.5
ACCEPT = 0.75
MARK_BITS = 1 << 22
HELD = 1 << 19  # pattern counts that a task holds before it passes them on
REACH = 160  # characters around a match that are searched for its context words

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile("[0-9]")
# A match never starts inside a run of digits, so the look-behind only saves time.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Looser forms; each starts only where a run of its characters starts, so scanning stays linear.
_LOOSE_EMAIL = re.compile(
    r"(?<![\w.%+-])[A-Za-z0-9._%+-]+(?:\x20?(?:\[at\]|\(at\)|@)\x20?[A-Za-z0-9-]+(?:\x20?(?:\[dot\]|\(dot\)|\.)\x20?[A-Za-z0-9-]+)+"
    r"|\x20at\x20[A-Za-z0-9-]+(?:\x20dot\x20[A-Za-z0-9-]+)+)(?!\w)")
_LOOSE_IP = re.compile(r"(?<![\w.:])[0-9A-Fa-f]+(?::[0-9A-Fa-f]*){3,7}(?![\w:])")
_LOOSE_CARD = re.compile(r"(?<![\w.-])[0-9](?:[\x20.-]?[0-9]){12,18}(?!\w)")
_LOOSE_PHONE = re.compile(r"(?<![\w+.-])\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}(?!\w)")
_AT = re.compile(r"@|\[at\]|\(at\)|\x20dot\x20")
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_PLAIN = re.compile(rb"[0-9a-z\x80-\xff]+(?: [0-9a-z\x80-\xff]+)?")

MENTION = "array<struct<kind:int,start:bigint,end:bigint,surface:string,seed:boolean,patterns:array<struct<slot:string,h:bigint>>>>"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their @ signs (linear time)."""
    free = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def strict(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all strict matches, by kind, then start."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start():
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def loose(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates of each kind that touch neither a strict match nor an earlier candidate."""
    forms = [(0, _LOOSE_EMAIL)] if _AT.search(text) else []
    if text.count(":") >= 3:
        forms.append((1, _LOOSE_IP))
    if _DIGIT.search(text):
        forms += [(2, _LOOSE_CARD), (3, _LOOSE_PHONE)]
    out, used = [], None
    for kind, pattern in forms:
        for m in pattern.finditer(text):
            s, e = m.span()
            if used is None:
                used = bytearray(len(text))
                for _, a, b in taken:
                    used[a:b] = b"\1" * (b - a)
            if used.find(1, s, e) < 0:
                used[s:e] = b"\1" * (e - s)
                out.append((kind, s, e))
    return out


def _shape(kind: int, surface: str) -> bytes | None:
    """The form of an identifier that also passes its kind's test: digits as 0, runs of letters as a."""
    digits = re.sub("[^0-9]", "", surface)
    if kind == 2 and not luhn(digits) or kind == 3 and not 8 <= len(digits) <= 15:
        return None
    return re.sub("[A-Za-z]+", "a", re.sub("[0-9]", "0", surface)).encode() + b"="


def _context(text: str, s: int, e: int) -> tuple[list[bytes], list[bytes]]:
    """Up to two words before and one after a match."""
    left = _WORD.findall(text[max(0, s - REACH):s].encode().lower())[-2:]
    return left, _WORD.findall(text[e:e + REACH].encode().lower())[:1]


def _hash_all(phrases: list[bytes]) -> np.ndarray:
    """The hash of each phrase of one or two words, as the corpus pass computes it (forms are one phrase)."""
    texts = pa.array(phrases, pa.binary()).cast(pa.string())
    words = Words(*buffer_of(texts), LOWER_ALNUM)
    out = ngram_hashes(words.hashes(), words.first[:-1], words.first[1:])
    forms = np.array([not _PLAIN.fullmatch(p) for p in phrases])
    if forms.any():
        whole = Words(*buffer_of(texts), np.ones(256, bool))
        out[forms] = whole.hashes()[forms]
    return out


def mentions(docs: DataFrame) -> DataFrame:
    """Per row: strict spans, and the mentions (strict and loose) with their patterns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            base, found, phrases = [], [], []
            for text in b.column("text").to_pylist():
                own, rows = strict(text), []
                for kind, s, e, seed in [(*x, True) for x in own] + [(*x, False) for x in loose(text, own)]:
                    left, right = _context(text, s, e)
                    slots = [("L1", left[-1:]), ("L2", left if len(left) == 2 else []), ("R1", right)]
                    patterns = []
                    for slot, words in slots:
                        if words:
                            patterns.append({"slot": slot, "h": len(phrases)})
                            phrases.append(b" ".join(words))
                    form = _shape(kind, text[s:e])
                    if form:
                        patterns.append({"slot": "S", "h": len(phrases)})
                        phrases.append(form)
                    rows.append({"kind": kind, "start": s, "end": e, "surface": re.sub(r"\W", "", text[s:e]).lower(), "seed": seed, "patterns": patterns})
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in own])
                found.append(rows)
            hashes = _hash_all(phrases).view(np.int64).tolist() if phrases else []
            for rows in found:
                for r in rows:
                    for p in r["patterns"]:
                        p["h"] = hashes[p["h"]]
            span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
            mention = pa.list_(pa.struct([
                ("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("surface", pa.string()), ("seed", pa.bool_()),
                ("patterns", pa.list_(pa.struct([("slot", pa.string()), ("h", pa.int64())])))]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("version"), pa.array(base, span), pa.array(found, mention)], ["doc_id", "version", "base", "mentions"])

    return docs.mapInArrow(run, f"doc_id bigint, version bigint, base array<struct<kind:int,start:bigint,end:bigint>>, mentions {MENTION}")


def _occurrences(docs: DataFrame, patterns: DataFrame, bits: int = MARK_BITS) -> DataFrame:
    """(h, total): how often the pattern words and word pairs occur in the corpus."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(patterns, bits, "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # of the partition so far
        for b in slices(batches, "text"):
            buf, off = buffer_of(b.column("text"))
            words = Words(ASCII_LOWER[buf], off, LOWER_ALNUM)
            single, owner = words.hashes(), words.owner()
            at = np.arange(len(words))
            two = np.flatnonzero(owner[1:] == owner[:-1]) if len(words) else at
            h = np.concatenate([ngram_hashes(single, at, at + 1), ngram_hashes(single, two, two + 2)])
            h = h[marked(shared.value, h)]
            kept, place = np.unique(np.concatenate([kept, h]), return_inverse=True)
            count = np.bincount(place, np.concatenate([count, np.ones(len(h), np.int64)]), len(kept)).astype(np.int64)
            if len(kept) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(kept.view(np.int64)), pa.array(count)], ["h", "n"])
                kept, count = kept[:0], count[:0]
        yield pa.RecordBatch.from_arrays([pa.array(kept.view(np.int64)), pa.array(count)], ["h", "n"])

    return docs.select("text").mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("total"))


def discover(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(kind, surface) of the accepted instances: seeds, and those that patterns of the seeds lead to."""
    each = found.select(F.explode("mentions").alias("m")).select("m.kind", "m.surface", "m.seed", F.explode("m.patterns").alias("p"))
    every = keep(each.groupBy("kind", "surface", "p.slot", "p.h").agg(F.max("seed").alias("seed"), F.count("*").alias("n")), "pattern-instances")
    seeds = every.groupBy("kind", "surface").agg(F.max("seed").alias("accepted"))
    # A pattern of fewer instances can never reach its support.
    wide = every.groupBy("kind", "slot", "h").count().filter(F.col("count") >= SUPPORT).drop("count")
    edges = keep(every.join(wide, ["kind", "slot", "h"]), "supported-patterns")
    form = every.filter("slot = 'S'")
    words = _occurrences(docs, edges.filter("slot <> 'S'").select("h").distinct())
    totals = keep(words.unionByName(form.groupBy("h").agg(F.sum("n").alias("total"))), "pattern-totals")
    known = keep(seeds, "instances")
    while True:
        graph = edges.drop("seed").join(known, ["kind", "surface"])
        patterns = (graph.groupBy("kind", "slot", "h")
                    .agg(F.sum(F.when(F.col("accepted"), F.col("n"))).alias("hits"), F.sum(F.col("accepted").cast("int")).alias("support"))
                    .filter(F.col("support") >= SUPPORT).join(totals, "h")
                    .withColumn("precision", F.col("hits") / (F.col("total") + 1)).filter(F.col("precision") >= PRECISION))
        scored = (graph.filter("not accepted").join(patterns.select("kind", "slot", "h", "precision"), ["kind", "slot", "h"])
                  .groupBy("kind", "surface").agg((1 - F.exp(F.sum(F.log(1 - F.col("precision"))))).alias("score")))
        good = keep(scored.filter(F.col("score") >= ACCEPT).select("kind", "surface"), "accepted")
        if good.isEmpty():
            break
        last = known
        known = keep(last.join(good.withColumn("now", F.lit(True)), ["kind", "surface"], "left")
                     .select("kind", "surface", (F.col("accepted") | F.coalesce("now", F.lit(False))).alias("accepted")), "instances")
        discard(last)
        discard(good)
    return known.filter("accepted").select("kind", "surface")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base (strict spans) and spans (base and discovered), by kind, then start."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("version", F.xxhash64("doc_id", "text"))
    found = keep(mentions(rows), "mentions")
    accepted = discover(rows, found)
    candidates = found.select("version", F.explode("mentions").alias("m")).filter("not m.seed").select("version", "m.kind", "m.start", "m.end", "m.surface")
    added = (candidates.join(accepted, ["kind", "surface"]).groupBy("version").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added")))
    out = found.select("doc_id", "version", "base").join(added, "version", "left")
    return out.select("doc_id", F.array_sort("base").alias("base"), F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")))).alias("spans"))


def joined(spans: str, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end, comma-joined in the order of the array."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(F.col(spans), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def count_of(spans: str, kind: int) -> Column:
    return F.size(F.filter(F.col(spans), lambda x: x["kind"] == kind)).cast("bigint")
