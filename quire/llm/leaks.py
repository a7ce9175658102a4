"""Problem 9: evaluation passages in training documents, found by an FM-index of each shard of documents.

A shard is a run of whole documents of about SHARD_WORDS words. Its words become codes, one for each word of the items. A word that no
item has ends a segment, and a segment of fewer than RUN words can hold no passage; the other segments are indexed whole: their suffix
array gives the Burrows-Wheeler transform, a wavelet matrix its ranks. All runs of RUN words of the items are searched backwards
together; occurrences are located by sampled suffix positions and merged into spans. Only the items are collected and broadcast: their
table is of fixed size.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.looks import INVISIBLE_MARKS, ODD, skeleton
from quire.session import ship
from quire.sources.arrow import INT, LONG, map_batches, rows_batch
from quire.sources.tables import read

RUN = 12
#: Words of a shard, a bound for memory; a longer document is a shard by itself. It changes no result.
SHARD_WORDS = 400_000
SAMPLE = 8
WORDS = re.compile(r"[^\W_]+").findall
MARKS = regex.compile(r"\p{M}+")
LINKS = r"(?:и|или|та|і|й|або|чи|and|or|to|und|oder|bis|et|ou)\b"
CUTS = [regex.compile(r"(?<=\p{L})[-‐‑¬\xad][^\S\n]*\r?\n\s*(?=\p{Ll})"), regex.compile(rf"(?<=\p{{L}})[-‐‑¬\xad]\s+(?=\p{{Ll}})(?!{LINKS})")]
HYPHEN = regex.compile(r"[-‐‑¬\xad]\s")
#: Words whose form a worker keeps; beyond it starts afresh, with the same results.
KEPT = 300_000


def plain(word: str) -> str:
    """Equal for words that differ in letter case, look-alike characters or ё/е only."""
    return skeleton(word.lower().replace("ё", "е").replace("ë", "e")).lower().replace("ё", "e").replace("ë", "e")


def readings(text: str) -> list[list[str]]:
    """The words; once more with the words that a line end cuts put together, where there are any."""
    if ODD.search(text):
        text = unicodedata.normalize("NFC", text)
        cuts = [c.sub("", text) for c in CUTS if c.search(text)] if HYPHEN.search(text) else []
        each = [MARKS.sub("", INVISIBLE_MARKS.sub("", t)) for t in dict.fromkeys([text, *cuts])]
    else:
        each = [*dict.fromkeys([text, *(c.sub("", text) for c in CUTS)])] if HYPHEN.search(text) else [text]
    return [WORDS(t) for t in each]


class WaveletMatrix:
    """Ranks of symbols below 2^bits: one bit vector a level, with counts of ones before each place."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.ones, self.zeros, self.bits = [], [], bits
        for level in range(bits - 1, -1, -1):
            bit = (values >> level) & 1
            self.ones.append(np.append(np.int32(0), np.cumsum(bit, dtype=np.int32)))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first at values; both are arrays."""
        lo, hi = np.zeros_like(at), at
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            one = ((symbol >> level) & 1).astype(bool)
            a, b = self.ones[k][lo], self.ones[k][hi]
            lo, hi = np.where(one, self.zeros[k] + a, lo - a), np.where(one, self.zeros[k] + b, hi - b)
        return hi - lo

    def access(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for k in range(self.bits):
            a = self.ones[k][at]
            one = self.ones[k][at + 1] > a
            out, at = out * 2 + one, np.where(one, self.zeros[k] + a, at - a)
        return out


def suffix_array(codes: np.ndarray, symbols: int) -> np.ndarray:
    """Prefix doubling; from the second round on, only suffixes that still tie are sorted. A suffix that ends is the smaller."""
    n, bits = len(codes), max(1, int(symbols).bit_length())
    key, width = np.zeros(n, np.int64), 62 // bits
    for k in range(width):
        key <<= bits
        key[: n - k] |= codes[k:] + 1
    order = np.argsort(key)
    ordered = key[order]
    starts = np.append(True, ordered[1:] != ordered[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(starts, np.arange(n), 0))  # a group's first place
    while True:
        size = np.bincount(rank, minlength=n)
        open_ = np.flatnonzero(size[rank] > 1)
        if not len(open_):
            break
        after = np.append(rank + 1, np.zeros(width, np.int64))[np.minimum(open_ + width, n)]
        key = rank[open_] * (n + 1) + after
        order = np.argsort(key)
        ordered, own = key[order], rank[open_[order]]
        place = np.arange(len(order))
        group = np.maximum.accumulate(np.where(np.append(True, own[1:] != own[:-1]), place, 0))
        part = np.maximum.accumulate(np.where(np.append(True, ordered[1:] != ordered[:-1]), place, 0))
        rank[open_[order]] = own + part - group
        width *= 2
    suffix = np.empty(n, np.int64)
    suffix[rank] = np.arange(n)
    return suffix


class FMIndex:
    """Index of a sequence of codes 0..symbols-1."""

    def __init__(self, codes: np.ndarray, symbols: int) -> None:
        codes, symbols = np.append(codes + 1, 0), symbols + 1  # 0 only at the end, so that the transform can be walked back
        self.n = len(codes)
        suffix = suffix_array(codes, symbols)
        last = codes[suffix - 1]
        self.before = np.append(0, np.cumsum(np.bincount(codes, minlength=symbols)))
        self.matrix = WaveletMatrix(last, max(1, int(symbols - 1).bit_length()))
        self.marked = np.append(np.int32(0), np.cumsum(suffix % SAMPLE == 0, dtype=np.int32))
        self.sampled = suffix[suffix % SAMPLE == 0]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each phrase; phrases is a matrix of codes, a phrase a row."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, k] + 1
            a, b = self.before[c] + self.matrix.rank(c, lo[live]), self.before[c] + self.matrix.rank(c, hi[live])
            lo[live], hi[live] = a, b
            live = live[a < b]
            if not len(live):
                break
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of the given suffixes: back, word by word, to a sampled one."""
        out, steps, open_ = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(open_):
            at = rows[open_]
            known = self.marked[at + 1] > self.marked[at]
            out[open_[known]] = self.sampled[self.marked[at[known]]] + steps
            open_ = open_[~known]
            at = rows[open_]
            c = self.matrix.access(at)
            rows[open_] = self.before[c] + self.matrix.rank(c, at)
            steps += 1
        return out


class Items:
    """The items' words and all their runs of RUN words."""

    def __init__(self, items: list[tuple[int, str | None]]) -> None:
        self.code: dict[str, int] = {}
        runs: dict[tuple[int, ...], set[int]] = {}
        for item, text in items:
            for words in readings(text) if text else ():
                codes = [self.code.setdefault(plain(w), len(self.code) + 1) for w in words]
                for k in range(len(codes) - RUN + 1):
                    runs.setdefault(tuple(codes[k : k + RUN]), set()).add(item)
        self.phrases = np.array([*runs], np.int64).reshape(-1, RUN)
        self.items = [sorted(x) for x in runs.values()]
        self.kept: dict[str, int] = {}

    def codes(self, words: list[str]) -> list[int]:
        kept = self.kept
        if len(kept) > KEPT:
            kept.clear()
        try:
            return [kept[w] for w in words]
        except KeyError:
            for w in set(words).difference(kept):
                kept[w] = self.code.get(plain(w), 0)
            return [kept[w] for w in words]

    def spans(self, docs: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int]]:
        """(document, item, first word, words) for each span of a shard; docs are keys with the codes of a reading, which ends with 0."""
        starts = np.cumsum([0, *(len(c) for _, c in docs)])
        whole = np.fromiter(chain.from_iterable(c for _, c in docs), np.int64, int(starts[-1]))
        edge = np.flatnonzero(np.diff(np.append(0, whole > 0), append=0))
        begin, end = edge[::2], edge[1::2]
        long = end - begin >= RUN
        begin, end = begin[long], end[long] + 1  # with the 0 that ends the segment
        if not len(begin) or not len(self.phrases):
            return []
        at = np.arange(int((end - begin).sum())) + np.repeat(begin - np.append(0, np.cumsum(end - begin)[:-1]), end - begin)
        index = FMIndex(whole[at], len(self.code) + 1)
        lo, hi = index.search(self.phrases)
        found = np.flatnonzero(lo < hi)
        which = np.repeat(found, hi[found] - lo[found])
        rows = np.concatenate([np.arange(lo[k], hi[k]) for k in found]) if len(found) else np.zeros(0, np.int64)
        places = at[index.locate(rows)]
        doc = np.searchsorted(starts, places, side="right") - 1
        hits = sorted((d, i, int(p - starts[d])) for w, d, p in zip(which.tolist(), doc.tolist(), places.tolist()) for i in self.items[w])
        out: list[list[int]] = []
        for d, i, p in hits:
            if out and out[-1][0] == d and out[-1][1] == i and p <= out[-1][2] + out[-1][3]:
                out[-1][3] = max(out[-1][3], p + RUN - out[-1][2])
            else:
                out.append([d, i, p, RUN])
        return [(docs[d][0], i, p, n) for d, i, p, n in out]


_items: dict[int, Items] = {}


def spans(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, word, words): each span of a document that is made of runs of RUN or more consecutive words of an item.

    Null and short texts share nothing; every copy of a document and every item with a passage counts. Spans of a document's reading with
    cut words joined come beside those of the plain reading, with places in that reading.
    """
    ship(documents.sparkSession)
    held = sorted((r[0], r[1]) for r in items.select(item, item_text).where(F.col(item).isNotNull() & F.col(item_text).isNotNull()).distinct().collect())
    shared = documents.sparkSession.sparkContext.broadcast(held)
    schema = pa.schema([("doc_id", LONG), ("item_id", LONG), ("word", INT), ("words", INT)])

    def make():
        mark = hash(tuple(shared.value))
        one = _items.get(mark)
        if one is None:
            _items.clear()
            one = _items[mark] = Items(shared.value)

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            rows, docs, size = [], [], 0
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for words in readings(t):
                    if len(words) >= RUN:
                        docs.append((k, [*one.codes(words), 0]))
                        size += len(words) + 1
                if size >= SHARD_WORDS:
                    rows += one.spans(docs)
                    docs, size = [], 0
            if docs:
                rows += one.spans(docs)
            return rows_batch(schema, rows)

        return f

    return map_batches(documents.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).cast("bigint"), F.col(text).cast("string")), make, schema)


def p9_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(read(spark, sf_dir, "documents"), read(spark, sf_dir, "eval_items"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_spans(spark, sf_dir).select("doc_id", "item_id").distinct()
