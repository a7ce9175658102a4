"""Problem 8: token ids under a public byte-level BPE vocabulary.

Two tiers. A minimal perfect hash over the vocabulary finds the pre-tokens that are tokens themselves; the others are merged,
lowest rank first, by a heap over linked bytes. The vocabulary is read on the driver and broadcast: its size is fixed (50,256 entries).
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession

from quire.session import ship
from quire.sources.arrow import INT, LONG, batch, map_batches
from quire.sources.tables import read

#: White space as Unicode has it, written out so that every regular-expression dialect reads it alike. Fixed values.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The tokenizer's own pre-splitting pattern with that class.
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Pieces whose ids a worker keeps; beyond it starts afresh, with the same results.
KEPT = 400_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def vocabulary(name: str = "byte_bpe_50k", path: str | None = None) -> list[bytes]:
    """Tokens by id, from a rank file; path overrides the installed file of that name."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(f"{name}.tiktoken")
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in f if line.strip())}
    return [ranks[i] for i in range(len(ranks))]


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash: n keys to the slots 0..n-1, one displacement for each bucket of about two keys."""

    def __init__(self, keys: list[bytes]) -> None:
        if len(set(keys)) < len(keys):
            raise ValueError("keys repeat")
        self.n, self.buckets = len(keys), max(1, len(keys) // 2)
        h = self.hashes(keys)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        self.move = np.zeros(self.buckets, np.int64)
        self.slot_key = np.full(self.n, -1, np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for b in np.argsort(starts[:-1] - starts[1:], kind="stable"):  # the largest buckets first
            own = order[starts[b] : starts[b + 1]]
            if len(own) == 1:
                break
            self.move[b], at = self._place(h[own])
            self.slot_key[at] = own
        free = iter(np.flatnonzero(self.slot_key < 0).tolist())
        for b in np.flatnonzero(np.diff(starts) == 1):  # a bucket of one names its slot
            slot = next(free)
            self.move[b], self.slot_key[slot] = -slot - 1, order[starts[b]]

    def _place(self, h: np.ndarray) -> tuple[int, np.ndarray]:
        """The first displacement that puts the keys of a bucket on slots of their own."""
        first = 0
        while True:
            tries = np.arange(first, first + 32, dtype=np.uint64)
            at = self._slots(h[None, :], tries[:, None])
            for k in np.flatnonzero((self.slot_key[at] < 0).all(axis=1)):
                if len(set(at[k].tolist())) == len(h):
                    return first + int(k), at[k]
            first += 32

    @staticmethod
    def hashes(keys: Iterable[bytes]) -> np.ndarray:
        return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64)

    def _slots(self, h: np.ndarray, move: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (_mix(h + move * _GOLD) % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The number of the only key that each may be equal to; the caller compares."""
        h = self.hashes(keys)
        move = self.move[(h % np.uint64(self.buckets)).astype(np.int64)]
        slot = np.where(move < 0, -move - 1, self._slots(h, np.maximum(move, 0).astype(np.uint64)))
        return self.slot_key[slot]


class Encoder:
    """Ids of texts under a vocabulary; ids of pieces are kept, as texts repeat their words."""

    def __init__(self, tokens: list[bytes], whole: PerfectHash | None = None) -> None:
        self.tokens = tokens
        self.whole = whole or PerfectHash(tokens)
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.split = regex.compile(PATTERN).findall
        self.kept: dict[str, bytes] = {}

    def merged(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost first among equals: a heap of pairs over bytes linked to their neighbours."""
        n, rank = len(piece), self.rank
        end, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, k = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != k:  # one of the two has gone into another token
                continue
            end[i], end[j] = k, 0
            if k < n:
                before[k] = i
                if (r := rank.get(piece[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if (h := before[i]) >= 0 and (r := rank.get(piece[h:k])) is not None:
                heapq.heappush(heap, (r, h, k))
        out, i = [], 0
        while i < n:
            out.append(rank[piece[i : end[i]]])
            i = end[i]
        return out

    def learn(self, pieces: list[str]) -> None:
        raw = [p.encode("utf-8", "replace") for p in pieces]
        for piece, b, k in zip(pieces, raw, self.whole.find(raw).tolist()):
            self.kept[piece] = np.array([k] if self.tokens[k] == b else self.merged(b), np.int32).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as int32, one after the other; none for an empty or null text."""
        if len(self.kept) > KEPT:
            self.kept.clear()
        split = [self.split(t) if t else () for t in texts]
        if new := [*set().union(*split).difference(self.kept)]:
            self.learn(new)
        get = self.kept.__getitem__
        return [b"".join(map(get, pieces)) for pieces in split]


_encoders: dict[int, Encoder] = {}


def encode(texts: DataFrame, tokens: list[bytes] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>): the ids of every text without special tokens, whose strings are ordinary text.

    An empty or null text has an empty list, as has every text of a row that is repeated; null keys stay. Other columns are left out.
    """
    ship(texts.sparkSession)
    tokens = tokens or vocabulary()
    shared = texts.sparkSession.sparkContext.broadcast((tokens, PerfectHash(tokens)))
    key_type = LONG if dict(texts.dtypes)[key] == "bigint" else pa.string()
    schema = pa.schema([(key, key_type), ("ids", pa.list_(INT))])

    def make():
        tokens, whole = shared.value
        if (one := _encoders.get(len(tokens))) is None or one.tokens != tokens:
            one = _encoders[len(tokens)] = Encoder(tokens, whole)

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            raw = one.encode(b.column(1).to_pylist())
            offsets = np.cumsum([0, *(len(x) // 4 for x in raw)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(raw), np.int32)))
            return batch(schema, [b.column(0), ids])

        return f

    return map_batches(texts.select(texts[key].cast("bigint" if key_type == LONG else "string").alias(key), texts[text].alias("text")), make, schema)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents"))
