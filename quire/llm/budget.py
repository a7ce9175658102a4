"""Problem 4: tokens in each slice of source, language and genre, by merges done as joins.

Texts are pre-split in the JVM and counted by slice and piece. The distinct pieces become arrays of symbols; round after round, their
adjacent pairs are joined with the table of merges (a sorted array, met by binary search) and each piece's lowest-ranked merge is
applied, until no pair of any piece can merge. Pieces don't depend on each other, so every partition converges by itself. A piece's
tokens are its symbols then; a piece travels with its counts by slice, and tokens times counts give the totals. Only the table of merges is broadcast, which the vocabulary bounds
(50,256 tokens, about two merges each).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.bpe import PATTERN, vocabulary
from quire.llm.languages import code_of
from quire.session import ship
from quire.sources.arrow import LONG, TEXT, batch, map_batches
from quire.sources.tables import read, records

_SHIFT = 21  # ids stay below 2^21


def merges(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every way to make a token of two: the pairs in order, and what each becomes. A token's id is its rank."""
    rank = {t: i for i, t in enumerate(tokens)}
    rows = np.array([(rank[t[:k]] << _SHIFT | rank[t[k:]], i) for t, i in rank.items() for k in range(1, len(t)) if t[:k] in rank and t[k:] in rank], np.int64)
    rows = rows[np.argsort(rows[:, 0])]
    return rows[:, 0].copy(), rows[:, 1].copy()


def converge(syms: np.ndarray, owner: np.ndarray, pairs: np.ndarray, made: np.ndarray) -> np.ndarray:
    """Symbols left of each owner (0, 1, ... in order) once no pair can merge; syms and owner are arrays of one length."""
    counts = np.zeros(owner[-1] + 1 if len(owner) else 0, np.int64)
    none = np.int64(1 << 62)
    while len(syms):
        pair = syms[:-1] << _SHIFT | syms[1:]
        at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
        rank = np.append(np.where((pairs[at] == pair) & (owner[:-1] == owner[1:]), made[at], none), none)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        length = np.diff(np.append(starts, len(syms)))
        best = np.minimum.reduceat(rank, starts)
        over = best == none
        counts[owner[starts[over]]] = length[over]
        hit = (rank == np.repeat(best, length)) & (rank != none)
        first = hit & ~np.append(False, hit[:-1])  # of hits in a row, as in aaa, every other one is a merge
        place = np.arange(len(hit))
        hit &= (place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0
        syms = np.where(hit, rank, syms)
        keep = ~np.append(False, hit[:-1]) & np.repeat(~over, length)
        syms, owner = syms[keep], owner[keep]
    return counts


def slice_tokens(pieces: DataFrame, tokens: list[bytes] | None = None) -> DataFrame:
    """(slice, tokens), several rows a slice, of distinct non-null pieces (piece, slices, counts): a piece's slices and how often each has it."""
    ship(pieces.sparkSession)
    tokens = tokens or vocabulary()
    shared = pieces.sparkSession.sparkContext.broadcast((np.array([i for _, i in sorted((t[0], i) for i, t in enumerate(tokens) if len(t) == 1)], np.int64), *merges(tokens)))
    schema = pa.schema([("slice", LONG), ("tokens", LONG)])

    def make():
        of_byte, pairs, made = shared.value

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            raw = [p.encode() for p in b.column(0).to_pylist()]
            syms = of_byte[np.frombuffer(b"".join(raw), np.uint8)]
            owner = np.repeat(np.arange(len(raw)), [len(x) for x in raw])
            counts = np.zeros(len(raw), np.int64)
            made_of = converge(syms, owner, pairs, made)
            counts[: len(made_of)] = made_of
            slices, n = (b.column(k).flatten().to_numpy() for k in (1, 2))
            n = n * np.repeat(counts, b.column(1).value_lengths().to_numpy())
            order = np.argsort(slices, kind="stable")
            slices = slices[order]
            starts = np.flatnonzero(np.append(True, slices[1:] != slices[:-1]))
            return batch(schema, [pa.array(slices[starts]), pa.array(np.add.reduceat(n[order], starts))])

        return f

    return map_batches(pieces.select("piece", "slices", "counts"), make, schema)


def totals(texts: DataFrame, slices: list[str], text: str = "text", tokens: list[bytes] | None = None) -> DataFrame:
    """(*slices, records, tokens): rows and tokens of each slice; null is a slice of its own, a null or empty text has no tokens.

    Each row counts; a caller that wants each record once hands each over once. A slice travels as the 64-bit hash of its columns.
    """
    rows = texts.select(F.xxhash64(*(x for c in slices for x in (F.col(c), F.col(c).isNull()))).alias("slice"), *slices, F.col(text).alias("text"))
    split = F.explode(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    counted = rows.select("slice", split.alias("piece")).groupBy("slice", "piece").agg(F.count("*").alias("n"))
    pieces = counted.groupBy("piece").agg(F.collect_list("slice").alias("slices"), F.collect_list("n").alias("counts"))  # in one order; neither is ever null
    tokens_of = slice_tokens(pieces, tokens).groupBy("slice").agg(F.sum("tokens").alias("tokens"))
    named = rows.groupBy("slice", *slices).agg(F.count("*").alias("records"))
    return named.join(tokens_of, "slice", "left").select(*slices, "records", F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"))


def sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(of, source, language, genre, text): every record of sentences, once, and every document."""
    genre = F.nullif(F.lower(F.trim("genre")), F.lit(""))
    meta = read(spark, sf_dir, "books_meta").groupBy("book_id").agg(
        F.min(F.nullif(F.regexp_extract("source_file", "data/raw/([^/]+)/", 1), F.lit(""))).alias("source"), F.min(genre).alias("genre")
    )
    index = read(spark, sf_dir, "book_index").groupBy("book_id").agg(F.min(code_of(F.col("language"))).alias("language"))
    books = meta.join(index, "book_id", "full_outer")
    own = records(spark, sf_dir).join(books, "book_id", "left").select(F.lit("sentences").alias("of"), "source", "language", "genre", "text")
    docs = read(spark, sf_dir, "documents").select(F.lit("documents").alias("of"), F.nullif("source", F.lit("")).alias("source"), code_of(F.col("lang")).alias("language"), genre.alias("genre"), "text")
    return own.unionByName(docs)


def p4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(sliced(spark, sf_dir), ["of", "source", "language", "genre"])
