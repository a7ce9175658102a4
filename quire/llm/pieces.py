"""Problem 5: texts above a limit, cut at natural boundaries into pieces that overlap.

A hierarchy of separators: sections, paragraphs, sentences, words, characters. A span that is too large is divided by the first
separator that divides it, its parts by the next, until every span fits; then spans are packed greedily, each piece beginning with
the end of the piece before it.
"""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.arrow import INT, TEXT, map_batches, rows_batch
from quire.sources.tables import deliveries

LIMIT, SHARED = 2000, 200
#: A part ends where a separator ends; what they are, largest parts first.
SEPARATORS = [regex.compile(p) for p in (r"\n\s*\n\s*\n|\f", r"\n\s*\n", r"[.!?…]+[\"'»”)\]]*(?:\s+|$)|\n", r"\s+")]


def _spans(text: str, start: int, end: int, most: int, level: int) -> list[int]:
    """Ends of the spans of text[start:end], none above most."""
    if end - start <= most:
        return [end]
    if level == len(SEPARATORS):
        return [*range(start + most, end, most), end]
    ends = [m.end() for m in SEPARATORS[level].finditer(text, start, end)]
    out: list[int] = []
    for e in [*(e for e in ends if start < e < end), end]:
        begin = out[-1] if out else start
        out += _spans(text, begin, e, most, level + 1)
    return out


def pieces(text: str, limit: int = LIMIT, shared: int = SHARED) -> list[str]:
    """Pieces of the text in order, each a part of it of at most limit characters; one that fits is its only piece.

    A piece begins with the last characters of the one before, shared at most, from a word's beginning where there is one in the first quarter
    of them. Without these beginnings the pieces are the text.
    """
    if not 0 <= shared < limit:
        raise ValueError("the overlap must be below the limit")
    if len(text) <= limit:
        return [text]
    ends = _spans(text, 0, len(text), limit - shared, 0)
    out, start, end = [], 0, 0
    for k, e in enumerate(ends):
        if e - start > limit:
            out.append(text[start:end])
            start = end - shared
            if shared and (m := regex.compile(r"(?<=\s)\S").search(text, start, start + max(1, shared // 4))):
                start = m.start()
        end = e
    return [*out, text[start:end]]


def split_oversized(texts: DataFrame, keys: list[str], text: str = "text", limit: int = LIMIT, shared: int = SHARED) -> DataFrame:
    """(*keys, piece, pieces, text) for each row whose text is above the limit; keys are strings or whole numbers.

    A null, empty or short text has no row; of rows with equal keys and text one counts.
    """
    types = dict(texts.dtypes)
    schema = pa.schema([*((k, {"string": TEXT, "int": INT}.get(types[k], pa.int64())) for k in keys), ("piece", INT), ("pieces", INT), ("text", TEXT)])
    long = texts.where(F.length(text) > limit).select(*keys, F.col(text).alias("text")).dropDuplicates()

    def make():
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for *key, t in zip(*(c.to_pylist() for c in b.columns)):
                parts = pieces(t, limit, shared)
                rows += [(*key, k, len(parts), p) for k, p in enumerate(parts)]
            return rows_batch(schema, rows)

        return f

    return map_batches(long, make, schema)


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_oversized(deliveries(spark, sf_dir), ["book_id", "position"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_pieces(spark, sf_dir).where("pieces > 1").select("book_id", "position").distinct()
