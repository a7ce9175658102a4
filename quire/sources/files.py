"""Files in and out: raw books, JSON lines, chunk texts, routed lists."""

from __future__ import annotations

import gzip

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SENTENCE = "book_id string, text string, position int, created_at timestamp"
#: Encodings that are tried in order on bytes that aren't UTF-8; the first whose letters are mostly Cyrillic in lower case is taken, else the first.
ENCODINGS = ("cp1251", "koi8-r")


def decode(raw: bytes | None) -> str | None:
    """Text of bytes, unpacked if they are gzipped: UTF-8 where they are, else by ENCODINGS. Marks of byte order at its beginning go."""
    if raw is None:
        return None
    if raw[:2] == b"\x1f\x8b":
        raw = gzip.decompress(raw)
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        small = lambda t: sum("а" <= c <= "я" for c in t) - sum("А" <= c <= "Я" for c in t)
        text = max((raw.decode(e, "replace") for e in ENCODINGS), key=small)
    return text.lstrip("﻿￾")


def books(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, text) of all .txt and .txt.gz files below a directory."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{txt,txt.gz}").load(path)
    text = F.pandas_udf(lambda s: s.map(decode), "string")
    return files.select(F.col("path").alias("source_file"), text("content").alias("text"))


def sentences_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of sentences, packed or not; malformed rows and rows without a text are left out."""
    rows = spark.read.schema(SENTENCE + ", _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.where("text is not null").select("book_id", "text", "position", "created_at")


def split_sentences(text: Column) -> Column:
    """Sentences by end signs before a blank and a capital, a quotation mark or a dash; a documented rule, not a trained segmenter."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?…][»”\"]?)\s+(?=[\p{Lu}«„“\"—–-])|\n+"), F.trim), lambda x: x != "")


def write_chunks(chunks: DataFrame, path: str) -> None:
    """A chunk a line, a directory for each split."""
    chunks.select("split", F.col("text").alias("value")).write.partitionBy("split").mode("overwrite").text(path)


def write_removed(removed: DataFrame, path: str) -> None:
    removed.select("text", "reason").write.mode("overwrite").json(path)


def write_decisions(decisions: DataFrame, path: str) -> None:
    decisions.write.partitionBy("decision").mode("overwrite").json(path)


def write_table(rows: DataFrame, path: str, separator: str = ",") -> None:
    """CSV with a header; fields with the separator, quotes or line ends are quoted."""
    rows.write.mode("overwrite").option("header", "true").option("sep", separator).option("escape", '"').csv(path)
