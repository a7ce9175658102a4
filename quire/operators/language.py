"""Languages of books by their letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import fixed as X
from quire.functions import re2
from quire.functions.re2 import sql_count
from quire.operators.ordered import numbered
from quire.operators.sentence import RECORDS
from quire.sources.tables import records

#: Rows of a book that the sampled variants read.
SAMPLE, FIRST = 50, 100


def letters(t: Column) -> tuple[Column, Column]:
    return re2.count(t, X.CYRILLIC_LETTER), re2.count(t, X.LATIN_LETTER)


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    cyr, lat = letters(F.coalesce("text", F.lit("")))
    return records(spark, sf_dir).select("book_id", "position", cyr.cast("bigint").alias("cyr"), lat.cast("bigint").alias("lat"))


def _indexed(rows: DataFrame) -> DataFrame:
    per = rows.groupBy("book_id").agg(F.count("*").alias("total_lines"), F.sum("cyr").alias("cyr"), F.sum("lat").alias("lat"))
    whole = F.col("cyr") + F.col("lat") + 1
    c, l = F.col("cyr") / whole, F.col("lat") / whole
    return per.select("book_id", "total_lines", F.when(c > 0.85, "ru").when(l > 0.85, "en").otherwise("mixed").alias("language"), F.round(c, 4).alias("cyrillic_ratio"), F.round(l, 4).alias("latin_ratio"))


def book_language_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each book's letters of both scripts; every record counts as a line."""
    return _indexed(_counted(spark, sf_dir))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records numbered in their book, with the book's number of records."""
    rows = numbered(_counted(spark, sf_dir), "book_id", "position", "line")
    return rows.join(rows.groupBy("book_id").agg(F.count("*").alias("total")), "book_id")


def book_language_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index from every step-th record, SAMPLE of them at most."""
    rows = _lines(spark, sf_dir).withColumn("step", F.greatest(F.floor(F.col("total") / SAMPLE), F.lit(1)))
    return _indexed(rows.where(f"line % step = 0 and line div step < {SAMPLE}"))


def book_language_first100(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language by the first FIRST records; a book without letters is taken for English."""
    per = _lines(spark, sf_dir).where(f"line < {FIRST}").groupBy("book_id").agg(F.max("total").alias("total_lines"), F.sum("cyr").alias("cyr"), F.sum("lat").alias("lat"))
    c = F.col("cyr") / (F.col("cyr") + F.col("lat") + 1)
    return per.select("book_id", "total_lines", F.when(c > 0.85, "ru").when(c < 0.15, "en").otherwise("mixed").alias("language"))


def language_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = book_language_index(spark, sf_dir).groupBy("language").agg(F.count("*").alias("books"), F.sum("total_lines").alias("lines"))
    total = per.agg(F.sum("lines").alias("all"))  # one row
    return per.join(F.broadcast(total)).select("language", "books", "lines", F.round(100 * F.col("lines") / F.col("all"), 4).alias("percent"))


def sentence_dominance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by the script that has more than five times the letters of the other."""
    kind = F.when(F.expr("cyr > 5 * lat"), "ru").when(F.expr("lat > 5 * cyr"), "en").otherwise("mixed")
    return _counted(spark, sf_dir).groupBy(kind.alias("language")).agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (book_language_index, book_language_sampled, book_language_first100, language_distribution, sentence_dominance)}
_COUNTED = f"""(select book_id, position, {sql_count("coalesce(text, '')", X.CYRILLIC_LETTER)}::bigint as cyr, {sql_count("coalesce(text, '')", X.LATIN_LETTER)}::bigint as lat from {RECORDS})"""
_LINES = f"(select *, row_number() over (partition by book_id order by position) - 1 as line, count(*) over (partition by book_id) as total from {_COUNTED})"
_index = lambda rows: f"""select book_id, total_lines, case when c > 0.85 then 'ru' when l > 0.85 then 'en' else 'mixed' end as language, round(c, 4) as cyrillic_ratio, round(l, 4) as latin_ratio from
    (select book_id, count(*) as total_lines, sum(cyr)::double / (sum(cyr) + sum(lat) + 1) as c, sum(lat)::double / (sum(cyr) + sum(lat) + 1) as l from {rows} group by 1)"""  # noqa: E731
SQL = {
    "book_language_index": _index(_COUNTED),
    "book_language_sampled": _index(f"(select * from (select *, greatest(total // {SAMPLE}, 1) as step from {_LINES}) where line % step = 0 and line // step < {SAMPLE})"),
    "book_language_first100": f"""select book_id, total_lines, case when c > 0.85 then 'ru' when c < 0.15 then 'en' else 'mixed' end as language from
        (select book_id, max(total) as total_lines, sum(cyr)::double / (sum(cyr) + sum(lat) + 1) as c from {_LINES} where line < {FIRST} group by 1)""",
    "language_distribution": f"select language, count(*) as books, sum(total_lines)::bigint as lines, round(100 * sum(total_lines) / sum(sum(total_lines)) over (), 4)::double as percent from ({_index(_COUNTED)}) group by 1",
    "sentence_dominance": f"select case when cyr > 5 * lat then 'ru' when lat > 5 * cyr then 'en' else 'mixed' end as language, count(*) as n from {_COUNTED} group by 1",
}
