"""Documents and their files: the cleaning chain, character filters, metadata in file names, ids, the decision on books."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import fixed as X
from quire.functions import re2
from quire.functions import text as T
from quire.functions.re2 import sql_matches, sql_replace
from quire.sources.tables import read, spread

#: A book is removed from this share of garbage on, kept up to that one if its mean perplexity is below the bound. Fixed values.
REMOVE, KEEP, PERPLEXITY = 0.7, 0.1, 500.0


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text"))


def doc_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document cleaned; one that is blank then is left out, as a book is."""
    return T.with_text(T.clean_document(_documents(spark, sf_dir), "text"), F.col("text"), "doc_id")


def cjk_thai_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    has = re2.matches(F.col("text"), X.CJK_THAI)
    return _documents(spark, sf_dir).select("doc_id", has.alias("had"), F.when(has, re2.replace(F.col("text"), X.CJK_THAI)).otherwise(F.col("text")).alias("text"))


def acceptable_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", re2.replace(F.col("text"), X.NOT_ACCEPTABLE).alias("text"))


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genre, author and title of a file name: <genre>_<author> — <title>; without the dash the name is the title."""
    name = F.regexp_replace(F.regexp_extract("source_file", "([^/]*)$", 1), r"\.txt(\.gz)?\z", "")
    rows = read(spark, sf_dir, "books_meta").where("source_file is not null").select("source_file", name.alias("name"))
    dash = F.instr("name", " — ")
    left, right = F.expr("substr(name, 1, instr(name, ' — ') - 1)"), F.expr("substr(name, instr(name, ' — ') + 3)")
    rows = rows.select("source_file", F.when(dash > 0, left).alias("left"), F.when(dash > 0, right).otherwise(F.col("name")).alias("title"))
    under = F.instr("left", "_")
    return rows.select(
        "source_file", F.when(under > 0, F.expr("substr(left, 1, instr(left, '_') - 1)")).otherwise("").alias("genre"),
        F.when(under > 0, F.expr("substr(left, instr(left, '_') + 1)")).otherwise(F.coalesce("left", F.lit("Unknown"))).alias("author"), "title",
    )


def filename_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir)


def book_id_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id of a book: 16 hex digits of a hash of its path without endings, title and author."""
    path = F.regexp_replace(F.regexp_replace(F.lower("source_file"), r"\.gz\z", ""), r"\.txt\z", "")
    return _named(spark, sf_dir).select("source_file", F.substring(F.sha2(F.concat_ws("|", path, "title", "author"), 256), 1, 16).alias("book_id"))


def book_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """remove, keep or review for each reviewed book; a missing figure is for review."""
    g, a = F.col("garbage_ratio"), F.col("avg_perplexity")
    decision = F.when((F.col("sentences") == 0) | (g >= REMOVE), "remove").when((g <= KEEP) & (a < PERPLEXITY), "keep").otherwise("review")
    return read(spark, sf_dir, "perplexity_review").select(F.regexp_replace("file", r"\.jsonl\z", "").alias("book_id"), decision.alias("decision"))


def removed_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "removed_sentences").groupBy(F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col("text"), F.lit("")) == "").alias("empty"))


QUERIES = {f.__name__: f for f in (doc_clean_text, cjk_thai_filter, acceptable_chars, filename_metadata, book_id_hash, book_decision, removed_reasons)}
_DOCS = "documents where text is not null"
_NAMED = r"""(select source_file, case when u > 0 then "left"[1:u - 1] else '' end as genre, case when u > 0 then "left"[u + 1:] else coalesce("left", 'Unknown') end as author, title from
    (select *, coalesce(instr("left", '_'), 0) as u from (select source_file, case when d > 0 then name[1:d - 1] end as "left", case when d > 0 then name[d + 3:] else name end as title from
    (select *, instr(name, ' — ') as d from (select source_file, regexp_replace(regexp_extract(source_file, '([^/]*)$', 1), '\.txt(\.gz)?$', '') as name from books_meta where source_file is not null)))))"""
SQL = {
    "doc_clean_text": f"select * from ({T.sql_clean_document('text', _DOCS, 'doc_id')}) where text <> ''",
    "cjk_thai_filter": f"select doc_id, {sql_matches('text', X.CJK_THAI)} as had, {sql_replace('text', X.CJK_THAI)} as text from {_DOCS}",
    "acceptable_chars": f"select doc_id, {sql_replace('text', X.NOT_ACCEPTABLE)} as text from {_DOCS}",
    "filename_metadata": f"select * from {_NAMED}",
    "book_id_hash": rf"select source_file, sha256(concat_ws('|', regexp_replace(regexp_replace(lower(source_file), '\.gz$', ''), '\.txt$', ''), title, author))[1:16] as book_id from {_NAMED}",
    "book_decision": rf"""select regexp_replace(file, '\.jsonl$', '') as book_id, case when sentences = 0 or garbage_ratio >= {REMOVE} then 'remove' when garbage_ratio <= {KEEP} and avg_perplexity < {PERPLEXITY} then 'keep'
        else 'review' end as decision from perplexity_review""",
    "removed_reasons": "select coalesce(reason, '') as reason, count(*) as n, count(*) filter (coalesce(text, '') = '') as empty from removed_sentences group by 1",
}
