"""Samples and splits, all decided by hashes that DuckDB has too, and none by a sort of all rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import language
from quire.operators.ordered import numbered, ranked_by_hash
from quire.operators.sentence import RECORDS
from quire.sources.tables import records

SEED = 42
#: Sizes of the exact samples, sentences a book of the systematic one, their least length, quotas of the stratified one, share of validation (0.02 of 2^32, in hex).
SAMPLE, TEST, PER_BOOK, LEAST, TOTAL, RU, EN, VALIDATION = 2000, 500, 5, 30, 1000, 0.5, 0.3, "051eb852"


def hash_of(*columns: str) -> Column:
    return F.sha2(F.concat_ws("|", *(F.col(c).cast("string") for c in columns), F.lit(str(SEED))), 256)


def sql_hash_of(*columns: str) -> str:
    return f"sha256(concat_ws('|', {', '.join(f'{c}::varchar' for c in columns)}, '{SEED}'))"


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).where("text <> ''").select("book_id", "position")


def disjoint_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly SAMPLE records and TEST others, or as many as there are."""
    rows = ranked_by_hash(_keys(spark, sf_dir), hash_of("book_id", "position"), SAMPLE + TEST)
    return rows.select("book_id", "position", F.when(F.col("rank") <= SAMPLE, "sample").otherwise("test").alias("part"))


def train_val_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.substring(hash_of("book_id", "position"), 1, 8) < VALIDATION
    return _keys(spark, sf_dir).select("book_id", "position", F.when(held, "val").otherwise("train").alias("split"))


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("book_id").distinct()


def book_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books in the order of their hashes: 2.5 % for validation, then 2.5 % for test, the rest before them for training; of fewer than ten, one each for these if there are so many."""
    books = _books(spark, sf_dir)
    n = books.count()
    part = n * 25 // 1000
    train = n - 2 * part if n >= 10 else max(1, n - 2)
    val = part if n >= 10 else min(1, n - train)
    rows = ranked_by_hash(books, hash_of("book_id"), n)
    return rows.select("book_id", F.when(F.col("rank") <= train, "train").when(F.col("rank") <= train + val, "validation").otherwise("test").alias("split"))


def phase_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirds of the books in their order; what doesn't divide goes to the last."""
    books = _books(spark, sf_dir)
    n = books.count()
    rank = F.col("rank")
    rows = ranked_by_hash(books, F.col("book_id"), n)
    return rows.select("book_id", F.when(rank <= n // 3, 1).when(rank <= n // 3 * 2, 2).otherwise(3).alias("phase"))


def _systematic(rows: DataFrame) -> DataFrame:
    """rows have book_id, position, text, want: every step-th record of a book, and its records up to the first that will do, until want of them do."""
    lines = numbered(rows, "book_id", "position", "line")
    good = F.length("text") >= LEAST
    per = lines.groupBy("book_id").agg(F.count("*").alias("total"), F.min(F.when(good, F.col("line"))).alias("first"))
    step = F.greatest(F.floor(F.col("total") / F.least(3 * F.col("want"), F.col("total"))), F.lit(1))
    chosen = lines.where("want > 0").join(per, "book_id").where(good & ((F.col("line") == F.col("first")) | (F.col("line") % step == 0)))
    return numbered(chosen.drop("total", "first"), "book_id", "line", "taken").where("taken < want").select("book_id", "position", "text")


def systematic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir).select("book_id", "position", T.collapse(F.coalesce("text", F.lit(""))).alias("text"), F.lit(PER_BOOK).alias("want"))
    return _systematic(rows)


def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotas by language, equal shares for its books, and a systematic sample of each; a language without books has none."""
    books = language.book_language_first100(spark, sf_dir).select("book_id", "language")
    quota = F.when(F.col("language") == "ru", int(TOTAL * RU)).when(F.col("language") == "en", int(TOTAL * EN)).otherwise(TOTAL - int(TOTAL * RU) - int(TOTAL * EN))
    each = books.groupBy("language").agg(F.count("*").alias("n")).select("language", F.floor(quota / F.col("n")).alias("want"))  # three rows
    wants = books.join(F.broadcast(each), "language")
    rows = records(spark, sf_dir).select("book_id", "position", T.collapse(F.coalesce("text", F.lit(""))).alias("text")).join(wants, "book_id")
    return _systematic(rows.drop("language")).join(wants.select("book_id", "language"), "book_id").select("language", "book_id", "position", "text")


def global_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records in the order of their hashes."""
    return _keys(spark, sf_dir).withColumn("h", hash_of("book_id", "position")).orderBy("h").select("book_id", "position")


QUERIES = {f.__name__: f for f in (disjoint_sample, train_val_split, book_split, phase_assignment, systematic_sample, stratified_sample, global_shuffle)}
_KEYS = f"(select book_id, position from {RECORDS} where text <> '')"
_BOOKS = "(select distinct book_id from sentences where book_id is not null and position is not null)"
_CLEAN = f"(select book_id, position, {T.sql_collapse("coalesce(text, '')")} as text from {RECORDS})"
_take = lambda rows: f"""select book_id, position, text from (select *, row_number() over (partition by book_id order by position) as taken from
    (select *, min(case when length(text) >= {LEAST} then line end) over (partition by book_id) as first from (select *, row_number() over (partition by book_id order by position) - 1 as line, count(*) over (partition by book_id) as total from {rows}))
    where want > 0 and length(text) >= {LEAST} and (line = first or line % greatest(total // least(3 * want, total), 1) = 0)) where taken <= want"""  # noqa: E731
_LANG = f"({language.SQL['book_language_first100']})"
_WANTS = f"""(select book_id, language, case language when 'ru' then {int(TOTAL * RU)} when 'en' then {int(TOTAL * EN)} else {TOTAL - int(TOTAL * RU) - int(TOTAL * EN)} end // count(*) over (partition by language) as want from {_LANG})"""
SQL = {
    "disjoint_sample": f"select book_id, position, case when r <= {SAMPLE} then 'sample' else 'test' end as part from (select *, row_number() over (order by {sql_hash_of('book_id', 'position')}) as r from {_KEYS}) where r <= {SAMPLE + TEST}",
    "train_val_split": f"select book_id, position, case when {sql_hash_of('book_id', 'position')}[1:8] < '{VALIDATION}' then 'val' else 'train' end as split from {_KEYS}",
    "book_split": f"""with b as (select book_id, row_number() over (order by {sql_hash_of('book_id')}) as r, count(*) over () as n from {_BOOKS}),
        s as (select *, case when n >= 10 then n - 2 * (n * 25 // 1000) else greatest(1, n - 2) end as train from b), v as (select *, case when n >= 10 then n * 25 // 1000 else least(1, n - train) end as val from s)
        select book_id, case when r <= train then 'train' when r <= train + val then 'validation' else 'test' end as split from v""",
    "phase_assignment": f"select book_id, case when r <= n // 3 then 1 when r <= n // 3 * 2 then 2 else 3 end as phase from (select book_id, row_number() over (order by book_id) as r, count(*) over () as n from {_BOOKS})",
    "systematic_sample": _take(f"(select *, {PER_BOOK} as want from {_CLEAN})"),
    "stratified_sample": f"select w.language, x.book_id, x.position, x.text from ({_take(f'(select c.*, w.want from {_CLEAN} c join {_WANTS} w using (book_id))')}) x join {_WANTS} w using (book_id)",
    "global_shuffle": f"select book_id, position from {_KEYS}",
}
