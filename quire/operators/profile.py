"""Profile of the whole sentences table. Each delivered row with a text counts; what depends on order takes each record once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import fixed as X
from quire.functions import re2
from quire.functions import text as T
from quire.functions.re2 import sql_count, sql_matches
from quire.operators.ordered import with_previous
from quire.operators.sentence import RECORDS
from quire.sources.tables import read, records, spread

PERCENTS = (1, 5, 10, 25, 50, 75, 90, 95, 99)
FULL = "sentences where text <> ''"


def _texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(read(spark, sf_dir, "sentences").where("text is not null and text <> ''").select(*columns, "text"))


def counters() -> dict[str, Column]:
    """Conditions by name; SQL_COUNTERS has the same."""
    t, n = F.col("text"), F.length("text")
    out = {"russian": re2.matches(t, X.RUSSIAN), "english": re2.matches(t, X.ENGLISH), "shorter_20": n < 20, "shorter_50": n < 50, "longer_1000": n > 1000, "longer_2000": n > 2000}
    out |= {f"{name}_{round(100 * b)}": T.ratio(t, name) > b for name, bounds in BOUNDS.items() for b in bounds}
    out |= {"list_marker": re2.matches(t, X.LIST_MARKER)} | {k: t.contains(X.SIGNS_OF[k]) & re2.matches(t, p) for k, p in X.GARBAGE.items()}
    return out | {"index_entry": t.contains("\n") & T.index_share(t, False), "hyphenated": t.contains("-") & re2.matches(t, X.HYPHENATED)}


#: Bounds that shares are counted above. Fixed values.
BOUNDS = {"digit_ratio": (0.1, 0.3, 0.5), "punct_ratio": (0.3, 0.5), "uppercase_ratio": (0.5, 0.8)}
SQL_COUNTERS = {
    "russian": sql_matches("text", X.RUSSIAN), "english": sql_matches("text", X.ENGLISH), "shorter_20": "length(text) < 20", "shorter_50": "length(text) < 50", "longer_1000": "length(text) > 1000", "longer_2000": "length(text) > 2000",
    **{f"{name}_{round(100 * b)}": f"{T.sql_ratio('text', name)} > {b}" for name, bounds in BOUNDS.items() for b in bounds},
    "list_marker": sql_matches("text", X.LIST_MARKER), **{k: sql_matches("text", p) for k, p in X.GARBAGE.items()}, "index_entry": T.sql_index_share("text", False), "hyphenated": sql_matches("text", X.HYPHENATED),
}


def corpus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row, from one scan: rows, counters, sums, and the shortest and longest texts by the histogram's buckets."""
    bucket = F.least(F.floor(F.length("text") / 10), F.lit(1000))
    return _texts(spark, sf_dir).agg(
        F.count("*").alias("sentences"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("bigint").alias("characters"), *(F.count_if(c).alias(name) for name, c in counters().items()),
        F.coalesce(F.sum(re2.count(F.col("text"), X.GREEK)), F.lit(0)).cast("bigint").alias("greek"), F.coalesce(F.sum(re2.count(F.col("text"), X.MATH)), F.lit(0)).cast("bigint").alias("math"),
        (F.min(bucket) * 10).cast("bigint").alias("least_length"), (F.max(bucket) * 10 + 10).cast("bigint").alias("most_length"),
    )


def script_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ru, en = re2.matches(F.col("text"), X.RUSSIAN), re2.matches(F.col("text"), X.ENGLISH)
    kind = F.when(ru & en, "mixed").when(ru, "russian").when(en, "english").otherwise("other")
    return _texts(spark, sf_dir).groupBy(kind.alias("script_class")).agg(F.count("*").alias("n"))


def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(bucket, label, n): buckets of ten characters, all above 10,000 in the last."""
    bucket = F.least(F.floor(F.length("text") / 10), F.lit(1000)).cast("bigint")
    per = _texts(spark, sf_dir).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    label = F.when(F.col("bucket") == 1000, ">10000").otherwise(F.concat((F.col("bucket") * 10).cast("string"), F.lit("-"), (F.col("bucket") * 10 + 9).cast("string")))
    return per.select("bucket", label.alias("label"), "n")


def length_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(percent, length): the middle of the first bucket that reaches the share; from the histogram, which has 1,001 rows at most."""
    w = Window.orderBy("bucket")
    cum = length_histogram(spark, sf_dir).select("bucket", F.sum("n").over(w).alias("so_far"), F.sum("n").over(Window.partitionBy()).alias("total"))
    wanted = cum.withColumn("percent", F.explode(F.array(*map(F.lit, PERCENTS)))).where(F.col("so_far") >= F.floor(F.col("total") * F.col("percent") / 100))
    return wanted.groupBy("percent").agg((F.min("bucket") * 10 + 5).alias("length"))


def per_book_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of each book; the garbage share counts every pattern, so it may be above 1."""
    ru, en = re2.matches(F.col("text"), X.RUSSIAN), re2.matches(F.col("text"), X.ENGLISH)
    mean = lambda c: F.round(F.avg(c), 6)
    flag = lambda c: mean(F.when(c, 1.0).otherwise(0.0))
    garbage = sum((F.col("text").contains(X.SIGNS_OF[n]) & re2.matches(F.col("text"), p)).cast("int") for n, p in X.GARBAGE.items())
    return _texts(spark, sf_dir, "book_id").where("book_id is not null").groupBy("book_id").agg(
        F.count("*").alias("sentences"), mean(F.length("text")).alias("avg_length"), flag(ru & ~en).alias("russian_ratio"), flag(en & ~ru).alias("english_ratio"), flag(ru & en).alias("mixed_ratio"),
        flag(T.ratio(F.col("text"), "digit_ratio") > 0.3).alias("digit_ratio_30"), flag(re2.matches(F.col("text"), X.LIST_MARKER)).alias("list_ratio"), mean(garbage).alias("garbage_ratio"),
    )


def problem_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_id, rank, example): each book's first five repeats, broken sentences and index entries. Five a block, then five a book."""
    rows = with_previous(records(spark, sf_dir).where("text <> ''").withColumn("at", F.col("position")), "book_id", "position", ["text", "at"])
    cut = lambda t: F.when(F.length(t) > 80, F.concat(F.substring(t, 1, 80), F.lit("..."))).otherwise(t)
    both = F.concat(F.col("prev_text"), F.lit(" "), F.col("text"))
    dupe = (F.col("text") == F.col("prev_text")) & (F.col("position") == F.col("prev_at") + 1)
    kinds = [(dupe, F.concat(F.lit("DUPE: "), cut(F.col("text")))), (T.broken_ending(F.col("prev_text")) & T.starts_lower(F.col("text")), F.concat(F.lit("BROKEN: "), cut(both)))]
    kinds.append((F.col("text").contains("\n") & T.index_share(F.col("text"), False), F.concat(F.lit("INDEX: "), cut(F.replace(F.col("text"), F.lit("\n"), F.lit(" / "))))))
    found = F.array_compact(F.array(*(F.when(c, F.struct(F.lit(k).alias("kind"), e.alias("example"))) for k, (c, e) in enumerate(kinds))))
    hits = rows.select("book_id", "position", F.explode(found).alias("x")).select("book_id", "position", "x.*", F.floor(F.col("position") / 4096).alias("block"))
    first = lambda df, *key: df.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("position", "kind"))).where("rank <= 5")
    return first(first(hits, "book_id", "block"), "book_id").select("book_id", F.col("rank").cast("bigint").alias("rank"), "example")


def _phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _texts(spark, sf_dir).where(F.length("text").between(11, 99)).select(F.explode(F.split("text", "\n", -1)).alias("phrase"))
    return lines.groupBy("phrase").agg(F.count("*").alias("n"))


def frequent_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the texts of 11 to 99 characters with its count, the most frequent first."""
    return _phrases(spark, sf_dir).orderBy(F.desc("n"), "phrase")


def running_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases that occur more than ten times."""
    return _phrases(spark, sf_dir).where("n > 10")


QUERIES = {f.__name__: f for f in (corpus_summary, script_class_counts, length_histogram, length_percentiles, per_book_stats, problem_examples, frequent_phrases, running_headers)}
_RU, _EN = sql_matches("text", X.RUSSIAN), sql_matches("text", X.ENGLISH)
_BUCKET = "least(length(text) // 10, 1000)::bigint"
_HISTOGRAM = f"select {_BUCKET} as bucket, count(*) as n from {FULL} group by 1"
_PHRASES = "select phrase, count(*) as n from (select unnest(string_split(text, chr(10))) as phrase from sentences where length(text) between 11 and 99) group by 1"
_flag = lambda c: f"round(avg(case when {c} then 1.0::double else 0.0::double end), 6)"
_cut = lambda t: f"case when length({t}) > 80 then ({t})[1:80] || '...' else {t} end"
SQL = {
    "corpus_summary": f"""select count(*) as sentences, coalesce(sum(length(text)), 0)::bigint as characters, {", ".join(f"count(*) filter ({c}) as {name}" for name, c in SQL_COUNTERS.items())},
        coalesce(sum({sql_count("text", X.GREEK)}), 0)::bigint as greek, coalesce(sum({sql_count("text", X.MATH)}), 0)::bigint as math, min({_BUCKET}) * 10 as least_length, max({_BUCKET}) * 10 + 10 as most_length from {FULL}""",
    "script_class_counts": f"""select case when ru and en then 'mixed' when ru then 'russian' when en then 'english' else 'other' end as script_class, count(*) as n
        from (select {_RU} as ru, {_EN} as en from {FULL}) group by 1""",
    "length_histogram": f"select bucket, case when bucket = 1000 then '>10000' else (bucket * 10) || '-' || (bucket * 10 + 9) end as label, n from ({_HISTOGRAM})",
    "length_percentiles": f"""with c as (select bucket, sum(n) over (order by bucket) as so_far, sum(n) over () as total from ({_HISTOGRAM}))
        select p as percent, min(bucket) * 10 + 5 as length from c, (select unnest([{", ".join(map(str, PERCENTS))}]) as p) where so_far >= floor(total * p / 100) group by p""",
    "per_book_stats": f"""select book_id, count(*) as sentences, round(avg(length(text)), 6) as avg_length, {_flag(f"{_RU} and not {_EN}")} as russian_ratio, {_flag(f"{_EN} and not {_RU}")} as english_ratio,
        {_flag(f"{_RU} and {_EN}")} as mixed_ratio, {_flag(f"{T.sql_ratio('text', 'digit_ratio')} > 0.3")} as digit_ratio_30, {_flag(sql_matches("text", X.LIST_MARKER))} as list_ratio,
        round(avg({" + ".join(f"{sql_matches('text', p)}::int" for p in X.GARBAGE.values())}), 6) as garbage_ratio from {FULL} and book_id is not null group by 1""",
    "problem_examples": f"""with r as (select *, lag(text) over w as prev_text, lag(position) over w as prev_position from {RECORDS} where text <> '' window w as (partition by book_id order by position)),
        x as (select book_id, position, 0 as kind, 'DUPE: ' || {_cut("text")} as example from r where text = prev_text and position = prev_position + 1
            union all select book_id, position, 1, 'BROKEN: ' || {_cut("prev_text || ' ' || text")} from r where prev_text is not null and {T.sql_broken_ending("prev_text")} and {T.sql_starts_lower("text")}
            union all select book_id, position, 2, 'INDEX: ' || {_cut("replace(text, chr(10), ' / ')")} from r where {T.sql_index_share("text", False)})
        select book_id, rank, example from (select *, row_number() over (partition by book_id order by position, kind) as rank from x) where rank <= 5""",
    "frequent_phrases": f"{_PHRASES} order by n desc, phrase",
    "running_headers": f"select * from ({_PHRASES}) where n > 10",
}
