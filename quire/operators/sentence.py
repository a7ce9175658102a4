"""Sentences: metrics, flags, the reject chain, adjacent repeats, scrubbing. Row-wise operators take every delivered row, ordered ones each record once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import fixed as X
from quire.functions import re2
from quire.functions import text as T
from quire.functions.re2 import sql_count, sql_matches
from quire.operators.ordered import numbered, with_previous
from quire.sources.tables import read, records, spread

ROWS = "sentences where text is not null"
RECORDS = "(select book_id, position, min(text) as text from sentences where book_id is not null and position is not null group by 1, 2)"


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read(spark, sf_dir, "sentences").where("text is not null").select("book_id", "position", "text"))


def sentence_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares, counts of Greek letters and mathematical signs, and the text cut to 80 characters; an empty text has zeros."""
    short = F.when(F.length("text") > 80, F.concat(F.substring("text", 1, 80), F.lit("..."))).otherwise(F.col("text"))
    return _rows(spark, sf_dir).select("book_id", "position", *(T.ratio(F.col("text"), n).alias(n) for n in T.SHARES), re2.count(F.col("text"), X.GREEK).cast("bigint").alias("greek"), re2.count(F.col("text"), X.MATH).cast("bigint").alias("math"), short.alias("short"))


def garbage_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).select("book_id", "position", *(re2.matches(F.col("text"), p).alias(n) for n, p in X.GARBAGE.items()))


def list_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).where(re2.matches(F.col("text"), X.LIST_MARKER)).select("book_id", "position")


def index_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both variants: of all lines, and of those that aren't empty."""
    flags = _rows(spark, sf_dir).select("book_id", "position", T.index_share(F.col("text"), False).alias("of_all"), T.index_share(F.col("text"), True).alias("of_full"))
    return flags.where("of_all or of_full")


def clean_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by reason, kept ones among them, with their share in percent."""
    per = T.with_reason(records(spark, sf_dir).where("text is not null")).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))
    total = per.agg(F.sum("n").alias("total"))  # one row
    return per.join(F.broadcast(total)).select("reason", "n", F.round(100 * F.col("n") / F.col("total"), 6).alias("percent"))


def kept_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_id, position, text, prev_text) of the records that the reject chain keeps."""
    kept = T.with_reason(records(spark, sf_dir).where("text is not null"))
    kept = T.with_text(kept, F.when(F.col("reason").isNull(), F.regexp_replace("trimmed", "[ \t]{2,}|\t", " ")), "book_id", "position")
    return with_previous(kept, "book_id", "position", ["text"])


def clean_kept_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept records without repeats of the kept one before, numbered anew from 0 in each book."""
    fresh = kept_rows(spark, sf_dir).where("prev_text is null or prev_text <> text")
    return numbered(fresh.select("book_id", "position", "text"), "book_id", "position", "new_position").select("book_id", F.col("new_position").cast("bigint").alias("position"), "text")


def clean_removed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cleaning leaves out, with its reason; repeats among it."""
    lost = T.with_reason(records(spark, sf_dir).where("text is not null")).where("reason is not null").select("text", "reason")
    repeats = kept_rows(spark, sf_dir).where("prev_text = text").select("text", F.lit("adjacent_duplicate").alias("reason"))
    return lost.unionByName(repeats)


def symbol_scrub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the scrubber changes, with the characters it touched."""
    return _rows(spark, sf_dir).select("book_id", "position", T.scrubbed(F.col("text")).alias("text"), T.touched(F.col("text")).cast("bigint").alias("touched")).where("touched > 0")


def symbol_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = T.touched(F.col("text"))
    return _rows(spark, sf_dir).agg(F.count("*").alias("sentences"), F.count_if(n > 0).alias("cleaned"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("symbols"))


def chunk_text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.with_text(_rows(spark, sf_dir), T.chunk_text(F.col("text")), "book_id", "position")


def adjacent_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose text is that of the position before: a join on the key, no window."""
    rows = records(spark, sf_dir).where("text <> ''")
    before = rows.select("book_id", (F.col("position") + 1).alias("position"), F.col("text").alias("before"))
    return rows.join(before, ["book_id", "position"]).where("text = before").select("book_id", "position", "text")


def broken_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that go on what the record with a text before left open."""
    rows = with_previous(records(spark, sf_dir).where("text <> ''"), "book_id", "position", ["text"])
    return rows.where(T.broken_ending(F.col("prev_text")) & T.starts_lower(F.col("text"))).select("book_id", "position", "prev_text", "text")


def context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record with the positions before and after, blank texts left out, joined by a blank."""
    rows = records(spark, sf_dir).withColumn("text", F.when(T.trim(F.col("text")) != "", F.col("text")))
    out = rows
    for name, step in (("before", 1), ("after", -1)):
        out = out.join(rows.select("book_id", (F.col("position") + step).alias("position"), F.col("text").alias(name)), ["book_id", "position"], "left")
    return out.select("book_id", "position", F.concat_ws(" ", "before", "text", "after").alias("context"))


QUERIES = {
    f.__name__: f
    for f in (
        sentence_metrics, garbage_flags, list_marker, index_entry, clean_reason_counts, clean_kept_rows, clean_removed_rows, symbol_scrub, symbol_totals, chunk_text_clean, adjacent_duplicates,
        broken_sentences, context_window,
    )
}
_CLEAN = f"(select book_id, position, text as raw, {T.sql_reason('text')} as reason, {T.sql_cleaned('text')} as text from {RECORDS} where text is not null)"
_KEPT = f"(select *, lag(text) over (partition by book_id order by position) as prev_text from {_CLEAN} where reason is null)"
SQL = {
    "sentence_metrics": f"""select book_id, position, {", ".join(f"{T.sql_ratio('text', n)} as {n}" for n in T.SHARES)}, {sql_count("text", X.GREEK)}::bigint as greek, {sql_count("text", X.MATH)}::bigint as math,
        case when length(text) > 80 then text[1:80] || '...' else text end as short from {ROWS}""",
    "garbage_flags": f"select book_id, position, {', '.join(f'{sql_matches("text", p)} as {n}' for n, p in X.GARBAGE.items())} from {ROWS}",
    "list_marker": f"select book_id, position from {ROWS} and {sql_matches('text', X.LIST_MARKER)}",
    "index_entry": f"select * from (select book_id, position, {T.sql_index_share('text', False)} as of_all, {T.sql_index_share('text', True)} as of_full from {ROWS}) where of_all or of_full",
    "clean_reason_counts": f"select coalesce(reason, 'kept') as reason, count(*) as n, round(100 * count(*) / sum(count(*)) over (), 6)::double as percent from {_CLEAN} group by 1",
    "clean_kept_rows": f"select book_id, row_number() over (partition by book_id order by position) - 1 as position, text from {_KEPT} where prev_text is null or prev_text <> text",
    "clean_removed_rows": f"select raw as text, reason from {_CLEAN} where reason is not null union all select text, 'adjacent_duplicate' as reason from {_KEPT} where prev_text = text",
    "symbol_scrub": f"select * from (select book_id, position, {T.sql_scrubbed('text')} as text, ({T.sql_touched('text')})::bigint as touched from {ROWS}) where touched > 0",
    "symbol_totals": f"select count(*) as sentences, count(*) filter (n > 0) as cleaned, coalesce(sum(n), 0)::bigint as symbols from (select {T.sql_touched('text')} as n from {ROWS})",
    "chunk_text_clean": f"select * from (select book_id, position, {T.sql_chunk_text('text')} as text from {ROWS}) where text <> ''",
    "adjacent_duplicates": f"select a.book_id, a.position, a.text from {RECORDS} a join {RECORDS} b on a.book_id = b.book_id and a.position = b.position + 1 and a.text = b.text where a.text <> ''",
    "broken_sentences": f"""select book_id, position, prev_text, text from (select *, lag(text) over (partition by book_id order by position) as prev_text from {RECORDS} where text <> '')
        where prev_text is not null and {T.sql_broken_ending("prev_text")} and {T.sql_starts_lower("text")}""",
    "context_window": f"""with r as (select book_id, position, case when {T.sql_trim("text")} <> '' then text end as text from {RECORDS})
        select r.book_id, r.position, concat_ws(' ', a.text, r.text, b.text) as context from r left join r a on a.book_id = r.book_id and a.position = r.position - 1 left join r b on b.book_id = r.book_id and b.position = r.position + 1""",
}
