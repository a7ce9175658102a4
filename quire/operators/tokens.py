"""Operators on token ids, and figures of a tokenizer. The tokenizer of these queries is one that SQL has too: pieces of four characters of the words between blanks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.sampling import hash_of, sql_hash_of
from quire.operators.sentence import RECORDS
from quire.sources.tables import records

CLS, SEP, PAD, MASK, MOST = 2, 3, 0, 4, 32
PERCENTS = (50, 75, 90, 95, 99)
#: What no mask is put on, besides words of one character. Fixed values.
PUNCTUATION = """, . ! ? : ; - — … ( ) [ ] { } " ' « » „ “ • / \\ – ― ′ ″""".split()
#: Masks a text, and tokens between two.
MASKS, DISTANCE = 3, 3


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.with_text(records(spark, sf_dir).where("text is not null"), T.collapse(F.col("text")), "book_id", "position")
    return rows.withColumn("words", F.split("text", " "))


def encode(ids: Column, most: int = MOST) -> tuple[Column, Column]:
    """Ids with CLS and SEP, cut and padded to most, and their mask."""
    whole = F.concat(F.array(F.lit(CLS)), F.slice(ids, 1, most - 2), F.array(F.lit(SEP)))
    used = F.least(F.size(ids) + 2, F.lit(most))
    return F.concat(whole, F.array_repeat(F.lit(PAD), F.lit(most) - used)), F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(most) - used))


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id of a word is its length and 10."""
    rows = _words(spark, sf_dir).select("book_id", "position", F.transform("words", lambda w: F.length(w) + 10).alias("own"))
    ids, mask = encode(F.col("own"))
    return rows.select("book_id", "position", ids.alias("ids"), mask.alias("mask"))


def encode_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(spark, sf_dir).select("book_id", "position", F.array_join(F.transform("ids", lambda x: x.cast("string")), " ").alias("ids"), F.aggregate("mask", F.lit(0), lambda a, x: a + x).alias("used"))


def special_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = F.transform("ids", lambda x: F.when(x.isin(CLS, SEP, PAD), "1").otherwise("0"))
    return _encoded(spark, sf_dir).select("book_id", "position", F.array_join(flags, "").alias("special"))


def dataset_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every example begins with CLS, has SEP once and last of what is used, and pads after it only."""
    used = F.aggregate("mask", F.lit(0), lambda a, x: a + x)
    rows = _encoded(spark, sf_dir).withColumn("used", used)
    return rows.agg(
        F.count("*").alias("examples"), F.bool_and(F.col("ids")[0] == CLS).alias("cls_first"), F.bool_and(F.size(F.filter("ids", lambda x: x == SEP)) == 1).alias("sep_once"),
        F.bool_and(F.get("ids", F.col("used") - 1) == SEP).alias("sep_last"), F.bool_and(F.size(F.filter("ids", lambda x: x == PAD)) == MOST - F.col("used")).alias("pad_tail"),
    )


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, tokens and unknown words of each record: a word of other characters than letters, figures and punctuation is unknown."""
    n = F.aggregate("words", F.lit(0), lambda a, w: a + F.ceil(F.length(w) / 4).cast("int"))
    unknown = F.size(F.filter("words", lambda w: w.rlike(r"[^\p{L}\p{M}\p{N}\p{P}]")))
    lang = F.when(F.col("text").rlike("[А-яЁё]"), "ru").otherwise("en")
    return _words(spark, sf_dir).select(lang.alias("lang"), F.size("words").alias("words"), n.alias("tokens"), unknown.alias("unknown"))


def _metrics(rows: DataFrame, *keys: str) -> DataFrame:
    per = rows.groupBy(*keys).agg(F.count("*").alias("sentences"), F.sum("words").alias("w"), F.sum("tokens").alias("t"), F.sum("unknown").alias("u"))
    return per.select(
        *keys, "sentences", F.col("t").alias("tokens"), F.round(F.col("t") / F.col("w"), 6).alias("fertility"), F.round(100 * F.col("u") / F.col("t"), 6).alias("unk_rate"),
        F.round(100 * (1 - F.col("u") / F.col("t")), 6).alias("coverage"), F.round(F.col("t") / F.col("sentences"), 6).alias("avg_tokens"),
    )


def tokenizer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(_measured(spark, sf_dir).withColumn("of", F.lit("all")), "of").drop("of")


def tokenizer_metrics_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(_measured(spark, sf_dir), "lang")


def seq_length_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-rank percentiles of tokens a record, from the counts of each length."""
    per = _measured(spark, sf_dir).groupBy("tokens").agg(F.count("*").alias("n"))
    cum = per.select("tokens", F.sum("n").over(Window.orderBy("tokens")).alias("so_far"), F.sum("n").over(Window.partitionBy()).alias("total"))  # a row for a length
    wanted = cum.withColumn("percent", F.explode(F.array(*map(F.lit, PERCENTS)))).where("so_far > total * percent div 100")
    return wanted.groupBy("percent").agg(F.min("tokens").cast("bigint").alias("tokens"))


def seq_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("tokens")
    return _measured(spark, sf_dir).agg(F.count("*").alias("n"), F.min(x).alias("least"), F.max(x).alias("most"), F.round(F.avg(x), 6).alias("mean"), F.round(F.stddev_pop(x), 6).alias("std"), F.round(F.expr("percentile(tokens, 0.5)"), 6).alias("median"))


def _vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _words(spark, sf_dir).select(F.when(F.col("text").rlike("[А-яЁё]"), "ru").otherwise("en").alias("lang"), F.explode("words").alias("token"))
    return rows.groupBy("lang", "token").agg(F.count("*").alias("n"))


def token_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty most frequent words; of equal ones the first."""
    return _vocabulary(spark, sf_dir).groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(20)


def vocab_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of Russian records, of the others, and of both."""
    sides = _vocabulary(spark, sf_dir).groupBy("token").agg(F.bool_or(F.col("lang") == "ru").alias("ru"), F.bool_or(F.col("lang") == "en").alias("en"))
    return sides.agg(F.count_if(F.expr("ru and en")).alias("shared"), F.count_if(F.expr("ru and not en")).alias("only_ru"), F.count_if(F.expr("en and not ru")).alias("only_en"))


def _maskable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_id, position, words, places): places that may be masked, each with its hash."""
    place = F.expr("filter(sequence(1, size(words)), i -> length(words[i - 1]) >= 2)")
    rows = _words(spark, sf_dir).select("book_id", "position", "text", "words", place.alias("places"), hash_of("book_id", "position").alias("h"))
    return rows.where("text rlike '[^ ]{2}'")  # there is a place then; a condition on places would be computed beside them


def mask_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One word of each record masked, chosen by the record's hash."""
    pick = F.expr("places[int(conv(substr(h, 1, 7), 16, 10) % size(places))]")
    rows = _maskable(spark, sf_dir).withColumn("place", pick)
    masked = F.expr("array_join(transform(words, (w, i) -> if(i + 1 = place, '[MASK]', w)), ' ')")
    return rows.select("book_id", "position", F.expr("words[place - 1]").alias("truth"), masked.alias("text"))


def mask_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to MASKS places from the first on, DISTANCE apart at least; a record with fewer than two such places keeps one."""
    fold = f"aggregate(places, cast(array() as array<int>), (out, i) -> if(size(out) < {MASKS} and (size(out) = 0 or i - element_at(out, -1) >= {DISTANCE}), concat(out, array(i)), out))"
    rows = _maskable(spark, sf_dir).withColumn("chosen", F.expr(fold))
    masked = F.expr("array_join(transform(words, (w, i) -> if(array_contains(chosen, i + 1), '[MASK]', w)), ' ')")
    return rows.select("book_id", "position", F.size("chosen").alias("masks"), masked.alias("text"))


QUERIES = {
    f.__name__: f
    for f in (encode_pad, special_mask, dataset_invariants, tokenizer_metrics, tokenizer_metrics_by_lang, seq_length_percentiles, seq_length_stats, token_top_k, vocab_overlap, mask_single, mask_multi)
}
_WORDS = f"(select *, string_split(text, ' ') as words from (select book_id, position, {T.sql_collapse('text')} as text from {RECORDS} where text is not null) where text <> '')"
_IDS = f"""(select book_id, position, list_concat(list_concat([{CLS}], list_transform(words, lambda w: length(w) + 10)[1:{MOST - 2}]), [{SEP}]) as own, least(len(words) + 2, {MOST}) as used from {_WORDS})"""
_FULL = f"(select book_id, position, used, list_concat(own, list_transform(range({MOST} - used), lambda x: {PAD}::bigint)) as ids from {_IDS})"
_MEASURED = rf"""(select case when regexp_matches(text, '[А-яЁё]') then 'ru' else 'en' end as lang, len(words) as words, list_sum(list_transform(words, lambda w: ceil(length(w) / 4)))::bigint as tokens,
    len(list_filter(words, lambda w: regexp_matches(w, '[^\p{{L}}\p{{M}}\p{{N}}\p{{P}}]'))) as unknown from {_WORDS})"""
_METRICS = """count(*) as sentences, sum(tokens)::bigint as tokens, round(sum(tokens)::double / sum(words), 6) as fertility, round(100 * sum(unknown)::double / sum(tokens), 6) as unk_rate,
    round(100 * (1 - sum(unknown)::double / sum(tokens)), 6) as coverage, round(sum(tokens)::double / count(*), 6) as avg_tokens"""
_VOCABULARY = f"(select case when regexp_matches(text, '[А-яЁё]') then 'ru' else 'en' end as lang, unnest(words) as token from {_WORDS})"
_PLACES = f"(select *, list_filter(range(1, len(words) + 1), lambda i: length(words[i]) >= 2) as places, {sql_hash_of('book_id', 'position')} as h from {_WORDS})"
SQL = {
    "encode_pad": f"select book_id, position, array_to_string(ids, ' ') as ids, used::int as used from {_FULL}",
    "special_mask": f"select book_id, position, array_to_string(list_transform(ids, lambda x: case when x in ({CLS}, {SEP}, {PAD}) then '1' else '0' end), '') as special from {_FULL}",
    "dataset_invariants": f"""select count(*) as examples, bool_and(ids[1] = {CLS}) as cls_first, bool_and(len(list_filter(ids, lambda x: x = {SEP})) = 1) as sep_once, bool_and(ids[used] = {SEP}) as sep_last,
        bool_and(len(list_filter(ids, lambda x: x = {PAD})) = {MOST} - used) as pad_tail from {_FULL}""",
    "tokenizer_metrics": f"select {_METRICS} from {_MEASURED}",
    "tokenizer_metrics_by_lang": f"select lang, {_METRICS} from {_MEASURED} group by 1",
    "seq_length_percentiles": f"""with o as (select tokens, row_number() over (order by tokens) - 1 as i, count(*) over () as n from {_MEASURED})
        select p as percent, tokens from o, (select unnest([{", ".join(map(str, PERCENTS))}]) as p) where i = n * p // 100""",
    "seq_length_stats": f"select count(*) as n, min(tokens)::int as least, max(tokens)::int as most, round(avg(tokens), 6) as mean, round(stddev_pop(tokens), 6) as std, round(quantile_cont(tokens, 0.5), 6)::double as median from {_MEASURED}",
    "token_top_k": f"select token, count(*) as n from {_VOCABULARY} group by 1 order by n desc, token limit 20",
    "vocab_overlap": f"""select count(*) filter (ru and en) as shared, count(*) filter (ru and not en) as only_ru, count(*) filter (en and not ru) as only_en
        from (select token, bool_or(lang = 'ru') as ru, bool_or(lang = 'en') as en from {_VOCABULARY} group by 1)""",
    "mask_single": f"""select book_id, position, words[place] as truth, array_to_string(list_transform(words, lambda w, i: case when i = place then '[MASK]' else w end), ' ') as text
        from (select *, places[('0x' || h[1:7])::bigint % len(places) + 1] as place from {_PLACES} where len(places) > 0)""",
    "mask_multi": f"""select book_id, position, len(chosen)::int as masks, array_to_string(list_transform(words, lambda w, i: case when list_contains(chosen, i) then '[MASK]' else w end), ' ') as text
        from (select *, list_reduce(places, lambda o, i: case when len(o) < {MASKS} and (len(o) = 0 or i - o[-1] >= {DISTANCE}) then list_append(o, i) else o end, []::bigint[]) as chosen
        from (select * replace (list_transform(places, lambda i: i) as places) from {_PLACES}) where len(places) > 0)""",
}
