"""Greedy packing of a book's sentences into chunks of a bounded number of tokens, without a task for a book.

A chunk's length before a sentence decides what happens at it, and is below the bound. So each block of a book's sentences is a map from
the length it begins with to the length it ends with and the chunks it closes. The maps are made for all blocks at once, put together
in the order of the blocks (one small row a block), and then every block numbers its sentences with the length and chunk it truly begins
with. Tokens are words between blanks here; any column of counts will do.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions.fold import block_map
from quire.operators.sampling import VALIDATION, hash_of, sql_hash_of
from quire.operators.sentence import RECORDS
from quire.session import ship
from quire.sources.tables import records

#: Positions of a block; it decides how far a hot book spreads, not what comes out.
BLOCK = 16_384
MARGIN = 2  # for the tokens that begin and end a chunk


def pack(rows: DataFrame, most: int, block: int = BLOCK) -> DataFrame:
    """rows: (book_id, split, position, tokens, ...), (book_id, split, position) unique. Adds chunk, from 0 in each book and split.

    Rows of no tokens, or of more than most less MARGIN, are left out.
    """
    ship(rows.sparkSession)
    limit = most - MARGIN
    kept = rows.where(F.col("tokens").between(1, limit)).withColumn("block", F.floor(F.col("position") / block))
    slim = kept.select("book_id", "split", "block", "position", "tokens")
    keys = ["book_id", "split", "block"]

    def maps(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        end, closed = block_map(pdf.sort_values("position")["tokens"].to_numpy(), limit)
        return pd.DataFrame({"book_id": [key[0]], "split": [key[1]], "block": [key[2]], "end": [end.tolist()], "closed": [closed.tolist()]})

    def follow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, at, chunk, out = pdf.sort_values("block"), 0, 0, []
        for b, end, closed in zip(pdf["block"], pdf["end"], pdf["closed"]):
            out.append((key[0], key[1], b, at, chunk))
            at, chunk = int(end[at]), chunk + int(closed[at])
        return pd.DataFrame(out, columns=["book_id", "split", "block", "at", "first"])

    def number(key: tuple, own: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("position")
        at, chunk, out = int(start["at"].iloc[0]), int(start["first"].iloc[0]), []
        for n in own["tokens"].tolist():
            if at + n > limit:
                chunk += at > 0
                at = n
            else:
                at += n
            out.append(chunk)
        return own.assign(chunk=out)[["book_id", "split", "position", "chunk"]]

    made = slim.groupBy(*keys).applyInPandas(maps, "book_id string, split string, block bigint, end array<int>, closed array<int>")
    starts = made.groupBy("book_id", "split").applyInPandas(follow, "book_id string, split string, block bigint, at int, first bigint")
    numbers = slim.groupBy(*keys).cogroup(starts.groupBy(*keys)).applyInPandas(number, "book_id string, split string, position int, chunk bigint")
    return kept.drop("block").join(numbers, ["book_id", "split", "position"])


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.with_text(records(spark, sf_dir).where("text is not null"), T.chunk_text(F.col("text")), "book_id", "position")
    split = F.when(F.substring(hash_of("book_id", "position"), 1, 8) < VALIDATION, "val").otherwise("train")
    return rows.select("book_id", split.alias("split"), "position", F.size(F.split("text", " ")).alias("tokens"), "text")


def chunks(spark: SparkSession, sf_dir: str, most: int) -> DataFrame:
    """(book_id, split, chunk, sentences, tokens, text): a chunk's sentences in order; what is collected for one is bounded by its tokens."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "text"))), lambda x: x.getField("text")), " ")
    per = pack(_sentences(spark, sf_dir), most).groupBy("book_id", "split", "chunk")
    return per.agg(F.count("*").alias("sentences"), F.sum("tokens").cast("bigint").alias("tokens"), text.alias("text"))


QUERIES = {f"greedy_pack_{m}": (lambda spark, sf_dir, m=m: chunks(spark, sf_dir, m)) for m in (128, 256, 512)}
_ROWS = f"""(select *, row_number() over (partition by book_id, split order by position) as r from (select book_id, case when {sql_hash_of("book_id", "position")}[1:8] < '{VALIDATION}' then 'val' else 'train' end as split, position, text,
    len(string_split(text, ' ')) as tokens from (select book_id, position, {T.sql_chunk_text("text")} as text from {RECORDS} where text is not null) where text <> '') where tokens <= %d)"""
SQL = {
    f"greedy_pack_{m}": f"""with recursive rows as materialized (select * from {_ROWS % (m - MARGIN)}), f as (select book_id, split, r, tokens as acc, 0::bigint as chunk from rows where r = 1
        union all select x.book_id, x.split, x.r, case when f.acc + x.tokens > {m - MARGIN} then x.tokens else f.acc + x.tokens end, f.chunk + (f.acc + x.tokens > {m - MARGIN})::int
            from f join rows x on x.book_id = f.book_id and x.split = f.split and x.r = f.r + 1)
        select book_id, split, chunk, count(*) as sentences, sum(tokens)::bigint as tokens, string_agg(text, ' ' order by position) as text from rows join f using (book_id, split, r) group by 1, 2, 3"""
    for m in (128, 256, 512)
}
