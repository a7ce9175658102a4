"""Search: BM25 over an inverted index, vectors by their products in blocks, and both together. Queries are all rows whose id 50 divides, against all rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.session import ship
from quire.sources.tables import read

#: Hits a query, its rarest words, the constants of BM25, weights of the fusion, queries of a block. Fixed values, but for the words and the block.
K, TERMS, K1, B, SEMANTIC, KEYWORD, BLOCK = 10, 8, 1.2, 0.75, 0.6, 0.4, 256
EVERY = 50


def _best(rows: DataFrame, score: str, k: int = K) -> DataFrame:
    """The k best hits of each query, of equal ones the smaller id first; the first k of each part first, so that a hot query isn't one task's sort."""
    ranked = lambda df, *key: df.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(score), "hit_id"))).where(F.col("rank") <= k)
    parted = rows.withColumn("part", F.pmod(F.xxhash64("hit_id"), F.lit(16)))
    return ranked(ranked(parted, "query_id", "part"), "query_id").drop("part")


def bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, hit_id, score) of every document that has one of a query's words: its TERMS rarest ones, of equally rare ones the first."""
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    docs = read(spark, sf_dir, "documents").where("text is not null").select("doc_id", words.alias("words")).where(F.size("words") > 0)
    postings = docs.select("doc_id", F.size("words").alias("length"), F.explode("words").alias("word")).groupBy("doc_id", "length", "word").agg(F.count("*").alias("tf"))
    df = postings.groupBy("word").agg(F.count("*").alias("df"))
    whole = docs.agg(F.count("*").alias("n"), F.avg(F.size("words")).alias("mean"))  # one row
    asked = postings.where(f"doc_id % {EVERY} = 0").join(df, "word")
    own = asked.withColumn("r", F.row_number().over(Window.partitionBy("doc_id").orderBy("df", "word"))).where(F.col("r") <= TERMS)
    hits = postings.join(own.select(F.col("doc_id").alias("query_id"), "word", "df"), "word").join(F.broadcast(whole))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    return hits.groupBy("query_id", F.col("doc_id").alias("hit_id")).agg(F.round(F.sum(part), 6).alias("score"))


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best(bm25(spark, sf_dir), "score")


def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, hit_id, score, rank) by the product of vectors made of length 1; vectors of no length or null are no hits.

    Queries travel in blocks of BLOCK vectors, each block against every batch of rows; of each pair the best are kept, then of each query.
    """
    ship(spark)
    rows = read(spark, sf_dir, "embeddings").where("vec_id is not null and embedding is not null").select("vec_id", "embedding")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    rows = rows.withColumn("norm", norm).where("norm > 0").select("vec_id", F.expr("transform(embedding, x -> x / norm)").alias("v"))
    asked = rows.where(f"vec_id % {EVERY} = 0").withColumn("block", F.floor(F.col("vec_id") / (EVERY * BLOCK)))
    blocks = asked.groupBy("block").agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))  # BLOCK vectors at most
    split = rows.groupBy(F.spark_partition_id().alias("part"), F.floor(F.col("vec_id") / 8192).alias("range")).agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))  # 8,192 vectors at most

    def best(batches):
        for pdf in batches:
            for queries, own in zip(pdf["queries"], pdf["rows"]):
                q, v = np.array([x["v"] for x in queries]), np.array([x["v"] for x in own])
                ids = np.array([x["vec_id"] for x in own])
                s = np.round(q @ v.T, 6)
                out = []
                for x, line in zip(queries, s):
                    top = np.lexsort((ids, -line))[: K + 1]
                    out += [(x["vec_id"], int(ids[j]), float(line[j])) for j in top if ids[j] != x["vec_id"]]
                yield pd.DataFrame(out, columns=["query_id", "hit_id", "score"])

    hits = blocks.select("queries").join(split.select("rows")).mapInPandas(best, "query_id bigint, hit_id bigint, score double")
    return _best(hits, "score")


def hybrid_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, hit_id, score, rank): the better of each hit's scores by weight; keyword scores over the query's best. A hit of one kind has 0 of the other."""
    keyword = bm25_topk(spark, sf_dir).where("query_id <> hit_id")
    most = keyword.groupBy("query_id").agg(F.max("score").alias("most"))
    keyword = keyword.join(most, "query_id").select("query_id", "hit_id", (F.col("score") / F.col("most")).alias("k"), F.lit(0.0).alias("s"))
    semantic = vector_topk(spark, sf_dir).select("query_id", "hit_id", F.lit(0.0).alias("k"), F.col("score").alias("s"))
    both = keyword.unionByName(semantic).groupBy("query_id", "hit_id").agg(F.round(SEMANTIC * F.max("s") + KEYWORD * F.max("k"), 6).alias("score"))
    return _best(both, "score")


QUERIES = {f.__name__: f for f in (bm25_topk, vector_topk, hybrid_fusion)}
_DOCS = r"(select * from (select doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') as words from documents where text is not null) where len(words) > 0)"
_BM25 = f"""(with d as materialized (select * from {_DOCS}), p as materialized (select doc_id, length, word, count(*) as tf from (select doc_id, len(words) as length, unnest(words) as word from d) group by 1, 2, 3),
    f as materialized (select word, count(*) as df from p group by 1), o as (select doc_id as query_id, word, df from (select *, row_number() over (partition by doc_id order by df, word) as r from p join f using (word) where doc_id % {EVERY} = 0) where r <= {TERMS})
    select query_id, p.doc_id as hit_id, round(sum(ln(1 + ((select count(*) from d) - df + 0.5) / (df + 0.5)) * tf * ({K1} + 1) / (tf + {K1} * (1 - {B} + {B} * length / (select avg(len(words)) from d)))), 6) as score
    from p join o using (word) group by 1, 2)"""
_top = lambda rows: f"select query_id, hit_id, score, rank from (select *, row_number() over (partition by query_id order by score desc, hit_id) as rank from {rows}) where rank <= {K}"
_VECTORS = "(select vec_id, list_transform(embedding, lambda x: x::double / n) as v from (select *, sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) as n from embeddings where embedding is not null) where n > 0)"
_DOT = f"(select q.vec_id as query_id, r.vec_id as hit_id, round(list_inner_product(q.v, r.v), 6) as score from {_VECTORS} q join {_VECTORS} r on q.vec_id % {EVERY} = 0 and q.vec_id <> r.vec_id)"
SQL = {
    "bm25_topk": _top(_BM25),
    "vector_topk": _top(_DOT),
    "hybrid_fusion": _top(
        f"""(select query_id, hit_id, round({SEMANTIC} * max(s) + {KEYWORD} * max(k), 6) as score from (select query_id, hit_id, score / max(score) over (partition by query_id) as k, 0.0::double as s from ({_top(_BM25)}) where query_id <> hit_id
        union all select query_id, hit_id, 0.0::double, score from ({_top(_DOT)})) group by 1, 2)"""
    ),
}
