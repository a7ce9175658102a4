"""Order within a key without a task for a key: rows of a key are cut into blocks of the order, blocks are joined by what they end with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions of a block; it decides how far a hot key spreads, not what comes out.
BLOCK = 4096


def with_previous(df: DataFrame, key: str, order: str, columns: list[str], block: int = BLOCK) -> DataFrame:
    """Adds prev_<column> of the row before in the order of the key, null for the first. (key, order) is unique; the order is a whole number."""
    held = F.struct(order, *columns)
    rows = df.withColumn("_block", F.floor(F.col(order) / block))
    own = rows.withColumn("_before", F.lag(held).over(Window.partitionBy(key, "_block").orderBy(order)))
    ends = rows.groupBy(key, "_block").agg(F.max(held).alias("_end"))
    carried = ends.select(key, "_block", F.lag("_end").over(Window.partitionBy(key).orderBy("_block")).alias("_carried"))  # a row for a block
    both = own.join(carried, [key, "_block"]).withColumn("_before", F.coalesce("_before", "_carried"))
    return both.select(*df.columns, *(F.col("_before").getField(c).alias(f"prev_{c}") for c in columns))


def numbered(df: DataFrame, key: str, order: str, name: str, block: int = BLOCK) -> DataFrame:
    """Adds the row's number from 0 in the order of the key."""
    rows = df.withColumn("_block", F.floor(F.col(order) / block))
    own = rows.withColumn("_row", F.row_number().over(Window.partitionBy(key, "_block").orderBy(order)))
    sizes = rows.groupBy(key, "_block").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return own.join(sizes.select(key, "_block", before.alias("_start")), [key, "_block"]).select(*df.columns, (F.col("_start") + F.col("_row") - 1).alias(name))


def ranked_by_hash(df: DataFrame, hash_: Column, most: int, name: str = "rank", digits: int = 3) -> DataFrame:
    """Rows of the smallest hashes with their rank from 1, most of them at least and exact: whole buckets of the first hex digits, ranks inside a bucket.

    Buckets are counted first (16^digits rows), so that no task holds all rows; ties of equal hashes are ordered by all columns.
    """
    rows = df.withColumn("_h", hash_).withColumn("_bucket", F.substring("_h", 1, digits))
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))  # at most 16^digits rows
    start = F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    wanted = sizes.select("_bucket", start.alias("_start")).where(F.col("_start") < most)
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_h", *df.columns))
    return rows.join(F.broadcast(wanted), "_bucket").withColumn(name, F.col("_start") + inside).select(*df.columns, name).where(F.col(name) <= most)
