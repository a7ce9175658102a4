"""The tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of sentences with a book and a text, as often as they were delivered."""
    return spread(read(spark, sf_dir, "sentences").select("book_id", "position", "text").where("book_id is not null and position is not null and text is not null"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each (book_id, position) of sentences: the smallest text among its deliveries, null only if all are."""
    rows = read(spark, sf_dir, "sentences").select("book_id", "position", "text").where("book_id is not null and position is not null")
    return rows.groupBy("book_id", "position").agg(F.min("text").alias("text"))


def spread(scan: DataFrame) -> DataFrame:
    """A scan in as many parts as there are cores at least: files in fewer splits are repartitioned, others, as on a cluster, stay as they are."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan._jdf.queryExecution().toRdd().getNumPartitions() < cores else scan
