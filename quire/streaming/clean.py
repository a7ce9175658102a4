"""The reject chain over a stream of sentence files; only what needs no order: repeats are for the batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions import text as T
from quire.sources.files import SENTENCE


def read_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(SENTENCE).json(path)


def cleaned(rows: DataFrame) -> DataFrame:
    """Each row with its reason, null where it is kept, and its text as it is kept."""
    made = T.with_reason(rows.where("text is not null"))
    return made.select("book_id", "position", F.when(F.col("reason").isNull(), F.regexp_replace("trimmed", "[ \t]{2,}|\t", " ")).alias("text"), "reason")


def run(spark: SparkSession, path: str, out: str, checkpoint: str) -> StreamingQuery:
    """All files there are now, once, into Parquet by reason."""
    return cleaned(read_stream(spark, path)).withColumn("kept", F.col("reason").isNull()).writeStream.partitionBy("kept").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
