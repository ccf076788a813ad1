"""Incremental variants, beyond what a batch run does: new files, and answers that replace older ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spanforge.functions import scalars as S


def text_stream(spark: SparkSession, path: str, schema: str = "doc_id long, text string, at timestamp") -> DataFrame:
    """Documents as they arrive in a folder of JSON files."""
    return spark.readStream.schema(schema).json(path)


def readings_stream(docs: DataFrame) -> DataFrame:
    """Values read from each new document, without state."""
    return docs.select("doc_id", "at", S.value_key(S.money(F.col("text"))).alias("amount"), S.date(F.col("text")).alias("day"))


def hourly(docs: DataFrame, late: str = "2 hours") -> DataFrame:
    """Documents and characters an hour; what comes later than allowed is left out."""
    return docs.withWatermark("at", late).groupBy(F.window("at", "1 hour").alias("w")).agg(F.count("*").alias("documents"), F.sum(F.length("text")).alias("chars")).select("w.start", "documents", "chars")


def deduplicated(docs: DataFrame, late: str = "2 hours") -> DataFrame:
    """The first of equal documents within the watermark."""
    return docs.withColumn("key", F.sha2("text", 256)).withWatermark("at", late).dropDuplicatesWithinWatermark(["key"])


def append(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what is there and stop: a scheduled increment."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
