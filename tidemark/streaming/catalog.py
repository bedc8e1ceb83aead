"""Structured Streaming: news crawls into the day catalog, and event counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import news


def _existing(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """What the last finished batch left, or an empty table before the first."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], like.schema)


def ingest(items: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merge crawled items into the catalog, batch by batch, until the source is drained.

    Every batch writes a version of its own (``v<batch>``) from the one before, so a repeated batch gives the same
    result and no file is read while it is overwritten.
    """
    spark = items.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        old = _existing(spark, f"{path}/v{number - 1}", batch)
        news.merge_catalog(old, batch).write.mode("overwrite").parquet(f"{path}/v{number}")

    return items.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, minutes: int = 60, late: str = "2 hours") -> DataFrame:
    """Events per type and tumbling window; ``ts`` becomes a zoned timestamp, which watermarks need."""
    zoned = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return zoned.withWatermark("ts", late).groupBy(F.window("ts", f"{minutes} minutes").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")


def drained(counts: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an aggregation over all that its source has and return the last complete result."""
    spark, done = counts.sparkSession, []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/v{number}")
        done.append(number)

    counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{path}/v{max(done)}") if done else spark.createDataFrame([], counts.schema)
