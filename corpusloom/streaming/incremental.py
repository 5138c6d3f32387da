"""Files that arrive over time: the idempotent skips of the corpus as an AvailableNow stream (an addition)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def process_new_files(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, step: Callable[[DataFrame], DataFrame]) -> None:
    """Each Parquet file once, through ``step``, appended to the target; re-running does nothing new."""

    def write(batch: DataFrame, batch_id: int) -> None:
        step(batch).withColumn("batch_id", F.lit(batch_id)).write.mode("append").partitionBy("batch_id").option("partitionOverwriteMode", "dynamic").parquet(target)

    q = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def event_counts(events: DataFrame, late: str = "1 hour", every: str = "1 hour") -> DataFrame:
    """Events of each type a window, late ones within the watermark; works on streams and tables."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withWatermark("ts", late) if events.isStreaming else e
    return e.groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
