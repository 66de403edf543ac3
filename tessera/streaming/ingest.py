"""Files as a stream: each new file is mined once, and results are appended exactly once a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.documents import agreements_and_events


def agreement_stream(spark: SparkSession, pattern: str, out: str, checkpoint: str) -> None:
    """Reads files of a pattern that came since the last call; writes agreements, events and rejects
    below out, a folder a batch, so a batch that is run again replaces itself."""
    files = spark.readStream.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))

    def write(batch: DataFrame, number: int) -> None:
        for name, table in zip(("agreements", "events", "rejects"), agreements_and_events(batch), strict=True):
            table.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")

    query = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events by window and key; works on streams, where windows close once they are late by so much."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")
