"""The pipeline log as a stream: entries once each, counts per status and time window, snapshots upserted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_log_stream(spark: SparkSession, path: str, schema: str, most_files: int = 100) -> DataFrame:
    """New parquet files of a folder as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(most_files)).parquet(path)


def once_each(stream: DataFrame, key: str = "log_id", stamp: str = "received_at", late: str = "14 days") -> DataFrame:
    """Entries delivered again within `late` are dropped; the state holds only keys that young."""
    return stream.withColumn(stamp, F.col(stamp).cast("timestamp")).withWatermark(stamp, late).dropDuplicatesWithinWatermark([key])


def status_windows(stream: DataFrame, stamp: str = "logged_at", width: str = "1 day", late: str = "14 days") -> DataFrame:
    """(window_start, stage, status, n) per window of event time."""
    timed = stream.withColumn(stamp, F.col(stamp).cast("timestamp")).withWatermark(stamp, late)
    counts = timed.groupBy(F.window(stamp, width).alias("w"), "stage", "status").agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), "stage", "status", "n")


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Everything that is there now, written batch by batch to parquet, exactly once by the checkpoint; then the query ends.

    mode: `append`, or `complete`, whose last batch is the whole table. An `update` batch holds changed rows only.
    """
    if mode not in ("append", "complete"):
        raise ValueError("a table of files takes appended or complete batches")

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}") if mode == "append" else batch.write.mode("overwrite").parquet(path)

    df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
