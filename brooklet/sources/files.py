"""File sinks in time buckets, and text and CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

HOUR_BUCKET = "yyyy-MM-dd--HH"
MINUTE_BUCKET = "yyyy-MM-dd--HH-mm"

# Fixed value: the row sink starts new files after 10 seconds.
ROLL_INTERVAL = "10 seconds"


def bucketed(df: DataFrame, time: Column, pattern: str = HOUR_BUCKET) -> DataFrame:
    return df.withColumn("bucket", F.date_format(time, pattern))


def write_buckets(df: DataFrame, path: str, kind: str = "parquet", max_records: int | None = None) -> None:
    """One folder per ``bucket``. Rows are rebalanced by bucket: small buckets share a task,
    and a bucket beyond the advisory partition size is split over several."""
    writer = df.hint("rebalance", F.col("bucket")).write.mode("overwrite")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.partitionBy("bucket").format(kind).save(path)


def stream_buckets(
    df: DataFrame, path: str, checkpoint: str, kind: str = "parquet", max_records: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The streaming sink. A micro-batch commits its files together, so files roll with the
    trigger, and with ``max_records`` also by size."""
    writer = df.writeStream.partitionBy("bucket").format(kind)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    trigger = trigger or {"processingTime": ROLL_INTERVAL}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)


def read_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return (spark.readStream if streaming else spark.read).text(path)


def overwrite_text(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)


def overwrite_csv(df: DataFrame, path: str, separator: str = ",") -> None:
    df.write.mode("overwrite").option("sep", separator).csv(path)
