"""Starting streams: every micro-batch writes to a folder named after it, so a replay replaces it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from brooklet.operators.buckets import BucketedTable
from brooklet.session import scratch_path

Each = Callable[[DataFrame, int], None]


def start(
    df: DataFrame, each: Each, checkpoint: str, mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    """Run ``each`` on every micro-batch. The default trigger takes all that is there and stops."""
    return (
        df.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def reused(each: Each) -> Each:
    """For sinks that read their micro-batch more than once: it is computed only once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            each(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def parquet_batches(path: str) -> Each:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def upserts(table: BucketedTable) -> Each:
    return lambda batch, batch_id: table.upsert(batch, batch_id)


def run_to_table(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Run an append stream to its end and return what it wrote."""
    path = scratch_path(spark, label)
    start(df, parquet_batches(f"{path}/out"), f"{path}/checkpoint").awaitTermination()
    return spark.read.option("basePath", f"{path}/out").parquet(f"{path}/out").select(*df.columns)


def run_to_keyed(
    spark: SparkSession, df: DataFrame, label: str, keys: list[str], order: list[str], mode: str = "update"
) -> DataFrame:
    """Run a stream of changed rows into a keyed table and return its current rows."""
    path = scratch_path(spark, label)
    table = BucketedTable(spark, f"{path}/table", keys, order)
    start(df, upserts(table), f"{path}/checkpoint", mode).awaitTermination()
    return table.read()
