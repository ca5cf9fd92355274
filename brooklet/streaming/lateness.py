"""Late rows of a stream, told apart exactly.

The greatest time seen so far is kept per source partition, one small row set per micro-batch.
Inside a micro-batch the batch operators apply; the last stored values stand for all earlier ones.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.functions.times import span
from brooklet.operators.changestate import KeyedTable
from brooklet.operators.lateness import ONE_MILLI, classify_lateness, watermark_progress
from brooklet.operators.ordered import running, running_count
from brooklet.streaming.runner import Each, reused


def _classified(
    batch: DataFrame, batch_id: int, path: str, source: list[str], arrival: list[str], time: str,
    bound: timedelta, width: str, lateness: timedelta,
) -> tuple[DataFrame, DataFrame]:
    """Rows of a micro-batch told apart, and the greatest time per source partition after it."""
    rows = watermark_progress(batch, source, arrival, time, bound)
    highest = batch.groupBy(*source).agg(F.max(time).alias("seen"))
    if batch_id > 0:
        before = batch.sparkSession.read.parquet(f"{path}/seen/batch={batch_id - 1}")
        lag = span(bound + ONE_MILLI)
        rows = rows.join(before, source, "left").withColumns({
            name: F.greatest(F.col(name), F.col("seen") - lag) for name in ("watermark", "prior_watermark")
        }).drop("seen")
        highest = highest.unionByName(before).groupBy(*source).agg(F.max("seen").alias("seen"))
    return classify_lateness(rows, time, width, lateness), highest


def late_row_batches(
    path: str, source: list[str], arrival: list[str], time: str, bound: timedelta, width: str, lateness: timedelta
) -> Each:
    """A sink that writes every row with ``is_late`` and ``is_refire`` to ``path/rows``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows, highest = _classified(batch, batch_id, path, source, arrival, time, bound, width, lateness)
        rows.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        highest.write.mode("overwrite").parquet(f"{path}/seen/batch={batch_id}")

    return reused(write)


def window_count_batches(
    path: str, source: list[str], keys: list[str], arrival: list[str], time: str, bound: timedelta,
    width: str, lateness: timedelta,
) -> Each:
    """Keyed tumbling counts with allowed lateness. Results go to ``path/fired``: one when the
    watermark closes a window, one more per accepted late row; late rows go to ``path/late``.

    Counts of windows that can still change are kept in an upsert table. Keys belong to one
    source partition each.
    """
    group = [*source, *keys, "window_start", "window_end"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows, highest = _classified(batch, batch_id, path, source, arrival, time, bound, width, lateness)
        rows.where("is_late").write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")

        table = KeyedTable(spark, f"{path}/open", group, ["since"], dropped="gone")
        counted = running(rows.where(~F.col("is_late")).select(*group, *arrival, "is_refire"), group, arrival,
                          {"n": running_count()})
        # Windows known from earlier micro-batches, with their counts so far.
        known = rows.select(*group).limit(0).withColumns({
            "total": F.lit(0).cast("bigint"), "on_time": F.lit(0).cast("bigint"), "fired": F.lit(False)})
        if table.exists():
            known = table.read(before=batch_id).select(*known.columns)
        counted = counted.join(known.select(*group, "total"), group, "left").withColumn(
            "n", F.col("n") + F.coalesce("total", F.lit(0))).drop("total").persist()

        new = counted.groupBy(*group).agg(
            F.max("n").alias("new_total"), F.max(F.when(~F.col("is_refire"), F.col("n"))).alias("new_on_time"))
        last = F.col("window_end") - span(ONE_MILLI)
        clock = F.col("seen") - span(bound + ONE_MILLI)
        state = known.join(new, group, "full").join(highest, source).select(
            *group, F.coalesce("new_total", "total").alias("total"),
            F.coalesce("new_on_time", "on_time").alias("on_time"),
            F.coalesce("fired", F.lit(False)).alias("was_fired"), (last <= clock).alias("fired"),
            (last + span(lateness) <= clock).alias("gone"), F.col("new_total").isNotNull().alias("touched"),
        ).persist()
        try:
            closing = state.where(F.col("fired") & ~F.col("was_fired") & F.col("on_time").isNotNull())
            fired = closing.select(*group, F.col("on_time").alias("n"), F.lit(False).alias("is_refire")).unionByName(
                counted.where("is_refire").select(*group, "n", "is_refire"))
            fired.write.mode("overwrite").parquet(f"{path}/fired/batch={batch_id}")
            changed = state.where(F.col("touched") | F.col("gone") | (F.col("fired") != F.col("was_fired")))
            table.upsert(changed.drop("was_fired", "touched").withColumn("since", F.lit(batch_id)), batch_id)
            highest.write.mode("overwrite").parquet(f"{path}/seen/batch={batch_id}")
        finally:
            state.unpersist()
            counted.unpersist()

    return reused(write)
