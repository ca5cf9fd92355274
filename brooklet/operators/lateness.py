"""Watermarks as columns, late rows, and windows that fire again.

Spark's own late filter drops rows by the watermark of the previous micro-batch. Here the
watermark before each record is a value, per source partition and in arrival order, so a
late row is told apart exactly and kept as an output.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.functions.times import span
from brooklet.operators.ordered import (
    BLOCK_ROWS, Splits, find_splits, latest, running, running_count, running_max,
)

ONE_MILLI = timedelta(milliseconds=1)


def watermark_progress(
    df: DataFrame, source: list[str], arrival: list[str], time: str, bound: timedelta,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Adds ``watermark`` after and ``prior_watermark`` before each record.

    A watermark trails the greatest time seen in the source partition by ``bound`` and one
    millisecond; it is null before the first record.
    """
    rows = running(df, source, arrival, {
        "_seen": running_max(F.col(time)),
        "_seen_before": running_max(F.col(time), inclusive=False),
    }, block_rows=block_rows)
    lag = span(bound + ONE_MILLI)
    return rows.withColumns({
        "watermark": F.col("_seen") - lag, "prior_watermark": F.col("_seen_before") - lag,
    }).drop("_seen", "_seen_before")


def classify_lateness(
    df: DataFrame, time: str, width: str, lateness: timedelta
) -> DataFrame:
    """Adds the tumbling window of each row, ``is_late`` and ``is_refire``.

    A row is late when its window's last millisecond plus ``lateness`` is at or behind the
    watermark before it; it fires its window again when only the window has been passed.
    """
    last = F.col("window_end") - span(ONE_MILLI)
    passed = F.coalesce(last <= F.col("prior_watermark"), F.lit(False))
    gone = F.coalesce(last + span(lateness) <= F.col("prior_watermark"), F.lit(False))
    return window_columns(df, time, width).withColumns({"is_late": gone, "is_refire": passed & ~gone})


def emissions(
    classified: DataFrame, keys: list[str], arrival: list[str], *,
    splits: Splits | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The counts a keyed window emits: one when it closes, one more per accepted late row.

    Within a window all rows on time arrive before the late ones. So the running count of
    the last row on time is the first result, and that of each later row one more. The
    cut points may come from the rows before they were classified.
    """
    group = [*keys, "window_start", "window_end"]
    rows = classified.where(~F.col("is_late")).select(*group, *arrival, "is_refire")
    if splits is None:
        splits = find_splits(rows, group, arrival, block_rows)
    rows = running(rows, group, arrival, {"n": running_count()}, splits=splits, keep_block=True)
    on_time = F.when(~F.col("is_refire"), True)
    rows = running(rows, group, arrival, {"_more": latest(on_time, inclusive=False)}, backwards=True, splits=splits)
    return rows.where(F.col("is_refire") | F.col("_more").isNull()).select(*group, "n", "is_refire")


def window_columns(df: DataFrame, time: str, width: str) -> DataFrame:
    return (
        df.withColumn("_window", F.window(time, width))
        .withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}).drop("_window")
    )


def late_window_counts(
    df: DataFrame, source: list[str], keys: list[str], arrival: list[str], time: str, bound: timedelta,
    width: str, lateness: timedelta, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Keyed tumbling counts with allowed lateness, from raw rows to emissions."""
    splits = find_splits(
        window_columns(df, time, width), [*keys, "window_start", "window_end"], arrival, block_rows)
    progress = watermark_progress(df, source, arrival, time, bound, block_rows)
    return emissions(classify_lateness(progress, time, width, lateness), keys, arrival, splits=splits)
