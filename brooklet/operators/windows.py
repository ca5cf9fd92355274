"""Time, count and session windows.

Every function takes aggregates as ``{name: aggregate column}``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brooklet.operators.ordered import (
    BLOCK_ROWS, find_splits, latest, running, running_count, running_max, running_min,
)

# Rows of a key that share one window partition when sliding over counted rows.
STRETCH_ROWS = 1_000_000


def named(aggregates: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in aggregates.items()]


def time_windows(
    df: DataFrame, time: str, width: str, aggregates: dict[str, Column],
    keys: list[str] | None = None, slide: str | None = None,
) -> DataFrame:
    """Tumbling or, with ``slide``, sliding windows; global without keys.

    Partial aggregates are built before the shuffle, so a large key or the global form
    moves one row per window and task. The time is event time or an arrival column.
    """
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        df.groupBy(*(keys or []), window.alias("_window")).agg(*named(aggregates))
        .withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")})
        .drop("_window")
    )


def with_arrival(df: DataFrame, into: str = "arrived") -> DataFrame:
    """Processing time: the moment a row was read, to be captured once and then kept."""
    return df.withColumn(into, F.current_timestamp())


def session_windows(
    df: DataFrame, keys: list[str], time: str, order: list[str], gap: Column,
    aggregates: dict[str, Column], block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Sessions of rows whose ``[time, time + gap]`` reaches meet; the gap may vary by row.

    A row opens a session when it lies beyond the furthest reach of all rows before it.
    Both running values share one partitioning, also for keys cut into blocks.
    """
    reaching = df.withColumn("_reach", F.col(time) + gap)
    splits = find_splits(df, keys, order, block_rows)
    furthest = running_max(F.col("_reach"), inclusive=False)
    rows = running(reaching, keys, order, {"_furthest": furthest}, splits=splits, keep_block=True)
    opens = F.col("_furthest").isNull() | (F.col(time) > F.col("_furthest"))
    opened = latest(F.when(opens, F.col(time)))
    rows = running(rows, keys, order, {"session_start": opened}, splits=splits)
    return rows.groupBy(*keys, "session_start").agg(
        F.max("_reach").alias("session_end"), *named(aggregates)
    )


def stream_session_windows(
    df: DataFrame, keys: list[str], time: str, gap: str | Column, aggregates: dict[str, Column]
) -> DataFrame:
    """The session window of a watermarked stream."""
    return (
        df.groupBy(*keys, F.session_window(time, gap).alias("_session")).agg(*named(aggregates))
        .withColumns({"session_start": F.col("_session.start"), "session_end": F.col("_session.end")})
        .drop("_session")
    )


def count_windows(
    df: DataFrame, keys: list[str], order: list[str], size: int,
    aggregates: dict[str, Column], block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Windows of ``size`` consecutive rows, from 0; an unfilled last window does not fire."""
    rows = running(df, keys, order, {"_n": running_count()}, block_rows=block_rows)
    numbered = rows.withColumn("window_no", F.floor((F.col("_n") - 1) / size).cast("bigint"))
    out = numbered.groupBy(*keys, "window_no").agg(F.count(F.lit(1)).alias("_rows"), *named(aggregates))
    return out.where(F.col("_rows") == size).drop("_rows")


def sliding_count_windows(
    df: DataFrame, keys: list[str], order: list[str], size: int, slide: int,
    aggregates: dict[str, Column], block_rows: int = BLOCK_ROWS, stretch_rows: int = STRETCH_ROWS,
) -> DataFrame:
    """After every ``slide`` rows, an aggregate over the last ``size`` rows or fewer.

    Rows are numbered, then cut into stretches of ``stretch_rows``, ``size`` at least. The last
    ``size - 1`` rows of a stretch are repeated in the next one, so each can be slid over alone.
    """
    stretch_rows = max(stretch_rows, size)
    rows = running(df, keys, order, {"window_no": running_count()}, block_rows=block_rows)
    index = F.col("window_no") - 1
    own = F.floor(index / stretch_rows).cast("bigint")
    is_tail = F.pmod(index, F.lit(stretch_rows)) >= stretch_rows - (size - 1)
    seen_in = F.when(is_tail, F.array(own, own + 1)).otherwise(F.array(own))
    spread = rows.withColumn("_own", own).withColumn("_stretch", F.explode(seen_in))
    frame = Window.partitionBy(*keys, "_stretch").orderBy("window_no").rowsBetween(-(size - 1), 0)
    fired = spread.select(
        *keys, "window_no", "_own", "_stretch", *order,
        *[value.over(frame).alias(name) for name, value in aggregates.items()],
    )
    due = (F.col("_own") == F.col("_stretch")) & (F.pmod("window_no", F.lit(slide)) == 0)
    return fired.where(due).drop("_own", "_stretch")


def running_argmin(
    df: DataFrame, keys: list[str], order: list[str], by: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """After each row, the row of its key with the least ``by`` so far; ties keep the first,
    and a null ``by`` is greater than any value.

    The least row is in the struct column ``least``.
    """
    rest = [c for c in df.columns if c not in (by, *order)]
    least = running_min(F.struct(F.col(by).isNull().alias("_missing"), by, *order, *rest))
    rows = running(df, keys, order, {"least": least}, block_rows=block_rows)
    return rows.withColumn("least", F.col("least").dropFields("_missing"))


def argmin(df: DataFrame, keys: list[str], order: list[str], by: str) -> DataFrame:
    """The row of each key with the least ``by``, combined before the shuffle; a null ``by`` is
    greater than any value."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(F.col(by).isNull(), by, *order))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")
