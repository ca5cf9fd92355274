"""Window, interval, as-of and dimension joins."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklet.functions.times import micros, span, span_micros
from brooklet.operators.ordered import BLOCK_ROWS, latest, running

# More rows than this are never broadcast by a hint of ours.
SMALL_ROWS = 2_000


def is_small(df: DataFrame, rows: int = SMALL_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than it needs to tell."""
    return len(df.select(F.lit(1)).take(rows + 1)) <= rows


def window_join(
    left: DataFrame, right: DataFrame, keys: list[str], width: str,
    left_time: str, right_time: str, how: str = "inner",
) -> DataFrame:
    """Rows of both sides with equal keys in the same tumbling window, kept as ``window``.

    The window is part of the join key, so one key spreads over its windows, and streams can
    drop state once the watermark has passed it. ``how="left"`` is the coGroup that keeps
    left rows without a partner.
    """
    return left.withColumn("window", F.window(left_time, width)).join(
        right.withColumn("window", F.window(right_time, width)), [*keys, "window"], how
    )


def interval_join(
    left: DataFrame, right: DataFrame, keys: list[str],
    left_time: str, right_time: str, lower: timedelta, upper: timedelta,
) -> DataFrame:
    """Inner join on equal keys with ``right_time`` in ``[left_time + lower, left_time + upper]``.

    Time is cut into stretches as long as the interval, and the stretch joins the key: a
    left row meets the one or two stretches its interval touches. So rows far apart in time
    are never paired, and a key with many rows spreads over its stretches. Other columns of
    the two sides must have different names.
    """
    width = max(span_micros(upper - lower), 1)

    def stretch(time: Column) -> Column:
        return F.floor(micros(time) / F.lit(width)).cast("bigint")

    reach = F.sequence(stretch(F.col(left_time) + span(lower)), stretch(F.col(left_time) + span(upper)))
    near = left.withColumn("_stretch", F.explode(reach))
    placed = right.withColumn("_stretch", stretch(F.col(right_time)))
    joined = near.join(placed, [*keys, "_stretch"])
    within = F.col(right_time).between(
        F.col(left_time) + span(lower), F.col(left_time) + span(upper)
    )
    return joined.where(within).drop("_stretch")


#: Rows of one side of a cell, a key and a stretch of time, beyond which the cell is cut into tiles.
DENSE_ROWS = 100_000


def tiled_interval_join(
    left: DataFrame, right: DataFrame, keys: list[str],
    left_time: str, right_time: str, lower: timedelta, upper: timedelta, dense_rows: int = DENSE_ROWS,
) -> DataFrame:
    """``interval_join`` for keys that hold a large share of all rows within one stretch.

    The rows of each cell (key and stretch) are counted first, on both sides. A cell with more than
    ``dense_rows`` of one side is a grid of tiles: that side's rows are dealt to its rows or columns, and each
    meets the other side's rows in all tiles of its own. So no task gets more than about ``dense_rows`` of
    either side, and every pair meets in one tile. Dense cells are at most one per ``dense_rows`` rows, and
    their table carries no hint.
    """
    width = max(span_micros(upper - lower), 1)

    def stretch(time: Column) -> Column:
        return F.floor(micros(time) / F.lit(width)).cast("bigint")

    reach = F.sequence(stretch(F.col(left_time) + span(lower)), stretch(F.col(left_time) + span(upper)))
    near = left.withColumn("_stretch", F.explode(reach))
    placed = right.withColumn("_stretch", stretch(F.col(right_time)))
    cell = [*keys, "_stretch"]

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*cell).agg(F.count(F.lit(1)).alias(name))

    grid = counted(near, "_l").join(counted(placed, "_r"), cell).where((F.col("_l") > dense_rows) | (F.col("_r") > dense_rows)).select(
        *cell, F.ceil(F.col("_l") / dense_rows).cast("int").alias("_rows"), F.ceil(F.col("_r") / dense_rows).cast("int").alias("_columns"))

    def dealt(rows: DataFrame, mine: str, other: str, lengths: tuple[str, str]) -> DataFrame:
        sized = rows.join(grid, cell, "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("_rows", "_columns")})
        # By content, so that a task that runs again deals its rows as before.
        content = F.xxhash64(*[c for c in rows.columns if not isinstance(rows.schema[c].dataType, (T.MapType, T.VariantType))])
        return sized.withColumn(mine, F.pmod(content, F.col(lengths[0])).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(lengths[1]) - 1))).drop("_rows", "_columns")

    joined = dealt(near, "_row", "_column", ("_rows", "_columns")).join(
        dealt(placed, "_column", "_row", ("_columns", "_rows")), [*cell, "_row", "_column"])
    within = F.col(right_time).between(F.col(left_time) + span(lower), F.col(left_time) + span(upper))
    return joined.where(within).drop("_stretch", "_row", "_column")


def stream_interval_join(
    left: DataFrame, right: DataFrame, keys: list[str],
    left_time: str, right_time: str, lower: timedelta, upper: timedelta,
) -> DataFrame:
    """The interval join of two watermarked streams; the time bounds let state be dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = F.col(right_time).between(F.col(left_time) + span(lower), F.col(left_time) + span(upper))
    for key in keys:
        condition = (F.col(key) == F.col(f"_right_{key}")) & condition
    return left.join(renamed, condition).drop(*[f"_right_{k}" for k in keys])


def validity(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Each change with the ``valid_to`` at which the next change of its key takes over.

    ``order`` starts with the time of the change; the last change of a key stays open.
    """
    following = latest(F.col(order[0]), inclusive=False)
    return running(changes, keys, order, {"valid_to": following}, backwards=True)


def asof_join(
    left: DataFrame, versions: DataFrame, keys: list[str], *,
    left_order: tuple[str, str], version_order: tuple[str, str],
    small_rows: int = SMALL_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Left join of each row with the version of its key known at that moment.

    Null keys and times match nothing, on either side. Both orders are (time, unique whole number); a version of the same time is already
    known. Few versions are broadcast as validity intervals, so the left side does not
    move. Otherwise both sides are merged in time order and the last version is carried
    along. Version columns must not repeat names of the left side.
    """
    placed = [*keys, version_order[0]]
    versions = versions.where(_all_set(placed))
    if keys and is_small(versions, small_rows):
        return _asof_broadcast(left, versions, keys, left_order[0], version_order)
    return _asof_carried(left, versions, keys, left_order, version_order, block_rows)


def _all_set(columns: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns], F.lit(True))


def _asof_broadcast(left, versions, keys, time, version_order) -> DataFrame:
    at, tie = version_order
    # Few rows, as checked by the caller: one window per key is enough.
    following = F.lead(at).over(Window.partitionBy(*keys).orderBy(at, tie))
    spans = versions.withColumn("_to", following)
    spans = spans.withColumnsRenamed({k: f"_v_{k}" for k in keys}).withColumn("_from", F.col(at))
    known = (F.col(time) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(time) < F.col("_to")))
    for key in keys:
        known = (F.col(key) == F.col(f"_v_{key}")) & known
    joined = left.join(F.broadcast(spans), known, "left")
    return joined.drop("_from", "_to", *[f"_v_{k}" for k in keys])


def _asof_carried(left, versions, keys, left_order, version_order, block_rows) -> DataFrame:
    payload = [c for c in versions.columns if c not in keys]
    version = F.struct(*payload)
    key_columns = [F.col(k) for k in keys]
    kinds = {"version": versions.select(version.alias("v")).schema["v"].dataType,
             "row": left.select(F.struct("*").alias("r")).schema["r"].dataType}
    matchable = _all_set([*keys, left_order[0]])
    rows = left.where(matchable).select(
        *key_columns, F.col(left_order[0]).alias("_at"), F.lit(1).alias("_side"),
        F.col(left_order[1]).cast("bigint").alias("_tie"),
        F.struct("*").alias("_row"), F.lit(None).cast(kinds["version"]).alias("_version"),
    )
    changes = versions.select(
        *key_columns, F.col(version_order[0]).alias("_at"), F.lit(0).alias("_side"),
        F.col(version_order[1]).cast("bigint").alias("_tie"),
        F.lit(None).cast(kinds["row"]).alias("_row"), version.alias("_version"),
    )
    merged = running(
        rows.unionByName(changes), keys, ["_at", "_side", "_tie"],
        {"_known": latest(F.col("_version"))}, block_rows=block_rows,
    )
    found = merged.where(F.col("_side") == 1).select("_row.*", "_known.*")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in kinds["version"].fields]
    return found.unionByName(left.where(~matchable).select("*", *missing))


def lookup(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Left join with a dimension of unique keys; a missing row leaves nulls.

    No hint: the planner broadcasts a dimension only below its size threshold and otherwise
    shuffles, where adaptive execution splits partitions of an over-represented key.
    """
    keyed = dimension.withColumnRenamed(dimension_key, "_key")
    return facts.join(keyed, facts[fact_key] == F.col("_key"), "left").drop("_key")


def members(df: DataFrame, audience: DataFrame, keys: list[str]) -> DataFrame:
    """Only rows whose keys are in the audience."""
    return df.join(audience.select(*keys), keys, "left_semi")
