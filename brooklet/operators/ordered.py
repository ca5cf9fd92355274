"""Running values over the ordered rows of a key, also for keys too large for one task.

A plain window puts all rows of a key into one task. That is the right plan for ordinary
keys, but not for a key, source or the keyless case holding a large share of the table.
So a small deterministic sample of the key and order columns is ranked first. Keys that
show up in it often enough are cut into blocks along their order; all others stay whole.
Each block is then one window partition, block totals (a map-side combined aggregate) are
prefix-combined per key, and the small result is added back to the rows of the block.

There are at most ``rows / block_rows`` cut points, a few hundred thousand for 10**12 rows. They are
collected, so their number is known before anything of their size is broadcast: beyond
``HINTED_BLOCKS`` no hint is given. The sample only places the cuts: every row takes part in
the result. A null key is a key like any other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_ROWS = 4_000_000
SAMPLES_PER_BLOCK = 16
GROUP_BLOCKS = 64
HINTED_BLOCKS = 200_000

BLOCK = "_block"


@dataclass(frozen=True)
class Running:
    """One running value: an aggregate, and how the part before a block joins the part in it."""

    value: Column
    aggregate: Callable[[Column], Column]
    combine: Callable[[Column, Column], Column]
    inclusive: bool = True
    by_position: bool = False
    empty: Column | None = None

    def over(self, window: WindowSpec) -> Column:
        end = Window.currentRow if self.inclusive else -1
        result = self.aggregate(self.value).over(window.rowsBetween(Window.unboundedPreceding, end))
        return result if self.empty is None else F.coalesce(result, self.empty)

    def of_block(self, position: Column, backwards: bool) -> Column:
        if not self.by_position:
            return self.aggregate(self.value)
        pick = F.min_by if backwards else F.max_by
        return pick(self.value, F.when(self.value.isNotNull(), position))


def running_sum(value: Column, inclusive: bool = True) -> Running:
    def add(before: Column, here: Column) -> Column:
        return F.coalesce(before, F.lit(0)) + here

    return Running(value, F.sum, add, inclusive, empty=F.lit(0))


def running_count(inclusive: bool = True) -> Running:
    return running_sum(F.lit(1).cast("bigint"), inclusive)


def running_max(value: Column, inclusive: bool = True) -> Running:
    return Running(value, F.max, F.greatest, inclusive)


def running_min(value: Column, inclusive: bool = True) -> Running:
    return Running(value, F.min, F.least, inclusive)


def latest(value: Column, inclusive: bool = True) -> Running:
    """The last non-null value so far."""
    return Running(
        value, lambda v: F.last(v, ignorenulls=True),
        lambda before, here: F.coalesce(here, before), inclusive, by_position=True,
    )


@dataclass(frozen=True)
class Splits:
    """Cut points of the large keys: each row holds the key columns and a sorted array."""

    rows: list[Row]
    schema: T.StructType
    keys: list[str]
    order: list[str]

    def table(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.createDataFrame(self.rows, self.schema)

    def hinted(self, per_block: DataFrame) -> DataFrame:
        """A table of at most one row per block, to be broadcast if there are few enough."""
        blocks = sum(len(row["_cuts"]) + 1 for row in self.rows)
        return F.broadcast(per_block) if blocks <= HINTED_BLOCKS else per_block

    def large_only(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` that belong to large keys."""
        if not self.keys:
            return df
        return join_small(df, self.hinted(self.table(df).select(*self.keys)), self.keys, "left_semi")


def join_small(df: DataFrame, small: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys, null being equal to null; the right side's keys are dropped."""
    renamed = small.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = F.lit(True)
    for key in keys:
        same = F.col(key).eqNullSafe(F.col(f"_k_{key}")) & same
    joined = df.join(renamed, same, how)
    return joined if how == "left_semi" else joined.drop(*[f"_k_{k}" for k in keys])


def find_splits(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    block_rows: int = BLOCK_ROWS,
) -> Splits:
    """Cut points for the keys of ``df`` that hold more than about ``block_rows`` rows.

    Runs one job that reads only the key and order columns. The sample is chosen by a hash
    of these columns, so equal tuples are taken or left together and are counted once.
    """
    per_block = min(SAMPLES_PER_BLOCK, block_rows)
    stride = max(block_rows // per_block, 1)
    sample = df.select(*keys, *order)
    if stride > 1:
        sample = sample.where(F.pmod(F.xxhash64(*keys, *order), F.lit(stride)) == 0)
    sample = sample.distinct().select(*keys, F.struct(*order).alias("_pos"))
    # The sample of one key is a tiny share of it, so one task can rank it.
    group = partitioned(keys)
    ranked = sample.select(
        *keys, "_pos",
        F.row_number().over(group.orderBy("_pos")).alias("_rank"),
    )
    cuts = (
        ranked.where(F.pmod(F.col("_rank"), F.lit(per_block)) == 0)
        .groupBy(*keys).agg(F.sort_array(F.collect_list("_pos")).alias("_cuts"))
        .where(F.size("_cuts") > 0)
    )
    return Splits(cuts.collect(), cuts.schema, keys, order)


def partitioned(columns: list[str]) -> WindowSpec:
    return Window.partitionBy(*columns) if columns else Window.partitionBy(F.lit(0))


def _stretches(splits: Splits, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From-to ranges of all blocks, and of groups of ``GROUP_BLOCKS`` neighbouring blocks."""
    cuts = F.col("_cuts")
    open_end = F.array(F.lit(None).cast(splits.schema["_cuts"].dataType.elementType))
    ends = F.arrays_zip(F.concat(open_end, cuts).alias("_from"), F.concat(cuts, open_end).alias("_to"))
    blocks = splits.table(df).select(*splits.keys, F.posexplode(ends).alias(BLOCK, "_ends"))
    blocks = blocks.select(
        *splits.keys, BLOCK, F.floor(F.col(BLOCK) / GROUP_BLOCKS).alias("_group"),
        F.col("_ends")["_from"].alias("_from"), F.col("_ends")["_to"].alias("_to"))
    groups = blocks.groupBy(*splits.keys, "_group").agg(
        F.min_by("_from", BLOCK).alias("_from"), F.max_by("_to", BLOCK).alias("_to"))
    return blocks, groups


def with_blocks(df: DataFrame, splits: Splits) -> DataFrame:
    """``df`` with its block number; rows of keys without cut points are in block 0.

    Rows of large keys are placed in two steps, first in a group of blocks and then in one
    of its blocks, so that a row is compared with a few ranges and not with all.
    """
    if not splits.rows:
        return df.withColumn(BLOCK, F.lit(0))
    here = F.struct(*splits.order)
    blocks, groups = _stretches(splits, df)

    def place(rows: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
        within = (F.col("_from").isNull() | (here >= F.col("_from"))) & (
            F.col("_to").isNull() | (here < F.col("_to")))
        renamed = ranges.withColumnsRenamed({k: f"_k_{k}" for k in keys})
        for key in keys:
            within = F.col(key).eqNullSafe(F.col(f"_k_{key}")) & within
        return rows.join(splits.hinted(renamed), within, "left").drop("_from", "_to", *[f"_k_{k}" for k in keys])

    if splits.keys:
        grouped = place(df, groups, splits.keys)
    else:
        # The one list of group starts is short, so it can be looked through as a whole.
        starts = groups.agg(F.collect_list("_from")).scalar()
        number = F.size(F.filter("_starts", lambda start: start <= here)).cast("bigint")
        grouped = df.withColumn("_starts", starts).withColumn("_group", number).drop("_starts")
    placed = place(grouped, blocks, [*splits.keys, "_group"]).drop("_group")
    return placed.withColumn(BLOCK, F.coalesce(BLOCK, F.lit(0)))


def spread(df: DataFrame, splits: Splits) -> DataFrame:
    """Rows moved together by key and block. The shuffle is asked for by name: rows already
    hashed by key alone would otherwise count as placed, with a large key in one task."""
    return df.repartition(*splits.keys, BLOCK)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, Running],
    *,
    backwards: bool = False,
    splits: Splits | None = None,
    block_rows: int = BLOCK_ROWS,
    keep_block: bool = False,
) -> DataFrame:
    """``df`` plus one column per running value, over ``order`` within ``keys``.

    ``order`` must be unique within a key for results to be repeatable. ``backwards`` runs
    from the last row to the first, so that an exclusive ``latest`` is the following row.
    Pass ``splits`` to reuse cut points found earlier for the same keys and order; rows that
    still carry their block from ``keep_block`` then stay where they are.
    """
    if splits is None:
        splits = find_splits(df, keys, order, block_rows)
    ordering = [F.col(c).desc() if backwards else F.col(c).asc() for c in order]

    if not splits.rows:
        window = partitioned(keys).orderBy(*ordering)
        return df.withColumns({name: value.over(window) for name, value in values.items()})

    rows, large = df, splits.large_only(df)
    if BLOCK not in df.columns:
        rows, large = spread(with_blocks(df, splits), splits), with_blocks(large, splits)
    window = partitioned([*keys, BLOCK]).orderBy(*ordering)
    rows = rows.withColumns({f"_here_{name}": value.over(window) for name, value in values.items()})
    before = _before_block(large, values, splits, backwards)
    joined = join_small(rows, splits.hinted(before), [*keys, BLOCK], "left").withColumns({
        name: value.combine(F.col(f"_before_{name}"), F.col(f"_here_{name}"))
        for name, value in values.items()
    })
    columns = [c for c in df.columns if c != BLOCK]
    return joined.select(*columns, *values, *([BLOCK] if keep_block else []))


def _before_block(
    large: DataFrame, values: dict[str, Running], splits: Splits, backwards: bool
) -> DataFrame:
    """For each block of a large key, the combined value of all blocks ahead of it."""
    keys = splits.keys
    position = F.struct(*splits.order)
    totals = large.groupBy(*keys, BLOCK).agg(
        *[value.of_block(position, backwards).alias(f"_total_{name}") for name, value in values.items()]
    )
    # One row per block.
    number = F.col(BLOCK).desc() if backwards else F.col(BLOCK).asc()
    ahead = partitioned(keys).orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, BLOCK, *[
        value.aggregate(F.col(f"_total_{name}")).over(ahead).alias(f"_before_{name}")
        for name, value in values.items()
    ])
