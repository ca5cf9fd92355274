"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in DataFrame expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brooklet.llm.common import free_name

# Fixed value: the multiplier of the published generator.
MULTIPLIER = 2862933555777941757

LOW_32, LOW_16 = 0xFFFFFFFF, 0xFFFF
#: Jumps tried for every row; rows that need more take them in a second, conditional loop.
FIRST_JUMPS = 48


def _bits(column: Column, mask: int) -> Column:
    return column.bitwiseAND(F.lit(mask).cast("long"))


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """``state * MULTIPLIER + 1`` modulo 2**64, on 32-bit halves so that nothing overflows."""
    m0, m1 = MULTIPLIER & LOW_16, MULTIPLIER >> 16 & LOW_16
    m2, m3 = MULTIPLIER >> 32 & LOW_16, MULTIPLIER >> 48
    middle = low * F.lit(m1)
    sum_low = low * F.lit(m0) + F.shiftleft(_bits(middle, LOW_16), 16) + F.lit(1)
    sum_high = (
        F.shiftright(sum_low, 32) + F.shiftright(middle, 16)
        + _bits(low * F.lit(m2), LOW_32) + F.shiftleft(_bits(low * F.lit(m3), LOW_16), 16)
        + _bits(high * F.lit(m0), LOW_32) + F.shiftleft(_bits(high * F.lit(m1), LOW_16), 16)
    )
    return _bits(sum_high, LOW_32), _bits(sum_low, LOW_32)


def jump_shards(key: Column, counts: Sequence[int]) -> Column:
    """A struct ``s0, s1, ...``: the shard of a 64-bit key for each of the shard counts.

    One walk serves all counts, as the jumps do not depend on the count: the shard is the last
    landing place below it. Each jump goes at least one shard further, so ``max(counts)`` jumps
    suffice; few rows need more than about ``ln(max(counts))``.
    """
    if not counts or min(counts) < 1:
        raise ValueError("shard counts must be positive")
    limit = max(counts)
    names = [f"s{i}" for i in range(len(counts))]

    def jump(state: Column, _: Column) -> Column:
        high, low = _next_state(state["high"], state["low"])
        stretch = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + F.lit(1)).cast("double")
        landing = F.floor((state["at"] + F.lit(1)).cast("double") * stretch).cast("long")
        moved = F.transform(F.array(F.struct(high.alias("high"), low.alias("low"), landing.alias("at"))), lambda x: F.struct(
            x["high"].alias("high"), x["low"].alias("low"), x["at"].alias("at"),
            *[F.when(x["at"] < n, x["at"]).otherwise(state[s]).alias(s) for s, n in zip(names, counts, strict=True)],
        ))[0]
        return F.when(state["at"] >= limit, state).otherwise(moved)

    zero = F.lit(0).cast("long")
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"), _bits(key, LOW_32).alias("low"), zero.alias("at"),
        *[zero.alias(s) for s in names],
    )
    first = min(limit, FIRST_JUMPS)
    walked = F.aggregate(F.array_repeat(F.lit(0), first), start, jump)
    if limit > first:
        walked = F.transform(F.array(walked), lambda s: F.when(s["at"] >= limit, s).otherwise(
            F.aggregate(F.array_repeat(F.lit(0), limit - first), s, jump)))[0]
    return F.transform(F.array(walked), lambda s: F.struct(*[s[n].cast("int").alias(n) for n in names]))[0]


def assign_shards(
    df: DataFrame, key: str, shards: int, column: str = "shard", grown: str | None = None,
) -> DataFrame:
    """Add ``column``, the shard of ``key`` among ``shards``, and ``grown``, that among one more.

    Only the key and the count decide, so equal keys share a shard, and a shard appended to the
    others receives the rows that move and no other shard does. Integer keys are used as they
    are, others by a 64-bit hash; a null key counts as 0. No shuffle.
    """
    kind = dict(df.dtypes)[key]
    number = F.col(key).cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(F.col(key))
    walk = jump_shards(F.coalesce(number, F.lit(0).cast("long")), [shards, shards + 1] if grown else [shards])
    name = free_name("walk", [*df.columns, column, grown or ""])
    out = df.withColumn(name, walk).withColumn(column, F.col(f"`{name}`.s0"))
    if grown:
        out = out.withColumn(grown, F.col(f"`{name}`.s1"))
    return out.drop(name)


def number_slots(
    df: DataFrame, group: str, identity: Sequence[str], column: str = "slot", rows_per_task: int = 500_000,
) -> DataFrame:
    """Add ``column``: 0, 1, 2, ... within each ``group``, without a gap.

    A group's rows are spread over blocks by a hash of the first ``identity`` column, an id, so
    that no task holds a whole group: block totals come first, read that column only, and give
    each block its offset; a row's slot is the offset plus its rank in the block. The order
    within a block is by ``identity``, nulls first; rows that are equal in it come in any order.
    Blocks hold about ``rows_per_task`` rows.
    """
    blocks = max(1, -(-df.count() // rows_per_task))
    given = [c for c in df.columns if c.lower() != column.lower()]
    here = df.select(
        F.struct(*[F.col(f"`{c}`") for c in given]).alias("row"), F.col(f"`{group}`").alias("group"),
        F.struct(*[F.col(f"`{c}`") for c in identity]).alias("identity"),
    ).withColumn("block", F.pmod(F.xxhash64(F.lit(17), f"identity.{identity[0]}"), F.lit(blocks)))
    before = W.partitionBy("group").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = here.groupBy("group", "block").agg(F.count(F.lit(1)).alias("rows")).select(
        F.col("group").alias("of"), F.col("block").alias("at"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("long").alias("offset"),
    )
    ranks = F.row_number().over(W.partitionBy("group", "block").orderBy("identity")).cast("long")
    same = F.col("group").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at"))
    return here.withColumn("rank", ranks).join(offsets, same).select(
        "row.*", (F.col("offset") + F.col("rank") - 1).alias(column))
