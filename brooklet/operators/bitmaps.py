"""Sets of ids in compressed containers, one per bucket of 32,768 ids.

A container is whichever is smallest: a sorted array of positions (two bytes each), runs of positions (four
bytes each), or a bitmap of 4,096 bytes. Columns: ``bucket``, ``kind``, ``ids``, ``runs``, ``bits`` and ``members``, and those
that name the set; only the column of the kind is filled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARRAY, RUNS, BITMAP = "array", "runs", "bitmap"
BITMAP_BYTES = 4096
WIDTH = 8 * BITMAP_BYTES


def to_containers(members: DataFrame, user: str = "guid", of: list[str] | None = None) -> DataFrame:
    """The sets of ``(*of, user)`` as containers; repeated and null ids do not count twice or at all.

    Positions are gathered per bucket, so a group has 32,768 of them at most, and are combined before the shuffle.
    """
    of = of or []
    position = F.bitmap_bit_position(F.col(user).cast("bigint")).cast("smallint")
    found = members.where(F.col(user).isNotNull()).groupBy(*of, F.bitmap_bucket_number(F.col(user).cast("bigint")).alias("bucket")).agg(
        F.array_sort(F.collect_set(position)).alias("_ids"), F.bitmap_construct_agg(F.bitmap_bit_position(F.col(user).cast("bigint"))).alias("_bits"))
    ids = F.col("_ids")
    first = F.filter(ids, lambda p, i: (i == 0) | (F.get(ids, i - 1) != p - 1))
    last = F.filter(ids, lambda p, i: (i == F.size(ids) - 1) | (F.get(ids, i + 1) != p + 1))
    sized = found.withColumns({"_first": first, "_last": last})
    kind = F.when(4 * F.size("_first") < F.least(2 * F.size("_ids"), F.lit(BITMAP_BYTES)), RUNS).when(
        2 * F.size("_ids") <= BITMAP_BYTES, ARRAY).otherwise(BITMAP)
    runs = F.transform(F.col("_first"), lambda p, i: F.struct(p.alias("first"), F.get("_last", i).alias("last")))
    return sized.withColumn("kind", kind).select(
        *of, "bucket", "kind", F.when(F.col("kind") == ARRAY, ids).alias("ids"), F.when(F.col("kind") == RUNS, runs).alias("runs"),
        F.when(F.col("kind") == BITMAP, F.col("_bits")).alias("bits"), F.size("_ids").cast("bigint").alias("members"))


def _bit(position: Column) -> Column:
    """Whether a position of ``bits`` is set."""
    byte = F.conv(F.hex(F.substring("bits", 1, BITMAP_BYTES).substr(F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def holds(position: Column) -> Column:
    """Whether a container has a position."""
    found = (
        F.when(F.col("kind") == ARRAY, F.array_contains("ids", position.cast("smallint")))
        .when(F.col("kind") == RUNS, F.exists("runs", lambda r: position.between(r["first"], r["last"])))
        .otherwise(_bit(position)))
    return F.coalesce(found, F.lit(False))


def positions() -> Column:
    """All positions of a container, in order; at most ``WIDTH``."""
    every = F.sequence(F.lit(0), F.lit(WIDTH - 1))
    return (
        F.when(F.col("kind") == ARRAY, F.transform("ids", lambda p: p.cast("int")))
        .when(F.col("kind") == RUNS, F.flatten(F.transform("runs", lambda r: F.sequence(r["first"].cast("int"), r["last"].cast("int")))))
        .otherwise(F.filter(every, _bit)))


def _id(bucket: Column, position: Column) -> Column:
    """The id at a position: buckets from 1 on hold ids above zero, upwards, the others those below, downwards."""
    return F.when(bucket > 0, (bucket - 1) * WIDTH + position + 1).otherwise(bucket * WIDTH - position)


def members_of(containers: DataFrame, user: str = "guid") -> DataFrame:
    """The ids of stored containers, beside the columns that name their sets."""
    names = [c for c in containers.columns if c not in ("bucket", "kind", "ids", "runs", "bits", "members")]
    spread = containers.select(*names, "bucket", F.explode(positions()).alias("_position"))
    return spread.select(*names, _id(F.col("bucket"), F.col("_position")).alias(user))


def only_members(rows: DataFrame, containers: DataFrame, user: str = "guid", of: list[str] | None = None) -> DataFrame:
    """Rows whose user is in the stored set (of the row's ``of``): a semi join that meets one container per row
    and probes it where it lies. Containers are a 32,768th of the ids, and carry no hint."""
    of = of or []
    stored = containers.withColumnsRenamed({c: f"_of_{c}" for c in of}).withColumnRenamed("bucket", "_bucket")
    id_ = F.col(user).cast("bigint")
    same = reduce(Column.__and__, [F.bitmap_bucket_number(id_) == F.col("_bucket"), *[F.col(c) == F.col(f"_of_{c}") for c in of]])
    return rows.join(stored, same & holds(F.bitmap_bit_position(id_)), "left_semi")


COMBINED = {"and": F.array_intersect, "or": F.array_union, "and not": F.array_except}


def combine(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Two sets as containers, combined by ``and``, ``or`` or ``and not``, bucket by bucket."""
    if how not in COMBINED:
        raise ValueError(f"unknown combination {how!r}")
    sides = [df.select("bucket", positions().alias(name)) for df, name in ((left, "_l"), (right, "_r"))]
    joined = sides[0].join(sides[1], "bucket", {"and": "inner", "or": "full", "and not": "left"}[how])
    none = F.array().cast("array<int>")
    kept = joined.select("bucket", F.explode(COMBINED[how](F.coalesce("_l", none), F.coalesce("_r", none))).alias("_position"))
    return to_containers(kept.select(_id(F.col("bucket"), F.col("_position")).alias("guid")))
