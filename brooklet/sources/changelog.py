"""Database change feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Operations of a change record.
READ, CREATE, UPDATE, DELETE, TRUNCATE = "READ", "CREATE", "UPDATE", "DELETE", "TRUNCATE"

# Row images keep the types of their JSON values.
IMAGE = "map<string,variant>"


def flatten(df: DataFrame, topic: Column, operation: Column, before: Column, after: Column) -> DataFrame:
    """``server.database.table`` plus JSON row images to one flat change record.

    A missing image becomes an empty map.
    """
    names = F.split(topic, r"\.")
    empty = F.from_json(F.lit("{}"), IMAGE)
    return df.select(
        F.get(names, F.lit(1)).alias("database"), F.get(names, F.lit(2)).alias("table"),
        operation.alias("operation"),
        F.coalesce(F.from_json(before, IMAGE), empty).alias("before"),
        F.coalesce(F.from_json(after, IMAGE), empty).alias("after"),
    )


def read_changelog(
    changes: DataFrame, startup: str, keys: list[str], order: list[str], cutoff: Column
) -> DataFrame:
    """``latest``: the changes after the cutoff. ``initial``: before them, as READ records,
    the rows that live at the cutoff. ``order`` starts with the time of the change.
    """
    later = changes.where(F.col(order[0]) > cutoff)
    if startup == "latest":
        return later
    if startup != "initial":
        raise ValueError(f"unknown startup mode {startup!r}")
    snapshot = current_state(changes.where(F.col(order[0]) <= cutoff), keys, order)
    return snapshot.withColumn("operation", F.lit(READ)).select(*changes.columns).unionByName(later)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key; combined before the shuffle, so busy keys cost nothing extra."""
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def current_state(
    changes: DataFrame, keys: list[str], order: list[str], deleted: Column | None = None
) -> DataFrame:
    """Live rows of a changelog: the last change of each key, unless it deletes it."""
    if deleted is None:
        deleted = F.col("operation") == DELETE
    return latest_per_key(changes, keys, order).where(~deleted)


def changelog_view(changes: DataFrame, name: str, columns: dict[str, str], image: str = "after") -> DataFrame:
    """Declare typed columns over the row image and register them for SQL; keeps ``operation``."""
    typed = changes.select(
        "operation",
        *[F.try_element_at(F.col(image), F.lit(c)).try_cast(kind).alias(c) for c, kind in columns.items()],
    )
    typed.createOrReplaceTempView(name)
    return typed
