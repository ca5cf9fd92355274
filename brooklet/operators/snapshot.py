"""A snapshot in chunks and the changes made meanwhile, put together without a lock.

Chunks of a table are read one after another while its log goes on. Log positions are noted before and after
the reading of a chunk, its low and high marks. Whatever moment between the marks a row was read at, the
changes between them say what it was at the high mark; so a chunk counts as read at its high mark, all at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.sources.changelog import DELETE, READ, latest_per_key


def merged_snapshot(rows: DataFrame, marks: DataFrame, changes: DataFrame, keys: list[str], chunk: Column, position: str) -> DataFrame:
    """A change feed that begins with a snapshot: the columns of ``changes``.

    ``rows`` are the table's rows as they were read, with ``keys`` and the other columns of ``changes`` but
    ``operation`` and ``position``; ``marks`` holds ``chunk``, ``low`` and ``high``; ``chunk`` gives the chunk of a key, for rows
    and changes alike. ``changes`` is the log, its ``position`` unique within a key.

    Each key that exists at its chunk's high mark is one ``READ`` at that position; its changes after that follow
    as they are, and those up to it are in the ``READ``. Chunks may be read in any order and their marks overlap;
    changes of keys without a chunk are given as they are.

    Rows meet only the changes between their chunk's marks, the last one of each key, combined before the
    shuffle. Chunks are few next to rows; their table carries no hint.
    """
    marked = marks.select(F.col("chunk").alias("_chunk"), "low", "high")
    log = changes.withColumn("_chunk", chunk).join(marked, "_chunk", "left")
    after = log.where(F.col("high").isNull() | (F.col(position) > F.col("high"))).select(*changes.columns)
    within = log.where((F.col(position) > F.col("low")) & (F.col(position) <= F.col("high")))
    last = latest_per_key(within.select(*changes.columns, "high"), keys, [position])

    # Rows that no change between the marks overrides, and what those changes leave.
    renamed = last.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    untouched = rows.withColumn("_chunk", chunk).join(marked, "_chunk").join(renamed, same, "left_anti")
    body = [c for c in changes.columns if c not in ("operation", position)]
    read = [F.lit(READ).alias("operation"), F.col("high").alias(position)]
    seen = untouched.select(*body, *read).unionByName(last.where(F.col("operation") != DELETE).select(*body, *read))
    return seen.select(*changes.columns).unionByName(after)
