"""Unique visits, bounces and new-user flags of page logs."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.functions.times import day, span
from brooklet.operators.ordered import BLOCK_ROWS, latest, running

# Fixed value: how long an entry may wait for the next page.
BOUNCE_LIMIT = timedelta(seconds=10)


def is_entry(last_page_id: Column) -> Column:
    return last_page_id.isNull() | (F.length(last_page_id) == 0)


def correct_new_flag(df: DataFrame, device: str, order: list[str], flag: str = "is_new") -> DataFrame:
    """Only the first row of a device that claims to be new keeps ``"1"``; later claims get ``"0"``.

    First claims come from a combined aggregate and are matched back on the whole row
    identity (device and unique order), so a busy device spreads over its own rows. Rows
    without a claim do not move. The null device is a device, and a null time comes first.
    """
    claims = df.where(F.col(flag) == "1")
    first = claims.groupBy(device).agg(F.min(F.struct(*order)).alias("_first"))
    row = [device, *order]
    first = first.select(device, "_first.*").select(*[F.col(c).alias(f"_f_{c}") for c in row], F.lit(True).alias("_is_first"))
    same = [F.col(c).eqNullSafe(F.col(f"_f_{c}")) for c in row]
    decided = claims.join(first, reduce(Column.__and__, same), "left").withColumn(
        flag, F.when(F.col("_is_first"), "1").otherwise("0")
    )
    others = df.where(F.coalesce(F.col(flag) != "1", F.lit(True)))
    return decided.select(*df.columns).unionByName(others)


def first_visits(
    df: DataFrame, device: str, time: str, order: list[str], entry: Column
) -> DataFrame:
    """The first entry page of each device and day."""
    rest = [c for c in df.columns if c != device]
    visits = df.where(entry).withColumn("visit_date", day(F.col(time)))
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return visits.groupBy(device, "visit_date").agg(first.alias("_first")).select(device, "visit_date", "_first.*")


def daily_active(visits: DataFrame) -> DataFrame:
    return visits.groupBy("visit_date").agg(F.count(F.lit(1)).alias("active_users"))


def bounces(
    df: DataFrame, device: str, time: str, order: list[str], entry: Column,
    limit: timedelta = BOUNCE_LIMIT, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Entry pages not followed, within ``limit``, by a further page of the same visit.

    That is: followed by another entry, by a row ``limit`` or more later, or by nothing.
    ``reason`` tells matched pairs of entries from timed-out ones.
    """
    marked = df.withColumn("_entry", entry)
    follower = latest(F.struct(F.col(time).alias("at"), F.col("_entry").alias("entry")), inclusive=False)
    rows = running(marked, [device], order, {"_next": follower}, backwards=True, block_rows=block_rows)
    timed_out = F.col("_next").isNull() | (F.col("_next.at") - F.col(time) >= span(limit))
    reason = F.when(timed_out, "timeout").when(F.col("_next.entry"), "reentry")
    out = rows.where("_entry").withColumn("reason", reason)
    return out.where(F.col("reason").isNotNull()).drop("_entry", "_next")
