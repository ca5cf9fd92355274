"""Audiences from profiles, and the history of their members' behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.functions.predicates import EventColumns, EventSpec, event_predicate, profile_predicate
from brooklet.operators.joins import members


def select_audience(profiles: DataFrame, conditions: list[dict], user: str = "guid") -> DataFrame:
    """The ids of all profiles that meet every condition; one profile per user."""
    return profiles.where(profile_predicate(conditions, profiles.schema)).select(user)


def to_bitmaps(audience: DataFrame, user: str = "guid") -> DataFrame:
    """The audience as one fixed-size bitmap per bucket of 32,768 ids."""
    return audience.groupBy(F.bitmap_bucket_number(F.col(user)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(user))).alias("bits")
    )


def bitmap_members(bitmaps: DataFrame) -> DataFrame:
    """How many ids each stored bitmap holds."""
    return bitmaps.select("bucket", F.bitmap_count("bits").alias("members"))


def action_counts(
    history: DataFrame, audience: DataFrame, spec: EventSpec, columns: EventColumns, user: str = "guid"
) -> DataFrame:
    """How often each audience member did what ``spec`` asks for.

    Counts are combined per task before the shuffle, and the audience is applied to the
    counts: they are one row per user, so a busy user does not skew the join.
    """
    counts = history.where(event_predicate(spec, columns)).groupBy(user).agg(
        F.count(F.lit(1)).alias("action_count")
    )
    return members(counts, audience, [user])
