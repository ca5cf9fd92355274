"""Queries whose keys are few and large, one of them null, so that every key is cut into blocks."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.catalog import rules, visits, windows as window_queries
from brooklet.catalog.registry import ORACLES, query
from brooklet.operators import sequences, visits as visit_ops, windows
from brooklet.operators.ordered import running, running_count
from brooklet.tables import load

LEAST_ROWS, BLOCKS = 100, 1_000
ORDER = window_queries.ORDER


def over_large_keys(sql: str, key: str = "nullif(user_id % 4, 0)") -> str:
    return sql.replace("FROM events", f"FROM (SELECT * REPLACE ({key} AS user_id) FROM events) AS events")


def large_keys(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").withColumn("user_id", F.expr("nullif(user_id % 4, 0)"))


def block_rows(df: DataFrame) -> int:
    """Rows of a block: about ``BLOCKS`` blocks whatever the number of rows, so that neither the sample
    nor the cut points grow with it; on small tables, blocks of ``LEAST_ROWS``."""
    return max(LEAST_ROWS, df.count() // BLOCKS)


@query("""SELECT event_id, row_number() OVER (PARTITION BY nullif(user_id % 4, 0) ORDER BY ts, event_id) AS n,
                 min(value) OVER (PARTITION BY nullif(user_id % 4, 0) ORDER BY ts, event_id) AS least FROM events""")
def running_blocks(spark: SparkSession, sf: str) -> DataFrame:
    events = large_keys(spark, sf).select("user_id", *ORDER, "value")
    size = block_rows(events)
    counted = running(events, ["user_id"], ORDER, {"n": running_count()}, block_rows=size)
    least = windows.running_argmin(counted, ["user_id"], ORDER, "value", size)
    return least.select("event_id", "n", F.col("least.value").alias("least"))


@query(over_large_keys(ORACLES["session_count_keyed"]))
def session_count_blocks(spark: SparkSession, sf: str) -> DataFrame:
    events = large_keys(spark, sf)
    sessions = windows.session_windows(
        events, ["user_id"], "ts", ORDER, F.lit(timedelta(hours=6)), window_queries.counts(), block_rows(events))
    return window_queries.session_rows(sessions, "user_id")


@query(over_large_keys(ORACLES["count_window_keyed"]))
def count_window_blocks(spark: SparkSession, sf: str) -> DataFrame:
    aggregates = {**window_queries.counts(), "first_event_id": F.min("event_id")}
    events = large_keys(spark, sf)
    return windows.count_windows(events, ["user_id"], ORDER, 10, aggregates, block_rows(events))


@query(ORACLES["count_window_global"])
def count_window_global_blocks(spark: SparkSession, sf: str) -> DataFrame:
    aggregates = {**window_queries.counts(), "first_event_id": F.min("event_id")}
    events = load(spark, sf, "events")
    return windows.count_windows(events, [], ORDER, 10, aggregates, block_rows(events))


@query(over_large_keys(ORACLES["count_slide_keyed"]))
def count_slide_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of ten rows over stretches of seven, which are widened to fit."""
    events = large_keys(spark, sf)
    fired = windows.sliding_count_windows(
        events, ["user_id"], ORDER, 10, 2, window_queries.counts(), block_rows(events), stretch_rows=7)
    return fired.select("user_id", "window_no", "n", "cents")


@query(over_large_keys(ORACLES["bounce_detail"]))
def bounce_blocks(spark: SparkSession, sf: str) -> DataFrame:
    pages = visits.entries(large_keys(spark, sf))
    entry = visit_ops.is_entry(F.col("last_page_id"))
    left = visit_ops.bounces(pages, "user_id", "ts", ORDER, entry, timedelta(hours=6), block_rows(pages))
    return left.select("event_id", "user_id", "reason")


@query(over_large_keys(ORACLES["sequence_progress"], "user_id % 4"))
def sequence_progress_blocks(spark: SparkSession, sf: str) -> DataFrame:
    events = rules.history(spark, sf).withColumn("guid", F.col("guid") % 4)
    walked = sequences.sequence_progress(rules.stepping(events), ["guid"], rules.ORDER, 3, block_rows=block_rows(events))
    return walked.select(F.col("event_pk").alias("event_id"), "guid", "step", "n")
