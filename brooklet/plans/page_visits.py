"""Unique visits and bounces from the page-log topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brooklet.functions.times import from_millis
from brooklet.operators import visits
from brooklet.operators.routing import LOG_SCHEMA
from brooklet.plans.topic_sink import Broker, to_topics
from brooklet.sources.topics import to_records
from brooklet.streaming import runner, stateful

# Topics, and the disorder allowed in page logs.
TOPIC_PAGE = "dwd_page_log"
TOPIC_UNIQUE_VISIT, TOPIC_JUMP = "dwm_unique_visit", "dwm_user_jump_detail"
DISORDER = "1 second"

ORDER = ["at", "offset"]


def pages(records: DataFrame) -> DataFrame:
    """Page logs with their device, time and last page; ``value`` is the log itself."""
    parsed = records.select("offset", "value", F.from_json("value", LOG_SCHEMA).alias("log"))
    return parsed.select(
        "offset", "value", F.col("log.common.mid").alias("mid"), from_millis(F.col("log.ts")).alias("at"),
        F.col("log.page.last_page_id").alias("last_page_id"))


def entry() -> Column:
    return visits.is_entry(F.col("last_page_id"))


def unique_visits(records: DataFrame) -> DataFrame:
    return visits.first_visits(pages(records), "mid", "at", ORDER, entry())


def jumps(records: DataFrame) -> DataFrame:
    return visits.bounces(pages(records), "mid", "at", ORDER, entry())


def start_unique_visits(records: DataFrame, broker: Broker, checkpoint: str) -> StreamingQuery:
    """First arriving entry page per device and day."""
    first = stateful.first_visits(pages(records), "mid", "at", entry())
    out = to_records(first, TOPIC_UNIQUE_VISIT, F.col("value"), F.col("mid"))
    return runner.start(out, to_topics(broker, lambda batch: {TOPIC_UNIQUE_VISIT: batch}), checkpoint)


def start_jumps(records: DataFrame, broker: Broker, checkpoint: str) -> StreamingQuery:
    left = stateful.bounces(pages(records), "mid", "at", "offset", entry(), visits.BOUNCE_LIMIT, DISORDER,
                            F.col("value"))
    out = to_records(left, TOPIC_JUMP, F.col("payload"), F.col("mid"))
    return runner.start(out, to_topics(broker, lambda batch: {TOPIC_JUMP: batch}), checkpoint)
