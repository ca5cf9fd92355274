"""New-user flags, unique visits and bounces."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.catalog.registry import query
from brooklet.operators import visits
from brooklet.tables import load

ORDER = ["ts", "event_id"]


def claims(events: DataFrame) -> DataFrame:
    is_new = F.when(F.col("event_type") == "signup", "1").otherwise("0")
    return events.select("user_id", *ORDER, is_new.alias("is_new"))


NEW_USER = """
    SELECT event_id, user_id, CASE WHEN event_type = 'signup' AND row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 THEN '1' ELSE '0' END AS is_new
    FROM events"""


@query(NEW_USER)
def new_user_flag(spark: SparkSession, sf: str) -> DataFrame:
    flagged = visits.correct_new_flag(claims(load(spark, sf, "events")), "user_id", ORDER)
    return flagged.select("event_id", "user_id", "is_new")


def entries(events: DataFrame) -> DataFrame:
    """Views are entry pages; other pages came from one."""
    last_page = F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))
    return events.select("user_id", *ORDER, last_page.alias("last_page_id"))


def visit_rows(spark: SparkSession, sf: str) -> DataFrame:
    pages = entries(load(spark, sf, "events"))
    return visits.first_visits(pages, "user_id", "ts", ORDER, visits.is_entry(F.col("last_page_id")))


FIRST_VISIT = """
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS visit_date, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
        FROM events WHERE event_type = 'view') WHERE rn = 1"""


@query(FIRST_VISIT)
def first_visit_daily(spark: SparkSession, sf: str) -> DataFrame:
    return visit_rows(spark, sf).select(
        "user_id", F.date_format("visit_date", "yyyy-MM-dd").alias("visit_date"), "event_id")


@query("""
    SELECT strftime(ts, '%Y-%m-%d') AS visit_date, count(DISTINCT user_id) AS active_users
    FROM events WHERE event_type = 'view' GROUP BY 1""")
def daily_active_users(spark: SparkSession, sf: str) -> DataFrame:
    active = visits.daily_active(visit_rows(spark, sf))
    return active.withColumn("visit_date", F.date_format("visit_date", "yyyy-MM-dd"))


BOUNCE = """
    SELECT event_id, user_id, CASE WHEN nts IS NULL OR nts - ts >= INTERVAL 6 HOUR THEN 'timeout'
                                   ELSE 'reentry' END AS reason
    FROM (SELECT *, lead(ts) OVER w AS nts, lead(event_type) OVER w AS ntype
          FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE event_type = 'view' AND (nts IS NULL OR nts - ts >= INTERVAL 6 HOUR OR ntype = 'view')"""


@query(BOUNCE)
def bounce_detail(spark: SparkSession, sf: str) -> DataFrame:
    pages = entries(load(spark, sf, "events"))
    entry = visits.is_entry(F.col("last_page_id"))
    left = visits.bounces(pages, "user_id", "ts", ORDER, entry, timedelta(hours=6))
    return left.select("event_id", "user_id", "reason")
