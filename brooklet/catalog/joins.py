"""Window, interval, as-of and dimension joins."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.catalog.registry import query
from brooklet.functions.times import age_years, order_time_columns, text
from brooklet.operators import joins
from brooklet.operators.wide_rows import order_wide, payment_wide
from brooklet.tables import load


def events_of(spark: SparkSession, sf: str, kind: str, prefix: str) -> DataFrame:
    events = load(spark, sf, "events").where(F.col("event_type") == kind)
    return events.select("user_id", F.col("event_id").alias(f"{prefix}_id"), F.col("ts").alias(f"{prefix}_ts"),
                         F.col("value").alias(f"{prefix}_value"))


WINDOW_INNER = """
    SELECT v.user_id, v.event_id AS view_id, c.event_id AS click_id
    FROM events v JOIN events c ON v.user_id = c.user_id AND CAST(v.ts AS DATE) = CAST(c.ts AS DATE)
    WHERE v.event_type = 'view' AND c.event_type = 'click'"""


@query(WINDOW_INNER)
def window_join_inner(spark: SparkSession, sf: str) -> DataFrame:
    views, clicks = events_of(spark, sf, "view", "view"), events_of(spark, sf, "click", "click")
    joined = joins.window_join(views, clicks, ["user_id"], "1 day", "view_ts", "click_ts")
    return joined.select("user_id", "view_id", "click_id")


@query("""
    SELECT s.user_id, s.event_id AS signup_id, coalesce(p.event_id, 0) AS purchase_id
    FROM (SELECT * FROM events WHERE event_type = 'signup') s
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
      ON s.user_id = p.user_id AND CAST(s.ts AS DATE) = CAST(p.ts AS DATE)""")
def window_cogroup_left(spark: SparkSession, sf: str) -> DataFrame:
    signups, purchases = events_of(spark, sf, "signup", "signup"), events_of(spark, sf, "purchase", "purchase")
    joined = joins.window_join(signups, purchases, ["user_id"], "1 day", "signup_ts", "purchase_ts", "left")
    return joined.select("user_id", "signup_id", F.coalesce("purchase_id", F.lit(0)).alias("purchase_id"))


@query("""
    SELECT o_orderkey AS order_id, o_orderstatus AS order_status, o_totalprice AS total_amount,
           o_custkey AS user_id, l_partkey AS sku_id, l_extendedprice AS order_price,
           CAST(l_quantity AS BIGINT) AS sku_num, l_linenumber AS detail_id,
           strftime(o_orderdate, '%Y-%m-%d') AS create_date,
           date_diff('day', o_orderdate, l_shipdate) AS days
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
     AND l_shipdate BETWEEN o_orderdate - INTERVAL 15 DAY AND o_orderdate + INTERVAL 30 DAY""")
def order_interval_join(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit(None).cast("double")
    orders = load(spark, sf, "orders")
    times = order_time_columns(F.col("o_orderdate"))
    orders = orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_ts"), F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"), F.col("o_custkey").alias("user_id"),
        F.lit(None).cast("bigint").alias("province_id"), text(F.col("o_orderdate")).alias("create_time"),
        times["create_date"].alias("create_date"), times["create_hour"].alias("create_hour"),
        *[none.alias(c) for c in ("activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
                                  "feight_fee")],
    ).alias("order"))
    details = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("detail_ts"), F.struct(
            F.col("l_linenumber").alias("id"), F.col("l_partkey").alias("sku_id"),
            F.lit(None).cast("string").alias("sku_name"), F.col("l_extendedprice").alias("order_price"),
            F.col("l_quantity").cast("bigint").alias("sku_num"),
            *[none.alias(c) for c in ("split_activity_amount", "split_coupon_amount", "split_total_amount")],
        ).alias("detail"))
    joined = joins.interval_join(orders, details, ["order_id"], "order_ts", "detail_ts",
                                 timedelta(days=-15), timedelta(days=30))
    wide = joined.select(*order_wide("order", "detail"),
                         F.datediff("detail_ts", "order_ts").cast("bigint").alias("days"))
    return wide.select("order_id", "order_status", "total_amount", "user_id", "sku_id", "order_price", "sku_num",
                       "detail_id", "create_date", "days")


PAYMENT_INTERVAL = """
    SELECT p.event_id AS payment_id, v.event_id AS order_id, p.user_id, p.value AS total_amount,
           strftime(p.ts, '%Y-%m-%d %H:%M:%S') AS payment_create_time,
           strftime(v.ts, '%Y-%m-%d %H:%M:%S') AS order_create_time
    FROM events p JOIN events v ON p.user_id = v.user_id
     AND v.ts BETWEEN p.ts - INTERVAL 15 HOUR AND p.ts + INTERVAL 30 MINUTE
    WHERE p.event_type = 'purchase' AND v.event_type = 'view'"""


def payment_rows(events: DataFrame) -> DataFrame:
    """Purchases as payments: join columns plus the record."""
    create = text(F.col("ts")).alias("create_time")
    return events.where(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("payment_ts"), F.struct(
        F.col("event_id").alias("id"), "user_id", F.col("value").alias("total_amount"), create).alias("payment"))


def wide_rows(events: DataFrame) -> DataFrame:
    """Views as wide order rows; same-named fields give way to the payment's."""
    create = text(F.col("ts")).alias("create_time")
    return events.where(F.col("event_type") == "view").select("user_id", F.col("ts").alias("wide_ts"), F.struct(
        F.col("event_id").alias("order_id"), "user_id", F.lit(0.0).alias("total_amount"), create).alias("wide"))


def paid(joined: DataFrame) -> DataFrame:
    return joined.select(*payment_wide(
        "payment", ["id", "user_id", "total_amount", "create_time"],
        "wide", ["order_id", "user_id", "total_amount", "create_time"]))


PAYMENT_SPAN = (timedelta(hours=-15), timedelta(minutes=30))


@query(PAYMENT_INTERVAL)
def payment_interval_join(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events")
    return paid(joins.interval_join(payment_rows(events), wide_rows(events), ["user_id"],
                                    "payment_ts", "wide_ts", *PAYMENT_SPAN))


ORDER_WIDE = """
    SELECT l_orderkey AS order_id, l_linenumber AS detail_id, l_partkey AS sku_id, o_custkey AS user_id,
           strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour,
           CAST(trunc(date_diff('day', o_orderdate, TIMESTAMP '2024-01-01') / 365) AS INTEGER) AS user_age,
           c_mktsegment AS user_segment, n_name AS province_name, r_name AS region_name,
           p_name AS sku_name, p_brand AS tm_name, s_name AS supplier_name
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey"""


def order_dimensions(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Dimensions with their own lookups already resolved, before any fact is touched."""
    provinces = joins.lookup(load(spark, sf, "nation"), load(spark, sf, "region"), "n_regionkey", "r_regionkey")
    users = joins.lookup(load(spark, sf, "customer"), provinces, "c_nationkey", "n_nationkey").select(
        "c_custkey", F.col("c_mktsegment").alias("user_segment"), F.col("n_name").alias("province_name"),
        F.col("r_name").alias("region_name"))
    orders = joins.lookup(load(spark, sf, "orders"), users, "o_custkey", "c_custkey")
    times = order_time_columns(F.col("o_orderdate"))
    orders = orders.select(
        "o_orderkey", F.col("o_custkey").alias("user_id"), "user_segment", "province_name", "region_name",
        times["create_date"].alias("create_date"), times["create_hour"].alias("create_hour"),
        age_years(F.col("o_orderdate"), F.lit("2024-01-01").cast("date")).alias("user_age"))
    parts = load(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("sku_name"), F.col("p_brand").alias("tm_name"))
    suppliers = load(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("supplier_name"))
    return {"orders": orders, "parts": parts, "suppliers": suppliers}


def widen(lineitem: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    rows = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    rows = joins.lookup(rows, dimensions["parts"], "l_partkey", "p_partkey")
    rows = joins.lookup(rows, dimensions["suppliers"], "l_suppkey", "s_suppkey")
    rows = joins.lookup(rows, dimensions["orders"], "l_orderkey", "o_orderkey")
    return rows.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("detail_id"),
        F.col("l_partkey").alias("sku_id"), "user_id", "create_date", "create_hour", "user_age", "user_segment",
        "province_name", "region_name", "sku_name", "tm_name", "supplier_name")


@query(ORDER_WIDE)
def order_wide_dims(spark: SparkSession, sf: str) -> DataFrame:
    return widen(load(spark, sf, "lineitem"), order_dimensions(spark, sf))


BROADCAST_ENRICH = """
    SELECT event_id, user_id, c_name AS name, coalesce(c_acctbal, 0) AS balance
    FROM events LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON user_id = c_custkey"""


def enrich(events: DataFrame, customer: DataFrame) -> DataFrame:
    known = customer.where(F.col("c_acctbal") > 0).select("c_custkey", "c_name", "c_acctbal")
    rows = joins.lookup(events, known, "user_id", "c_custkey")
    return rows.select("event_id", "user_id", F.col("c_name").alias("name"),
                       F.coalesce("c_acctbal", F.lit(0.0)).alias("balance"))


@query(BROADCAST_ENRICH)
def broadcast_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return enrich(load(spark, sf, "events"), load(spark, sf, "customer"))


@query("""
    WITH versions AS (
        SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1)
    SELECT s.l_orderkey AS order_id, s.l_suppkey AS supplier_id, s.l_partkey AS part_id,
           strftime(s.l_shipdate, '%Y-%m-%d') AS shipped, v.o_orderkey AS version_id,
           v.o_orderpriority AS priority
    FROM (SELECT l.*, o_custkey FROM lineitem l JOIN orders ON l_orderkey = o_orderkey) s
    ASOF LEFT JOIN versions v ON s.o_custkey = v.o_custkey AND s.l_shipdate >= v.o_orderdate""")
def dim_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments see the customer's priority as last changed by an order up to that day."""
    orders, lineitem = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    owners = orders.select("o_orderkey", "o_custkey")
    shipments = lineitem.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", "l_orderkey", "l_suppkey", "l_partkey", "l_shipdate",
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"))
    versions = orders.select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("version_id"),
                             F.col("o_orderpriority").alias("priority"))
    seen = joins.asof_join(shipments, versions, ["o_custkey"], left_order=("l_shipdate", "row_id"),
                           version_order=("o_orderdate", "version_id"))
    return seen.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("supplier_id"),
        F.col("l_partkey").alias("part_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
        "version_id", "priority")


@query("""
    SELECT v.event_id AS view_id, p.event_id AS purchase_id
    FROM (SELECT *, user_id % 50 AS k FROM events WHERE event_type = 'view') v
    JOIN (SELECT *, user_id % 50 AS k FROM events WHERE event_type = 'purchase') p
      ON v.k = p.k AND p.ts BETWEEN v.ts - INTERVAL 10 MINUTE AND v.ts + INTERVAL 1 HOUR""")
def interval_join_tiled(spark: SparkSession, sf: str) -> DataFrame:
    """Keys with very many rows in a stretch: their cells are cut into tiles."""
    events = load(spark, sf, "events").withColumn("k", F.col("user_id") % 50)
    views = events.where(F.col("event_type") == "view").select("k", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    bought = events.where(F.col("event_type") == "purchase").select("k", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))
    # Cells of this table are small, so the limit is as well: the tiles are used.
    joined = joins.tiled_interval_join(
        views, bought, ["k"], "view_ts", "purchase_ts", timedelta(minutes=-10), timedelta(hours=1), dense_rows=3)
    return joined.select("view_id", "purchase_id")
