"""Change feeds: envelopes, keyed state and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.catalog.registry import query
from brooklet.operators.snapshot import merged_snapshot
from brooklet.plans.change_routing import routed_as_of, route_changes
from brooklet.sources import changelog
from brooklet.tables import load


def operation():
    """Order status as the kind of change."""
    status = F.col("o_orderstatus")
    return F.when(status == "O", "CREATE").when(status == "P", "UPDATE").otherwise("DELETE")


OPERATION = "CASE o_orderstatus WHEN 'O' THEN 'CREATE' WHEN 'P' THEN 'UPDATE' ELSE 'DELETE' END"


def envelopes(orders: DataFrame) -> DataFrame:
    """Orders as a change feed: a create has no before-image, a delete no after-image."""
    image = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderpriority"))
    raw = orders.select(
        F.lit("mysql.shop.orders").alias("topic"), operation().alias("op"),
        F.when(F.col("o_orderstatus") != "O", image).alias("b"),
        F.when(F.col("o_orderstatus") != "F", image).alias("a"))
    return changelog.flatten(raw, F.col("topic"), F.col("op"), F.col("b"), F.col("a"))


def flat_rows(changes: DataFrame) -> DataFrame:
    def key(image):
        return F.try_element_at(F.col(image), F.lit("o_orderkey"))

    return changes.select(
        "database", "table", "operation", F.coalesce(key("after"), key("before")).cast("bigint").alias("order_id"),
        F.size("before").alias("before_fields"), F.size("after").alias("after_fields"),
        F.try_element_at(F.col("after"), F.lit("o_orderpriority")).cast("string").alias("priority"))


CDC_FLATTEN = f"""
    SELECT 'shop' AS "database", 'orders' AS "table", {OPERATION} AS operation, o_orderkey AS order_id,
           CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 3 END AS before_fields,
           CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 3 END AS after_fields,
           CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority
    FROM orders"""


@query(CDC_FLATTEN)
def cdc_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return flat_rows(envelopes(load(spark, sf, "orders")))


ORDER = ["o_orderdate", "o_orderkey"]


def order_changes(orders: DataFrame) -> DataFrame:
    return orders.select("o_custkey", *ORDER, operation().alias("operation"))


LATEST_STATE = f"""
    SELECT o_custkey, o_orderkey, {OPERATION} AS operation FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
        AND o_orderstatus <> 'F'"""


@query(LATEST_STATE)
def cdc_latest_state(spark: SparkSession, sf: str) -> DataFrame:
    changes = order_changes(load(spark, sf, "orders"))
    return changelog.current_state(changes, ["o_custkey"], ORDER).select("o_custkey", "o_orderkey", "operation")


@query(f"""
    WITH later AS (SELECT {OPERATION} AS operation FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01')
    SELECT 'latest' AS mode, operation, count(*) AS n FROM later GROUP BY 2
    UNION ALL SELECT 'initial', operation, count(*) FROM later GROUP BY 2
    UNION ALL SELECT 'initial', 'READ', count(*) FROM (
        SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
            AND o_orderstatus <> 'F')""")
def cdc_startup_modes(spark: SparkSession, sf: str) -> DataFrame:
    changes = order_changes(load(spark, sf, "orders"))
    cutoff = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    counts = [
        changelog.read_changelog(changes, mode, ["o_custkey"], ORDER, cutoff)
        .groupBy(F.lit(mode).alias("mode"), "operation").agg(F.count("*").alias("n"))
        for mode in ("initial", "latest")
    ]
    return counts[0].unionByName(counts[1])


CONFIG = [
    ("orders", "CREATE", "kafka", "dwd_order_info", "o_orderkey,o_custkey", "o_orderkey", None),
    ("orders", "UPDATE", "hbase", "dim_order", "o_orderkey,o_orderpriority", "o_orderkey", None),
]
CONFIG_SCHEMA = (
    "source_table STRING, operate_type STRING, sink_type STRING, sink_table STRING, sink_columns STRING,"
    " sink_pk STRING, sink_extend STRING"
)


def configured(spark: SparkSession, changes: DataFrame) -> DataFrame:
    routed = route_changes(changes, spark.createDataFrame(CONFIG, CONFIG_SCHEMA))
    return routed.where(F.col("sink_table").isNotNull())


CONFIG_ROUTE = """
    SELECT 'orders' AS "table", CASE o_orderstatus WHEN 'O' THEN 'CREATE' ELSE 'UPDATE' END AS operation,
           CASE o_orderstatus WHEN 'O' THEN 'dwd_order_info' ELSE 'dim_order' END AS sink_table,
           CASE o_orderstatus WHEN 'O' THEN 'kafka' ELSE 'hbase' END AS sink_type,
           CASE o_orderstatus
               WHEN 'O' THEN '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || '}'
               ELSE '{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}'
           END AS payload
    FROM orders WHERE o_orderstatus <> 'F'"""


@query(CONFIG_ROUTE)
def config_route(spark: SparkSession, sf: str) -> DataFrame:
    routed = configured(spark, envelopes(load(spark, sf, "orders")))
    return routed.select("table", "operation", "sink_table", "sink_type", F.to_json("after").alias("payload"))


@query("""
    WITH config AS (SELECT user_id, ts, event_id, event_type FROM events WHERE event_type IN ('signup', 'error'))
    SELECT e.event_id, CASE WHEN c.event_type = 'signup' THEN c.event_id END AS config_id,
           CASE WHEN c.event_type = 'signup' THEN 'routed' ELSE 'unrouted' END AS route
    FROM (SELECT * FROM events WHERE event_type NOT IN ('signup', 'error')) e
    ASOF LEFT JOIN config c ON e.user_id = c.user_id AND e.ts >= c.ts""")
def config_asof_route(spark: SparkSession, sf: str) -> DataFrame:
    """Sign-ups put a user's config, errors delete it; other events take the one in force."""
    events = load(spark, sf, "events")
    kind = F.col("event_type")
    config = events.where(kind.isin("signup", "error")).select(
        "user_id", F.col("ts").alias("config_ts"), F.col("event_id").alias("config_id"),
        F.when(kind == "error", "DELETE").otherwise("CREATE").alias("config_operation"))
    records = events.where(~kind.isin("signup", "error")).select("user_id", "ts", "event_id")
    routed = routed_as_of(records, config, ["user_id"], ("ts", "event_id"), ("config_ts", "config_id"),
                          "config_operation", ["config_id"])
    route = F.when(F.col("config_id").isNotNull(), "routed").otherwise("unrouted")
    return routed.select("event_id", "config_id", route.alias("route"))


@query(f"""
    SELECT segment, count(*) AS n, min(o_orderkey) AS least_order FROM (
        SELECT c_mktsegment AS segment, o_orderkey FROM customer JOIN ({LATEST_STATE}) ON o_custkey = c_custkey)
    GROUP BY 1""")
def changelog_sql(spark: SparkSession, sf: str) -> DataFrame:
    """A changelog declared as a SQL table, joined and aggregated in SQL."""
    orders = load(spark, sf, "orders")
    image = F.from_json(F.to_json(F.struct("o_custkey", "o_orderkey", "o_orderdate")), changelog.IMAGE)
    changes = orders.select(operation().alias("operation"), image.alias("after"))
    changelog.changelog_view(changes, "order_changelog", {
        "o_custkey": "bigint", "o_orderkey": "bigint", "o_orderdate": "timestamp"})
    return spark.sql("""
        WITH live AS (
            SELECT o_custkey, max_by(struct(o_orderkey, operation), struct(o_orderdate, o_orderkey)) AS last
            FROM order_changelog GROUP BY o_custkey)
        SELECT c_mktsegment AS segment, count(*) AS n, min(last.o_orderkey) AS least_order
        FROM live JOIN {customer} ON o_custkey = c_custkey
        WHERE last.operation <> 'DELETE' GROUP BY c_mktsegment""", customer=load(spark, sf, "customer"))


@query(LATEST_STATE)
def cdc_snapshot_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' latest orders, from a snapshot in chunks of keys that is read while the log goes on.

    Days and order keys make log positions. A chunk's marks are some hundred days apart, and each of its rows is
    read at a moment of its own between them.
    """
    width, step = 250, 1_000_000_000_000
    day = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint")
    log = load(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", operation().alias("operation"), (day * step + F.col("o_orderkey")).alias("position"))
    chunk = F.floor(F.col("o_custkey") / width)
    # Chunks are read in no order of their keys, at times all over the years of the log.
    low = (F.lit(9_200) + F.pmod(F.xxhash64("chunk"), F.lit(1_500))) * step
    marks = log.select(chunk.alias("chunk")).distinct().withColumn("low", low).withColumn("high", F.col("low") + 400 * step)
    moment = F.col("low") + F.pmod(F.xxhash64("o_custkey"), F.lit(401)) * step
    seen = log.withColumn("chunk", chunk).join(marks, "chunk").where(F.col("position") <= moment)
    rows = changelog.current_state(seen, ["o_custkey"], ["position"]).select("o_custkey", "o_orderkey")
    feed = merged_snapshot(rows, marks, log, ["o_custkey"], chunk, "position")
    # What a row was read as is the last change up to its high mark.
    names = log.select("o_orderkey", F.col("operation").alias("was"))
    live = changelog.current_state(feed, ["o_custkey"], ["position"]).join(names, "o_orderkey")
    kind = F.when(F.col("operation") == changelog.READ, F.col("was")).otherwise(F.col("operation"))
    return live.select("o_custkey", "o_orderkey", kind.alias("operation"))
