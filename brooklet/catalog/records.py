"""Projections, parsing, routing and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.catalog.registry import query
from brooklet.operators import routing
from brooklet.operators.joins import lookup
from brooklet.operators.wide_rows import first_non_null
from brooklet.tables import load

PROPS = "k INT"


def typed_events(events: DataFrame) -> DataFrame:
    rows = routing.parse_json(events, "props", PROPS).select("event_id", "user_id", F.col("record.k").alias("k"))
    rows = rows.where(F.col("k") >= 50)
    return rows.withColumn("payload", routing.to_json_text("event_id", "k"))


JSON_TYPED = """
    SELECT event_id, user_id, k, '{"event_id":' || event_id || ',"k":' || k || '}' AS payload
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) WHERE k >= 50"""


@query(JSON_TYPED)
def json_typed_events(spark: SparkSession, sf: str) -> DataFrame:
    return typed_events(load(spark, sf, "events"))


@query("SELECT c_custkey AS id, c_mktsegment AS name FROM customer")
def csv_line_parse(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "customer").select(F.concat_ws(",", "c_custkey", "c_mktsegment").alias("line"))
    return routing.parse_lines(lines, "line", {"id": "bigint", "name": "string"})


def dirty_events(events: DataFrame) -> DataFrame:
    damaged = F.when(F.col("event_id") % 97 == 0, F.left("props", F.lit(5))).otherwise(F.col("props"))
    marked = routing.mark_malformed(events.select("event_id", damaged.alias("line")), "line", PROPS)
    return marked.select("event_id", "is_dirty", F.col("record.k").alias("k"))


DIRTY = """
    SELECT event_id, event_id % 97 = 0 AS is_dirty,
           CASE WHEN event_id % 97 <> 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k
    FROM events"""


@query(DIRTY)
def dirty_record_split(spark: SparkSession, sf: str) -> DataFrame:
    return dirty_events(load(spark, sf, "events"))


def routed_types(events: DataFrame) -> DataFrame:
    """Sign-ups go aside, the rest to main; an upper-cased copy of every row goes out as well."""
    routed = routing.with_route(events.select("event_type"), {"side": F.col("event_type") == "signup"}, "main")
    outputs = F.array(
        F.struct(F.col("route"), F.col("event_type")),
        F.struct(F.lit("copy").alias("route"), F.upper("event_type").alias("event_type")),
    )
    return routed.select(F.inline(outputs))


@query("""
    SELECT CASE WHEN event_type = 'signup' THEN 'side' ELSE 'main' END AS route, event_type, count(*) AS n
    FROM events GROUP BY 1, 2
    UNION ALL SELECT 'copy', upper(event_type), count(*) FROM events GROUP BY 2""")
def route_event_types(spark: SparkSession, sf: str) -> DataFrame:
    routed = routed_types(load(spark, sf, "events"))
    return routed.groupBy("route", "event_type").agg(F.count("*").alias("n"))


def as_logs(events: DataFrame) -> DataFrame:
    """Events in the shape of application logs: sign-ups start the app, purchases show displays."""
    start = F.struct(F.lit("icon").alias("entry"))
    display = F.struct(
        F.col("event_id").cast("string").alias("item"), F.lit("sku_id").alias("item_type"),
        F.lit(1).alias("order"),
    )
    kind = F.col("event_type")
    return events.select(
        F.struct(F.col("user_id").cast("string").alias("mid"),
                 F.when(kind == "signup", "1").otherwise("0").alias("is_new")).alias("common"),
        F.when(kind == "signup", start).alias("start"),
        F.when(kind == "purchase", F.array(display)).alias("displays"),
        F.when(kind != "signup", F.struct(kind.alias("page_id"))).alias("page"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
    )


@query("""
    SELECT route, user_id, count(*) AS n FROM (
        SELECT CASE WHEN event_type = 'signup' THEN 'start' ELSE 'page' END AS route, user_id FROM events
        UNION ALL SELECT 'display', user_id FROM events WHERE event_type = 'purchase') GROUP BY 1, 2""")
def log_route_counts(spark: SparkSession, sf: str) -> DataFrame:
    logs = as_logs(load(spark, sf, "events")).withColumn("user_id", F.col("common.mid").cast("bigint"))
    routed = logs.withColumn("route", routing.log_route(F.col("start")))
    shown = F.when((F.col("route") == "page") & F.col("displays").isNotNull(),
                   F.array("route", F.lit("display"))).otherwise(F.array("route"))
    return (
        routed.select("user_id", F.explode(shown).alias("route"))
        .groupBy("route", "user_id").agg(F.count("*").alias("n"))
    )


@query("""
    SELECT l_orderkey AS page_id, item, item_type, pos FROM (
        SELECT l_orderkey, l_partkey AS item, 'part' AS item_type, 1 AS pos FROM lineitem
        UNION ALL SELECT l_orderkey, l_suppkey, 'supplier', 2 FROM lineitem)""")
def display_explode(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = load(spark, sf, "lineitem")
    pages = lineitem.select("l_orderkey", F.array(
        F.struct(F.col("l_partkey").alias("item"), F.lit("part").alias("item_type"), F.lit(1).alias("pos")),
        F.struct(F.col("l_suppkey").alias("item"), F.lit("supplier").alias("item_type"), F.lit(2).alias("pos")),
    ).alias("displays"))
    shown = routing.explode_nested(pages, "displays", {"page_id": F.col("l_orderkey")}, "display")
    return shown.select("display.page_id", "display.item", "display.item_type", "display.pos")


@query("""
    SELECT 'customer' AS kind, c_custkey AS id, upper(c_name) AS name, c_nationkey AS nationkey FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, 'S:' || s_name, s_nationkey FROM supplier""")
def union_connect(spark: SparkSession, sf: str) -> DataFrame:
    return routing.connect(
        (load(spark, sf, "customer"), {
            "kind": F.lit("customer"), "id": F.col("c_custkey"), "name": F.upper("c_name"),
            "nationkey": F.col("c_nationkey")}),
        (load(spark, sf, "supplier"), {
            "kind": F.lit("supplier"), "id": F.col("s_suppkey"), "name": F.concat(F.lit("S:"), "s_name"),
            "nationkey": F.col("s_nationkey")}),
    )


@query("""
    SELECT c_custkey AS id, coalesce(CASE WHEN c_acctbal >= 0 THEN c_name END, s_name) AS name,
           coalesce(CASE WHEN c_nationkey > 4 THEN c_nationkey END, s_nationkey) AS nationkey
    FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""")
def coalesce_merge(spark: SparkSession, sf: str) -> DataFrame:
    left = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"),
        F.when(F.col("c_nationkey") > 4, F.col("c_nationkey")).alias("nationkey"))
    right = load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    return first_non_null(left, right, ["id"])


@query("""
    SELECT i.id + 1 AS next_id, upper(c_mktsegment) AS segment, label,
           '{"id":' || i.id || ',"label":"' || label || '"}' AS payload
    FROM (SELECT unnest(range(0, (SELECT max(c_custkey) + 1 FROM customer))) AS id) i
    JOIN customer ON c_custkey = i.id
    JOIN (VALUES ('BUILDING', 'b'), ('MACHINERY', 'm'), ('FURNITURE', 'f')) AS names(segment, label)
      ON names.segment = c_mktsegment""")
def range_map(spark: SparkSession, sf: str) -> DataFrame:
    customer = load(spark, sf, "customer")
    # One number, the end of the range; none of an empty table. Slices are as many as the cluster has cores.
    end = customer.agg(F.coalesce(F.max("c_custkey") + 1, F.lit(0))).first()[0]
    ids = spark.range(0, end)
    names = spark.createDataFrame(
        [("BUILDING", "b"), ("MACHINERY", "m"), ("FURNITURE", "f")], "segment string, label string")
    rows = ids.join(customer, ids.id == customer.c_custkey)
    rows = lookup(rows, names, "c_mktsegment", "segment").where(F.col("label").isNotNull())
    return rows.select(
        (F.col("id") + 1).alias("next_id"), F.upper("c_mktsegment").alias("segment"), "label",
        routing.to_json_text("id", "label").alias("payload"))
