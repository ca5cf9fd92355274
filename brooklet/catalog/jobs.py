"""The jobs as queries: each calls its plan on topic records made from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.catalog.changes import CONFIG_SCHEMA
from brooklet.catalog.registry import query
from brooklet.plans import change_capture, change_routing, log_cleaning, order_wide, page_visits, payment_wide
from brooklet.session import materialised
from brooklet.tables import load


def as_topic(values: DataFrame, order: Column, value: Column) -> DataFrame:
    """Topic records whose offsets follow a unique whole number of the rows."""
    return values.select(order.cast("bigint").alias("offset"), value.alias("value"))


# Orders and their lines as rows of two source tables, with typed ids and one field too many.
CREATED = "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')"
CONFIG = [
    ("order_info", "CREATE", "kafka", "dwd_order_info", "id,user_id,province_id,total_amount,create_time", None, None),
    ("order_detail", "CREATE", "kafka", "dwd_order_detail", "id,order_id,sku_id,order_price,sku_num,create_time", None, None),
]


def raw_changes(spark: SparkSession, sf: str) -> DataFrame:
    orders, lines = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    order = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.lit(1).alias("province_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_amount"), F.expr(CREATED).alias("create_time"),
        F.struct(F.col("o_orderstatus").alias("status")).alias("unknown"))
    dated = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    detail = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"), F.col("l_extendedprice").cast("decimal(18,2)").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"), F.expr(CREATED).alias("create_time"))

    def change(rows: DataFrame, name: str, image: Column) -> DataFrame:
        return rows.select(
            F.lit(f"mysql.shop.{name}").alias("topic"), F.lit("CREATE").alias("operation"),
            F.lit(None).cast("string").alias("before"), F.to_json(image).alias("after"))

    return change(orders, "order_info", order).unionByName(change(dated, "order_detail", detail))


@query("""
    SELECT l_orderkey * 10 + l_linenumber AS detail_id, l_orderkey AS order_id, o_custkey AS user_id, l_partkey AS sku_id,
           CAST(l_quantity AS BIGINT) AS sku_num, CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents,
           CAST(round(o_totalprice * 100) AS BIGINT) AS total_cents, c_mktsegment AS user_gender, p_brand AS tm_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN part ON l_partkey = p_partkey""")
def job_order_wide_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Captured changes, routed to fact topics, joined to wide rows: three jobs in a row."""
    captured = change_capture.records(raw_changes(spark, sf))
    envelopes = as_topic(captured, F.monotonically_increasing_id(), F.col("value"))
    config = spark.createDataFrame(CONFIG, CONFIG_SCHEMA)
    routed = change_routing.route_changes(change_routing.parse_envelopes(envelopes), config)
    # The fact topics are written once, as the next job finds them.
    facts = materialised(
        change_routing.split_by_sink(routed)["topic"].select("offset", "sink_table", F.to_json("after").alias("value")), "facts", "sink_table")

    def topic(name: str) -> DataFrame:
        return facts.where(F.col("sink_table") == name)

    def blank(columns: list[str]) -> list[Column]:
        return [F.lit(None).cast("string").alias(c) for c in columns]

    customers, parts = load(spark, sf, "customer"), load(spark, sf, "part")
    none = spark.range(0)
    dimensions = {
        "user": customers.select(F.col("c_custkey").cast("string").alias("ID"), F.col("c_mktsegment").alias("GENDER"), *blank(["BIRTHDAY"])),
        "province": none.select(*blank(["ID", "NAME", "AREA_CODE", "ISO_CODE", "ISO_3166_2"])),
        "sku": parts.select(F.col("p_partkey").cast("string").alias("ID"), F.col("p_partkey").cast("string").alias("TM_ID"), *blank(["CATEGORY3_ID", "SPU_ID"])),
        "spu": none.select(*blank(["ID", "SPU_NAME"])),
        "trademark": parts.select(F.col("p_partkey").cast("string").alias("ID"), F.col("p_brand").alias("TM_NAME")),
        "category": none.select(*blank(["ID", "NAME"])),
    }
    wide = order_wide.build(topic(order_wide.TOPIC_ORDER), topic(order_wide.TOPIC_DETAIL), dimensions, F.lit("2024-01-01").cast("date"))
    return wide.select(
        "detail_id", "order_id", "user_id", "sku_id", "sku_num", (F.col("order_price") * 100).cast("bigint").alias("price_cents"),
        (F.col("total_amount") * 100).cast("bigint").alias("total_cents"), "user_gender", "tm_name")


def raw_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Events as application logs: sign-ups start, all others are pages; every 97th line is cut off."""
    millis = F.unix_micros(F.col("ts").cast("timestamp")) / 1000
    common = F.struct(
        F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
        F.when(F.col("event_id") % 2 == 0, "1").otherwise("0").alias("is_new"), F.struct(F.col("value").alias("v")).alias("extra"))
    page = F.struct(
        F.col("event_type").alias("page_id"), F.col("event_id").alias("item"), F.when(F.col("event_id") % 5 == 0, "12").otherwise("long").alias("during_time"),
        F.when(F.col("event_type") != "view", "home").alias("last_page_id"))
    displays = F.when(F.col("event_id") % 3 == 0, F.array(F.struct(F.col("event_id").alias("item"), F.lit("x").alias("unknown"))))
    whole = F.to_json(F.struct(
        common.alias("common"), F.when(F.col("event_type") == "signup", F.struct(F.lit("icon").alias("entry"))).alias("start"),
        F.when(F.col("event_type") != "signup", page).alias("page"), displays.alias("displays"), millis.cast("bigint").alias("ts")))
    line = F.when(F.col("event_id") % 97 == 0, F.substring(whole, 1, 20)).otherwise(whole)
    return as_topic(load(spark, sf, "events"), F.col("event_id"), line)


LOGS = """
    logs AS (
        SELECT *, event_id % 97 = 0 AS dirty, event_type = 'signup' AS starts, event_id % 2 = 0 AS claims,
               row_number() OVER (PARTITION BY user_id, event_id % 2 = 0 AND event_id % 97 <> 0
                                  ORDER BY date_trunc('millisecond', ts), event_id) AS n
        FROM events)"""


@query(f"""
    WITH {LOGS}
    SELECT CASE WHEN starts THEN 'dwd_start_log' ELSE 'dwd_page_log' END AS topic, 'mid_' || user_id AS mid,
           CASE WHEN claims AND n = 1 THEN '1' ELSE '0' END AS is_new, CASE WHEN NOT starts THEN event_id END AS item,
           CASE WHEN NOT starts THEN CASE WHEN event_id % 5 = 0 THEN '12' ELSE 'long' END END AS during_time, count(*) AS n
    FROM logs WHERE NOT dirty GROUP BY ALL
    UNION ALL SELECT 'dwd_display_log', NULL, NULL, event_id, NULL, 1 FROM logs WHERE NOT dirty AND NOT starts AND event_id % 3 = 0
    UNION ALL SELECT 'dirty_log', NULL, NULL, NULL, NULL, count(*) FROM logs WHERE dirty HAVING count(*) > 0""")
def job_log_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Log cleaning: fields that nobody declared, and their types, arrive at the topics."""
    out = log_cleaning.clean(raw_logs(spark, sf))
    log = F.try_parse_json("value")

    def field(path: str, kind: str) -> Column:
        return F.try_variant_get(log, path, kind)

    parts = [rows.select(
        "topic", field("$.common.mid", "string").alias("mid"), field("$.common.is_new", "string").alias("is_new"),
        F.coalesce(field("$.page.item", "bigint"), field("$.item", "bigint")).alias("item"),
        field("$.page.during_time", "string").alias("during_time")) for rows in out.values()]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("topic", "mid", "is_new", "item", "during_time").agg(F.count(F.lit(1)).alias("n"))


def page_records(spark: SparkSession, sf: str) -> DataFrame:
    """The page topic of log cleaning, its offsets being those of the lines."""
    cleaned = log_cleaning.clean(raw_logs(spark, sf))[log_cleaning.TOPICS["page"]]
    return as_topic(cleaned, F.try_variant_get(F.try_parse_json("value"), "$.page.item", "bigint"), F.col("value"))


@query(f"""
    WITH {LOGS}
    SELECT 'mid_' || user_id AS mid, strftime(ts, '%Y-%m-%d') AS visit_date,
           arg_min(event_id, (date_trunc('millisecond', ts), event_id)) AS item
    FROM logs WHERE NOT dirty AND event_type = 'view' GROUP BY ALL""")
def job_unique_visits(spark: SparkSession, sf: str) -> DataFrame:
    """Log cleaning, then unique visits."""
    first = page_visits.unique_visits(page_records(spark, sf))
    return first.select("mid", F.date_format("visit_date", "yyyy-MM-dd").alias("visit_date"), F.col("offset").alias("item"))


@query(f"""
    WITH {LOGS}, pages AS (
        SELECT *, date_trunc('millisecond', ts) AS seen_at FROM logs WHERE NOT dirty AND NOT starts),
    followed AS (
        SELECT *, lead(seen_at) OVER w AS next_at, lead(event_type) OVER w AS next_type FROM pages
        WINDOW w AS (PARTITION BY user_id ORDER BY seen_at, event_id))
    SELECT 'mid_' || user_id AS mid, event_id AS item,
           CASE WHEN next_at IS NULL OR next_at - seen_at >= INTERVAL 10 SECOND THEN 'timeout' ELSE 'reentry' END AS reason
    FROM followed
    WHERE event_type = 'view' AND (next_at IS NULL OR next_at - seen_at >= INTERVAL 10 SECOND OR next_type = 'view')""")
def job_bounces(spark: SparkSession, sf: str) -> DataFrame:
    """Log cleaning, then bounce detection."""
    left = page_visits.jumps(page_records(spark, sf))
    return left.select("mid", F.col("offset").alias("item"), "reason")


@query("""
    SELECT o_orderkey AS payment_id, l_orderkey * 10 + l_linenumber AS detail_id, o_orderkey AS order_id, o_custkey AS user_id,
           CAST(round(o_totalprice * 100) AS BIGINT) AS paid_cents, l_partkey AS sku_id
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderkey % 20 <= 15""")
def job_payment_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Payments of orders, each some minutes after its order, joined with the wide rows of the order. Payments
    count up to 15 minutes after it."""
    orders, lines = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    paid_at = F.col("o_orderdate") + F.make_interval(mins=(F.col("o_orderkey") % 20).cast("int"))
    payment = F.to_json(F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_amount"), F.date_format(paid_at, "yyyy-MM-dd HH:mm:ss").alias("create_time")))
    wide = F.to_json(F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("detail_id"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        F.col("o_custkey").alias("user_id"), F.lit(0).alias("total_amount"), F.expr(CREATED).alias("create_time")))
    dated = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    joined = payment_wide.build(
        as_topic(orders, F.col("o_orderkey"), payment), as_topic(dated, F.col("l_orderkey") * 10 + F.col("l_linenumber"), wide))
    return joined.select(
        "payment_id", "detail_id", "order_id", "user_id", (F.col("total_amount") * 100).cast("bigint").alias("paid_cents"), "sku_id")
