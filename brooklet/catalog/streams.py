"""Streaming forms of the batch queries, run over the same tables as file streams."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brooklet.catalog import changes, joins, records, rules, visits, windows
from brooklet.catalog.registry import ORACLES, query
from brooklet.functions.predicates import event_flag
from brooklet.functions.times import text
from brooklet.functions.user import Aggregate
from brooklet.operators import joins as join_ops
from brooklet.operators import sequences, visits as visit_ops
from brooklet.operators.windows import stream_session_windows, time_windows
from brooklet.plans import rule_matching
from brooklet.session import scratch_path
from brooklet.sources import topics
from brooklet.streaming import runner, stateful
from brooklet.streaming.lateness import late_row_batches, window_count_batches
from brooklet.tables import EVENTS_SCHEMA, LINEITEM_SCHEMA, ORDERS_SCHEMA, load, stream


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a time zone on the time column, as watermarks need."""
    return stream(spark, sf, "events", EVENTS_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))


@query(ORACLES["json_typed_events"])
def stream_json_typed_events(spark: SparkSession, sf: str) -> DataFrame:
    return runner.run_to_table(spark, records.typed_events(event_stream(spark, sf)), "typed")


@query(ORACLES["dirty_record_split"])
def stream_dirty_record_split(spark: SparkSession, sf: str) -> DataFrame:
    return runner.run_to_table(spark, records.dirty_events(event_stream(spark, sf)), "dirty")


@query(ORACLES["cdc_flatten"])
def stream_cdc_flatten(spark: SparkSession, sf: str) -> DataFrame:
    orders = stream(spark, sf, "orders", ORDERS_SCHEMA)
    return runner.run_to_table(spark, changes.flat_rows(changes.envelopes(orders)), "flat")


@query(ORACLES["config_route"])
def stream_config_route(spark: SparkSession, sf: str) -> DataFrame:
    routed = changes.configured(spark, changes.envelopes(stream(spark, sf, "orders", ORDERS_SCHEMA)))
    rows = routed.select("table", "operation", "sink_table", "sink_type", F.to_json("after").alias("payload"))
    return runner.run_to_table(spark, rows, "route")


@query(ORACLES["cdc_latest_state"])
def stream_cdc_latest_state(spark: SparkSession, sf: str) -> DataFrame:
    feed = changes.order_changes(stream(spark, sf, "orders", ORDERS_SCHEMA))
    live = runner.run_to_keyed(spark, feed, "state", ["o_custkey"], changes.ORDER, "append")
    return live.where(F.col("operation") != "DELETE").select("o_custkey", "o_orderkey", "operation")


@query(ORACLES["broadcast_enrich"])
def stream_broadcast_enrich(spark: SparkSession, sf: str) -> DataFrame:
    rows = joins.enrich(event_stream(spark, sf), load(spark, sf, "customer"))
    return runner.run_to_table(spark, rows, "enrich")


@query(ORACLES["order_wide_dims"])
def stream_order_wide_dims(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = stream(spark, sf, "lineitem", LINEITEM_SCHEMA)
    return runner.run_to_table(spark, joins.widen(lineitem, joins.order_dimensions(spark, sf)), "wide")


@query(ORACLES["payment_interval_join"])
def stream_payment_interval_join(spark: SparkSession, sf: str) -> DataFrame:
    payments = joins.payment_rows(event_stream(spark, sf)).withWatermark("payment_ts", "0 seconds")
    orders = joins.wide_rows(event_stream(spark, sf)).withWatermark("wide_ts", "0 seconds")
    joined = join_ops.stream_interval_join(payments, orders, ["user_id"], "payment_ts", "wide_ts",
                                           *joins.PAYMENT_SPAN)
    return runner.run_to_table(spark, joins.paid(joined), "paid")


def side(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    rows = event_stream(spark, sf).where(F.col("event_type") == kind)
    return rows.select("user_id", F.col("event_id").alias(f"{kind}_id"),
                       F.col("ts").alias(f"{kind}_ts")).withWatermark(f"{kind}_ts", "1 second")


@query(ORACLES["window_join_inner"])
def stream_window_join_inner(spark: SparkSession, sf: str) -> DataFrame:
    views, clicks = side(spark, sf, "view"), side(spark, sf, "click")
    joined = join_ops.window_join(views, clicks, ["user_id"], "1 day", "view_ts", "click_ts")
    return runner.run_to_table(spark, joined.select("user_id", "view_id", "click_id"), "window_join")


@query("""
    WITH clock AS (
        SELECT least(max(CASE WHEN event_type = 'signup' THEN ts END),
                     max(CASE WHEN event_type = 'purchase' THEN ts END)) - INTERVAL 1 SECOND AS w FROM events)
    SELECT s.user_id, s.event_id AS signup_id, coalesce(p.event_id, 0) AS purchase_id
    FROM (SELECT * FROM events WHERE event_type = 'signup') s
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
      ON s.user_id = p.user_id AND CAST(s.ts AS DATE) = CAST(p.ts AS DATE)
    WHERE p.event_id IS NOT NULL OR CAST(s.ts AS DATE) + INTERVAL 1 DAY <= (SELECT w FROM clock)""")
def stream_window_cogroup_left(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a partner come out once the watermark has closed their window."""
    signups, purchases = side(spark, sf, "signup"), side(spark, sf, "purchase")
    joined = join_ops.window_join(signups, purchases, ["user_id"], "1 day", "signup_ts", "purchase_ts", "left")
    rows = joined.select("user_id", "signup_id", F.coalesce("purchase_id", F.lit(0)).alias("purchase_id"))
    return runner.run_to_table(spark, rows, "cogroup")


@query(ORACLES["tumbling_count_keyed"])
def stream_tumbling_count_keyed(spark: SparkSession, sf: str) -> DataFrame:
    events = event_stream(spark, sf).withWatermark("ts", "1 second")
    counted = time_windows(events, "ts", "1 day", windows.counts(), ["user_id"])
    keys = ["user_id", "window_start"]
    return windows.started(runner.run_to_keyed(spark, counted, "tumbling", keys, ["n"]), "user_id")


@query(ORACLES["sliding_count_keyed"])
def stream_sliding_count_keyed(spark: SparkSession, sf: str) -> DataFrame:
    events = event_stream(spark, sf).withWatermark("ts", "1 second")
    counted = time_windows(events, "ts", "1 day", windows.counts(), ["user_id"], "6 hours")
    keys = ["user_id", "window_start"]
    return windows.started(runner.run_to_keyed(spark, counted, "sliding", keys, ["n"]), "user_id")


@query(f"""
    SELECT * FROM ({ORACLES['session_count_keyed']})
    WHERE session_end < strftime((SELECT max(ts) - INTERVAL 1 SECOND FROM events), '%Y-%m-%d %H:%M:%S')""")
def stream_session_count_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions closed by the watermark at the end of the stream; later ones are still open."""
    events = event_stream(spark, sf).withWatermark("ts", "1 second")
    sessions = stream_session_windows(events, ["user_id"], "ts", "6 hours", windows.counts())
    return windows.session_rows(runner.run_to_table(spark, sessions, "sessions"), "user_id")


@query("SELECT DISTINCT user_id, strftime(ts, '%Y-%m-%d') AS visit_date FROM events WHERE event_type = 'view'")
def stream_first_visit_daily(spark: SparkSession, sf: str) -> DataFrame:
    pages = visits.entries(event_stream(spark, sf))
    first = stateful.first_visits(pages, "user_id", "ts", visit_ops.is_entry(F.col("last_page_id")))
    rows = first.select("user_id", F.date_format("visit_date", "yyyy-MM-dd").alias("visit_date"))
    return runner.run_to_table(spark, rows, "visits")


@query(ORACLES["new_user_flag"])
def stream_new_user_flag(spark: SparkSession, sf: str) -> DataFrame:
    claims = visits.claims(event_stream(spark, sf))
    flagged = stateful.correct_new_flag(claims, "user_id", ["ts", "event_id"])
    return runner.run_to_table(spark, flagged.select("event_id", "user_id", "is_new"), "new_user")


@query("""
    WITH clock AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 SECOND AS w FROM events),
    seen AS (SELECT e.*, w, lead(ts) OVER o AS nts, lead(event_type) OVER o AS ntype
             FROM events e, clock WHERE ts <= w WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_id, user_id, CASE WHEN nts IS NULL OR nts - ts >= INTERVAL 6 HOUR THEN 'timeout'
                                   ELSE 'reentry' END AS reason
    FROM seen WHERE event_type = 'view' AND ((nts IS NULL AND ts + INTERVAL 6 HOUR <= w)
        OR nts - ts >= INTERVAL 6 HOUR OR ntype = 'view')""")
def stream_bounce_detail(spark: SparkSession, sf: str) -> DataFrame:
    """Bounces decided by the watermark at the end of the stream."""
    pages = visits.entries(event_stream(spark, sf))
    entry = visit_ops.is_entry(F.col("last_page_id"))
    left = stateful.bounces(pages, "user_id", "ts", "event_id", entry, timedelta(hours=6), "1 second")
    return runner.run_to_table(spark, left, "bounces").select("event_id", "user_id", "reason")


def timed(events: DataFrame) -> DataFrame:
    return events.select("user_id", "event_type", "ts", "event_id", "value")


@query(ORACLES["rolling_min_by"])
def stream_rolling_min_by(spark: SparkSession, sf: str) -> DataFrame:
    rolled = stateful.running_argmin(timed(event_stream(spark, sf)), ["user_id", "event_type"], windows.ORDER, "value")
    rows = rolled.select("event_id", "user_id", "event_type", "least_event_id", "least_value")
    return runner.run_to_table(spark, rows, "argmin")


TOTALS = Aggregate(
    create=lambda: (0, 0, 2**62),
    add=lambda s, event_id, value: (s[0] + 1, s[1] + round(value * 100), min(s[2], event_id)),
    merge=lambda a, b: (a[0] + b[0], a[1] + b[1], min(a[2], b[2])), result=lambda s: s,
    state="n BIGINT, cents BIGINT, first BIGINT", output="n BIGINT, cents BIGINT, first_event_id BIGINT")


@query(ORACLES["count_window_keyed"])
def stream_count_window_keyed(spark: SparkSession, sf: str) -> DataFrame:
    fired = stateful.count_windows(timed(event_stream(spark, sf)), ["user_id"], windows.ORDER,
                                   ["event_id", "value"], 10, TOTALS)
    rows = fired.withColumn("window_no", (F.col("rows_seen") / 10).cast("bigint") - 1).drop("rows_seen")
    return runner.run_to_table(spark, rows, "count")


@query(ORACLES["count_slide_keyed"])
def stream_count_slide_keyed(spark: SparkSession, sf: str) -> DataFrame:
    fired = stateful.count_windows(timed(event_stream(spark, sf)), ["user_id"], windows.ORDER,
                                   ["event_id", "value"], 10, TOTALS, 2)
    rows = fired.select("user_id", F.col("rows_seen").alias("window_no"), "n", "cents")
    return runner.run_to_table(spark, rows, "count_slide")


@query(ORACLES["late_side_output"])
def stream_late_side_output(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "late")
    events = windows.disturbed(event_stream(spark, sf))
    sink = late_row_batches(f"{path}/late", ["source"], windows.ARRIVAL, "ts", windows.BOUND,
                            "1 hour", windows.LATENESS)
    runner.start(events, sink, f"{path}/checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{path}/late/rows")
    return rows.select("event_id", "user_id", "is_late", "is_refire")


@query(f"""
    WITH {windows.PROGRESS},
    clock AS (SELECT source, max(ts) - INTERVAL 3001 MILLISECOND AS c FROM progress GROUP BY 1),
    accepted AS (
        SELECT source, user_id, w, passed,
               row_number() OVER (PARTITION BY user_id, w ORDER BY arrival, event_id) AS n
        FROM classified WHERE NOT is_late)
    SELECT user_id, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, false AS is_refire, count(*) AS n
    FROM accepted JOIN clock USING (source)
    WHERE NOT passed AND w + INTERVAL 3599999 MILLISECOND <= c GROUP BY user_id, w
    UNION ALL SELECT user_id, strftime(w, '%Y-%m-%d %H:%M:%S'), true, n FROM accepted WHERE passed""")
def stream_late_refire_log(spark: SparkSession, sf: str) -> DataFrame:
    """Window results up to the watermark at the end of the stream."""
    path = scratch_path(spark, "fired")
    sink = window_count_batches(f"{path}/out", ["source"], ["user_id"], windows.ARRIVAL, "ts", windows.BOUND,
                                "1 hour", windows.LATENESS)
    events = windows.disturbed(event_stream(spark, sf))
    runner.start(events, sink, f"{path}/checkpoint").awaitTermination()
    fired = spark.read.parquet(f"{path}/out/fired")
    return fired.select("user_id", text(F.col("window_start")).alias("window_start"), "is_refire", "n")


@query(ORACLES["sequence_progress"])
def stream_sequence_progress(spark: SparkSession, sf: str) -> DataFrame:
    events = event_stream(spark, sf).withColumnRenamed("user_id", "guid").withColumn("event_pk", F.col("event_id"))
    hits = sequences.step_hits([event_flag(s, rules.COLUMNS) for s in rules.STEPS])
    rows = events.select("guid", F.col("ts").alias("match_time"), "event_pk", hits.alias("hits"))
    walked = stateful.sequence_progress(rows, ["guid"], ["match_time", "event_pk"])
    return runner.run_to_table(spark, walked.select(F.col("event_pk").alias("event_id"), "guid", "step", "n"), "steps")


def live_matches(spark: SparkSession, sf: str, which: list) -> DataFrame:
    events = event_stream(spark, sf).withColumnRenamed("user_id", "guid").withColumn("event_pk", F.col("event_id"))
    path = scratch_path(spark, "matches")
    audience = rules.rule_audience(spark, sf, which)
    job = rule_matching.start(events, which, audience, rules.COLUMNS, ["event_pk"], path)
    job.awaitTermination()
    found = rule_matching.read_matches(spark, path)
    return found.select("rule_id", "guid", text(F.col("match_time")).alias("match_time"),
                        F.col("event_pk").alias("event_id"))


@query(ORACLES["rule_model1_matches"])
def stream_rule_model1_matches(spark: SparkSession, sf: str) -> DataFrame:
    return live_matches(spark, sf, rules.rules()[:1])


@query(ORACLES["rule_model2_matches"])
def stream_rule_model2_matches(spark: SparkSession, sf: str) -> DataFrame:
    return live_matches(spark, sf, rules.rules()[1:])


@query("""
    SELECT event_type AS topic, count(*) AS n, count(*) AS offsets, CAST(0 AS BIGINT) AS least, count(*) - 1 AS greatest,
           CAST(sum(event_id) AS BIGINT) AS ids, count(*) - 1 AS ascents FROM events GROUP BY event_type""")
def stream_topic_exactly_once(spark: SparkSession, sf: str) -> DataFrame:
    """Events written to a topic per type in several micro-batches, each replayed with its rows dealt
    otherwise; offsets have no gaps and follow the micro-batches."""
    path = scratch_path(spark, "exactly-once")
    parts = load(spark, sf, "events").select("event_id", "event_type").withColumn("part", F.pmod("event_id", F.lit(4)))
    parts.repartition(4, "part").write.partitionBy("part").parquet(f"{path}/source")
    rows = spark.readStream.schema("event_id BIGINT, event_type STRING, part INT").option("maxFilesPerTrigger", 1).parquet(f"{path}/source")
    value = F.to_json(F.struct("event_id", "part"))

    def write(batch: DataFrame, batch_id: int) -> None:
        records = topics.to_records(batch.orderBy("event_id"), F.col("event_type"), value)
        topics.write_batch_once(records, f"{path}/topics", batch_id)
        topics.write_batch_once(records.repartition(3), f"{path}/topics", batch_id)

    runner.start(rows, write, f"{path}/checkpoint").awaitTermination()
    read = spark.read.schema(topics.ENVELOPE).json(f"{path}/topics").select(
        "topic", "offset", F.from_json("value", "event_id BIGINT, part INT").alias("v"))
    # Within a micro-batch ids ascend with the offsets.
    before = F.lag("v").over(Window.partitionBy("topic").orderBy("offset"))
    ascends = F.col("before").isNotNull() & ((F.col("v.event_id") > F.col("before.event_id")) | (F.col("v.part") != F.col("before.part")))
    return read.withColumn("before", before).groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("offset").alias("offsets"), F.min("offset").alias("least"), F.max("offset").alias("greatest"),
        F.sum("v.event_id").alias("ids"), F.count_if(ascends).alias("ascents"))
