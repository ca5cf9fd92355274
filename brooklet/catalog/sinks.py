"""Sinks written and read back. Each run writes to folders of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.catalog import changes as change_queries
from brooklet.catalog.registry import query
from brooklet.operators.buckets import BucketedTable
from brooklet.operators.routing import parse_lines
from brooklet.operators.changestate import create_table_if_absent, text_schema
from brooklet.plans.rule_publication import RuleStore
from brooklet.session import scratch_path
from brooklet.sources import files, topics
from brooklet.tables import load


@query("""
    SELECT 'earliest' AS mode, event_id, event_type FROM events
    UNION ALL SELECT 'offset', event_id, event_type FROM events WHERE event_id >= (SELECT count(*) / 2 FROM events)""")
def topic_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    events, folder = load(spark, sf, "events"), scratch_path(spark, "topic")
    value = F.to_json(F.struct("event_id", "event_type"))
    records = events.select(
        F.col("user_id").cast("string").alias("key"), value.alias("value"), F.lit("events").alias("topic"),
        F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"))
    topics.write_topic(records, folder=folder)
    half = events.count() // 2
    parts = []
    for mode, starting in (("earliest", "earliest"), ("offset", half)):
        read = topics.read_topic(spark, "events", folder=folder, starting=starting, streaming=False)
        typed = read.select(F.from_json("value", "event_id BIGINT, event_type STRING").alias("r")).select("r.*")
        parts.append(typed.select(F.lit(mode).alias("mode"), "event_id", "event_type"))
    return parts[0].unionByName(parts[1])


@query("""
    SELECT kind, strftime(ts, '%Y-%m-%d') AS bucket, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
    FROM events, (VALUES ('parquet'), ('text'), ('csv')) AS kinds(kind) GROUP BY 1, 2""")
def bucketed_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = files.bucketed(load(spark, sf, "events").select("event_id", "ts"), F.col("ts"), "yyyy-MM-dd")
    parts = []
    for kind in ("parquet", "text", "csv"):
        path = scratch_path(spark, kind)
        line = F.col("event_id").cast("string").alias("value")
        body = rows.select("bucket", F.col("event_id") if kind == "parquet" else line)
        files.write_buckets(body, path, kind)
        reader = spark.read.schema("event_id BIGINT, bucket STRING" if kind == "parquet"
                                   else "value STRING, bucket STRING")
        back = reader.format(kind).load(path)
        event_id = F.col("event_id") if kind == "parquet" else F.col("value").cast("bigint")
        parts.append(back.select(F.lit(kind).alias("kind"), "bucket", event_id.alias("event_id")))
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.groupBy("kind", "bucket").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("""
    SELECT CASE o_orderstatus WHEN 'O' THEN 'dwd_order_info' ELSE 'dim_order' END AS sink_table,
           CAST(o_orderkey AS VARCHAR) AS o_orderkey,
           CASE o_orderstatus WHEN 'O' THEN CAST(o_custkey AS VARCHAR) END AS o_custkey,
           CASE o_orderstatus WHEN 'P' THEN o_orderpriority END AS o_orderpriority
    FROM orders WHERE o_orderstatus <> 'F'""")
def routed_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Routed records written by target, read back with the text schema of each config."""
    folder = scratch_path(spark, "routed")
    routed = change_queries.configured(spark, change_queries.envelopes(load(spark, sf, "orders")))
    routed.select("sink_table", F.to_json("after").alias("value")).write.partitionBy("sink_table").text(folder)
    parts = []
    for _, _, _, table, columns, key, _ in change_queries.CONFIG:
        schema = text_schema(columns, key)
        path = scratch_path(spark, table)
        spark.read.schema(schema).json(f"{folder}/sink_table={table}").write.parquet(path)
        name = f"{table}_{path[-12:]}"
        create_table_if_absent(spark, name, columns, path, key)
        create_table_if_absent(spark, name, columns, path, key)
        parts.append(spark.table(name).withColumn("sink_table", F.lit(table)))
    both = parts[0].unionByName(parts[1], allowMissingColumns=True)
    return both.select("sink_table", "o_orderkey", "o_custkey", "o_orderpriority")


@query(change_queries.LATEST_STATE)
def upsert_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, the first one applied again, then folded into a base and updated once more."""
    changes = change_queries.order_changes(load(spark, sf, "orders"))
    table = BucketedTable(spark, scratch_path(spark, "upsert"), ["o_custkey"], change_queries.ORDER)
    early = F.col("o_orderdate") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    table.upsert(changes.where(early), 0)
    table.upsert(changes.where(early), 0)
    table.compact()
    table.upsert(changes.where(~early), 1)
    live = table.read().where(F.col("operation") != "DELETE")
    return live.select("o_custkey", "o_orderkey", "operation")


@query("""
    SELECT c_custkey AS guid, tag FROM customer, (VALUES (1), (2)) AS which(i),
        LATERAL (SELECT CASE i WHEN 1 THEN lower(c_mktsegment) ELSE 'nation' || c_nationkey END AS tag)""")
def profile_load(spark: SparkSession, sf: str) -> DataFrame:
    tags = F.array(F.lower("c_mktsegment"), F.concat(F.lit("nation"), F.col("c_nationkey").cast("string")))
    profiles = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("guid"), F.col("c_acctbal").alias("tag01"), F.col("c_name").alias("tag03"),
        tags.alias("tag04"))
    path = scratch_path(spark, "profiles")
    profiles.write.parquet(path)
    return spark.read.parquet(path).select("guid", F.explode("tag04").alias("tag"))


@query("""
    SELECT 'R-' || c_mktsegment AS rule_id, 'M1' AS rule_model_id, count(*) AS audience,
           '{"ruleId":"R-' || c_mktsegment || '","tagId":"segment"}' AS rule_define_json
    FROM customer WHERE c_mktsegment <> 'FURNITURE' GROUP BY c_mktsegment""")
def rule_store(spark: SparkSession, sf: str) -> DataFrame:
    """One rule per segment with its audience as bitmaps; one is then switched off."""
    customer = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("guid"), F.col("c_mktsegment").alias("segment"))
    segments = customer.select("segment").distinct()
    store = RuleStore(spark, scratch_path(spark, "rules"))
    store.add_model("M1", "counts", 1)
    store.add_model("M9", "retired", 0)
    rule_id = F.concat(F.lit("R-"), F.col("segment"))
    definition = F.to_json(F.struct(rule_id.alias("ruleId"), F.lit("segment").alias("tagId")))
    status = F.when(F.col("segment") == "FURNITURE", 0).otherwise(1)
    rows = segments.select(rule_id.alias("rule_id"), F.lit("M1").alias("rule_model_id"),
                           definition.alias("rule_define_json"), status.alias("rule_status"))
    members = customer.select(rule_id.alias("rule_id"), "guid")
    store.add_rules(rows, members)
    found = store.rules_of("M1").join(store.audience_sizes(), "rule_id")
    return found.select("rule_id", "rule_model_id", "audience", "rule_define_json")


@query("""
    SELECT kind, event_id, event_type FROM events, (VALUES ('text'), ('csv')) AS kinds(kind) WHERE event_id % 2 = 0""")
def overwritten_files(spark: SparkSession, sf: str) -> DataFrame:
    """Text and CSV files written twice, the second time with other rows, and read back as lines."""
    rows = load(spark, sf, "events").select("event_id", "event_type")
    line = F.concat_ws(",", F.col("event_id").cast("string"), "event_type").alias("value")
    parts = []
    for kind, write in (("text", files.overwrite_text), ("csv", files.overwrite_csv)):
        path = scratch_path(spark, f"overwritten-{kind}")
        for kept in (rows, rows.where(F.col("event_id") % 2 == 0)):
            write(kept.select(line) if kind == "text" else kept, path)
        lines = parse_lines(files.read_lines(spark, path), "value", {"event_id": "bigint", "event_type": "string"})
        parts.append(lines.select(F.lit(kind).alias("kind"), "event_id", "event_type"))
    return parts[0].unionByName(parts[1])
