"""Database-change routing: configured records to fact topics and dimension tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brooklet.operators.buckets import BucketedTable
from brooklet.operators.changestate import text_schema
from brooklet.operators.joins import asof_join, is_small
from brooklet.operators.routing import prune_map
from brooklet.plans.topic_sink import Broker
from brooklet.sources.changelog import DELETE, IMAGE
from brooklet.sources.topics import to_records
from brooklet.streaming import runner

# Sink types of the routing config.
SINK_TOPIC, SINK_TABLE, SINK_COLUMN_STORE = "kafka", "hbase", "clickhouse"

SPREAD = 64


def route_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Changes without deletes, with sink columns and only the configured fields of ``after``.

    ``config`` holds the configuration in force, one row per table and operation. Up to
    ``SMALL_ROWS`` rows of it are broadcast; beyond, each of them is repeated for ``SPREAD`` parts
    of the changes, so that a busy table does not meet its config in one task. Unconfigured
    changes keep a null ``sink_table``, so that they can go to a side output instead of being lost.
    """
    live = changes.where(F.col("operation") != DELETE)
    keyed = config.withColumnsRenamed({"source_table": "table", "operate_type": "operation"}).withColumn(
        "sink_columns", F.split("sink_columns", ","))
    on = ["table", "operation"]
    if is_small(keyed):
        routed = live.join(F.broadcast(keyed), on, "left")
    else:
        parts = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
        salted = live.withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int"))
        routed = salted.join(keyed.withColumn("_part", parts), [*on, "_part"], "left").drop("_part")
    pruned = F.when(F.col("sink_columns").isNotNull(), prune_map(F.col("after"), F.col("sink_columns")))
    return routed.withColumns({
        "after": F.coalesce(pruned, F.col("after")), "sink_columns": F.array_join("sink_columns", ",")})


def split_by_sink(routed: DataFrame) -> dict[str, DataFrame]:
    """Fact records, dimension records, and what no sink takes."""
    kind = F.coalesce(F.col("sink_type"), F.lit(""))
    return {
        "topic": routed.where(kind == SINK_TOPIC),
        "table": routed.where(kind == SINK_TABLE),
        "unrouted": routed.where(~kind.isin(SINK_TOPIC, SINK_TABLE)),
    }


def routed_as_of(
    records: DataFrame, config_changes: DataFrame, keys: list[str],
    order: tuple[str, str], config_order: tuple[str, str], operation: str, columns: list[str],
) -> DataFrame:
    """Records with the config ``columns`` in force at their time; null where none or deleted.

    ``config_changes`` is the changelog of the configuration: a delete ends the one before.
    """
    known = asof_join(records, config_changes, keys, left_order=order, version_order=config_order)
    in_force = F.col(operation).isNotNull() & (F.col(operation) != DELETE)
    return known.withColumns({c: F.when(in_force, F.col(c)) for c in columns})


# The job ------------------------------------------------------------------------------

# Fixed value: input topic.
TOPIC_CHANGES = "ods_base_db"
DIMENSION_KEY = "id"


def parse_envelopes(records: DataFrame) -> DataFrame:
    """Envelopes of topic records; keeps ``offset``, the order of the changes.

    The envelope is read once, and the row images stay text until somebody asks for one: what
    filters drop is never parsed, nor an image that nobody uses.
    """
    names = ["database", "table", "operation", "before", "after"]
    rows = records.select("offset", F.json_tuple("value", *names).alias(*names))
    return rows.withColumns({name: F.from_json(name, IMAGE) for name in ("before", "after")})


def start(
    records: DataFrame, current_config: Callable[[SparkSession], DataFrame], broker: Broker,
    dimensions: str, checkpoint: str,
) -> StreamingQuery:
    """Route a stream of change records.

    The configuration is read anew for every micro-batch, so changes to it take effect.
    Fact records go to the topic their config names, dimension records to the upsert table
    of that name below ``dimensions``, the rest to the topic ``unrouted``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        config = current_config(spark)
        routed = route_changes(parse_envelopes(batch), config).persist()
        try:
            outputs = split_by_sink(routed)
            payload = F.to_json("after")
            broker.write(to_records(outputs["topic"], F.col("sink_table"), payload), "facts", batch_id)
            broker.write(to_records(outputs["unrouted"], F.col("table"), payload), "unrouted", batch_id)
            # One entry per configured dimension table.
            tables = config.where(F.col("sink_type") == SINK_TABLE)
            for name, columns, key in tables.select("sink_table", "sink_columns", "sink_pk").distinct().collect():
                rows = outputs["table"].where(F.col("sink_table") == name)
                dimension_table(spark, f"{dimensions}/{name}", key).upsert(
                    dimension_rows(rows, columns, key), batch_id)
        finally:
            routed.unpersist()

    return runner.start(records, write, checkpoint)


def dimension_rows(rows: DataFrame, columns: str, key: str | None) -> DataFrame:
    """The configured text columns of routed dimension records, with their ``offset``."""
    def field(name: str) -> Column:
        return F.try_element_at(F.col("after"), F.lit(name)).cast("string").alias(name)

    return rows.select("offset", *[field(f.name) for f in text_schema(columns, key)])


def dimension_table(spark: SparkSession, path: str, key: str | None) -> BucketedTable:
    return BucketedTable(spark, path, [key or DIMENSION_KEY], ["offset"])
