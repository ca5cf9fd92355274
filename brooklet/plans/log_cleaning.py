"""Application-log cleaning and routing: malformed lines aside, new-user flags corrected,
start, page and display records to topics of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brooklet.operators import visits
from brooklet.operators.routing import OBJECT, json_object, put
from brooklet.plans.topic_sink import Broker, to_topics
from brooklet.session import materialised
from brooklet.sources.topics import to_records
from brooklet.streaming import runner, stateful

# Topics.
TOPIC_LOG = "ods_base_log"
TOPICS = {"start": "dwd_start_log", "page": "dwd_page_log", "display": "dwd_display_log"}
TOPIC_DIRTY = "dirty_log"

ORDER = ["ts", "offset"]


def parsed(records: DataFrame) -> DataFrame:
    """Lines with the fields that state needs. A line that is no JSON object is dirty; one with
    unexpected fields or types is not. ``claimed`` is the flag as it came."""
    rows = records.select("offset", "value", F.try_parse_json("value").alias("log"))

    def field(path: str, kind: str) -> Column:
        return F.try_variant_get("log", path, kind)

    is_new = field("$.common.is_new", "string")
    return rows.select(
        "offset", "value", (~F.coalesce(F.schema_of_variant("log").startswith("OBJECT"), F.lit(False))).alias("is_dirty"),
        field("$.common.mid", "string").alias("mid"), is_new.alias("is_new"), is_new.alias("claimed"), field("$.ts", "bigint").alias("ts"))


def topic_rows(flagged: DataFrame) -> DataFrame:
    """``topic`` and ``value`` of all records, from lines whose flag has been corrected: each log as it came but
    for the flag, and each display with the id of its page.

    One pass over the lines. Only logs whose flag changed are written anew; others stay the text they were.
    """
    log = F.try_parse_json("value")
    entries = json_object(F.col("value"))
    corrected = put(json_object(F.to_json(F.try_element_at(entries, F.lit("common")))), "is_new", F.to_json(F.col("is_new").cast("variant")))
    changed = F.col("is_new").isNotNull() & (F.col("is_new") != F.col("claimed"))
    body = F.when(changed, F.to_json(put(entries, "common", F.to_json(corrected)))).otherwise(F.col("value"))

    def part(path: str) -> Column:
        return F.try_variant_get("log", path, "variant")

    is_start = F.coalesce(F.schema_of_variant(part("$.start")) != "VOID", F.lit(False))
    page_id = F.to_json(part("$.page.page_id"))
    with_page = lambda d: F.to_json(F.when(page_id.isNotNull(), put(d, "page_id", page_id)).otherwise(d))
    displays = F.transform(
        F.from_json(F.to_json(part("$.displays")), f"array<{OBJECT}>"),
        lambda d: F.struct(F.lit(TOPICS["display"]).alias("topic"), with_page(d).alias("value")))
    page = F.struct(F.lit(TOPICS["page"]).alias("topic"), body.alias("value"))
    none = F.array().cast("array<struct<topic: string, value: string>>")
    out = (
        F.when(F.col("is_dirty"), F.array(F.struct(F.lit(TOPIC_DIRTY).alias("topic"), F.col("value").alias("value"))))
        .when(is_start, F.array(F.struct(F.lit(TOPICS["start"]).alias("topic"), body.alias("value"))))
        .otherwise(F.concat(F.array(page), F.coalesce(displays, none))))
    rows = flagged.select("value", "is_dirty", "is_new", "claimed", log.alias("log"))
    return rows.select(F.explode(out).alias("r")).select("r.*")


def by_topic(rows: DataFrame) -> dict[str, DataFrame]:
    """Records per topic."""
    return {
        topic: to_records(rows.where(F.col("topic") == topic), topic, F.col("value")) for topic in (*TOPICS.values(), TOPIC_DIRTY)}


def clean(records: DataFrame) -> dict[str, DataFrame]:
    """The whole job on a table of log records ``(offset, value)``: lines are parsed once, and the topics
    written once, as every reader of them would find them."""
    lines = materialised(parsed(records), "log-lines")
    return by_topic(materialised(topic_rows(visits.correct_new_flag(lines, "mid", ORDER)), "log-topics", "topic"))


def start(records: DataFrame, broker: Broker, checkpoint: str) -> StreamingQuery:
    flagged = stateful.correct_new_flag(parsed(records), "mid", ORDER)

    def outputs(batch: DataFrame) -> dict[str, DataFrame]:
        return by_topic(topic_rows(batch))

    return runner.start(flagged, to_topics(broker, outputs), checkpoint)
