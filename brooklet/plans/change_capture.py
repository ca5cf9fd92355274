"""Change capture: database change records, flattened, to one topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brooklet.operators.routing import is_object
from brooklet.plans.topic_sink import Broker, to_topics
from brooklet.sources.topics import to_records
from brooklet.streaming import runner

# Fixed value: the topic of flattened changes.
TOPIC = "ods_base_db"

# A change as delivered by a connector: its topic, the operation, and the JSON row images.
RAW = "topic STRING, operation STRING, before STRING, after STRING"


def records(raw: DataFrame) -> DataFrame:
    """Envelope text, keyed by table. A row image that is no JSON object becomes an empty one; one that is
    goes into the envelope as the text it is."""
    names = F.split("topic", r"\.")
    head = F.to_json(F.struct(F.get(names, F.lit(1)).alias("database"), F.get(names, F.lit(2)).alias("table"), F.col("operation")))

    def image(name: str) -> Column:
        return F.concat(F.lit(f'"{name}":'), F.when(is_object(F.col(name)), F.col(name)).otherwise(F.lit("{}")))

    # A column of its own, so that it is written once for each row.
    headed = raw.withColumn("_head", head)
    fields = F.when(F.col("_head") == "{}", F.lit("{")).otherwise(F.concat(F.expr("left(_head, length(_head) - 1)"), F.lit(",")))
    return to_records(headed, TOPIC, F.concat(fields, image("before"), F.lit(","), image("after"), F.lit("}")), F.get(names, F.lit(2)))


def start(raw: DataFrame, broker: Broker, checkpoint: str) -> StreamingQuery:
    return runner.start(raw, to_topics(broker, lambda batch: {TOPIC: records(batch)}), checkpoint)
