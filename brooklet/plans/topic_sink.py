"""Writing the outputs of a micro-batch to topics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from brooklet.sources import topics
from brooklet.streaming.runner import Each, reused


@dataclass(frozen=True)
class Broker:
    """Where topics live: a Kafka cluster, or a shared folder with one sub-folder per writer.

    A writer's folder is named after its topic, or freely where the topic comes from the
    record; then ``within`` names it when reading.
    """

    servers: str | None = None
    folder: str | None = None

    def read(self, spark: SparkSession, topic: str, within: str | None = None, **options) -> DataFrame:
        folder = f"{self.folder}/{within or topic}" if self.folder else None
        return topics.read_topic(spark, topic, servers=self.servers, folder=folder, **options)

    def write(self, records: DataFrame, writer: str, batch_id: int) -> None:
        """Kafka gets every record at least once; a folder gets each batch exactly once."""
        if self.servers:
            topics.write_topic(records, servers=self.servers)
        else:
            topics.write_batch_once(records, f"{self.folder}/{writer}", batch_id)


def to_topics(broker: Broker, outputs: Callable[[DataFrame], dict[str, DataFrame]]) -> Each:
    """Compute one micro-batch once and write each of its outputs to the topic of its name."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for topic, records in outputs(batch).items():
            broker.write(records, topic, batch_id)

    return reused(write)
