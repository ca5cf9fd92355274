"""Message topics: Kafka where its connector is installed, else JSON files of the same envelope."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brooklet.sources.store import Store

ENVELOPE = "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
FIELDS = ["key", "value", "topic", "partition", "offset", "timestamp"]


def to_records(df: DataFrame, topic: Column | str, value: Column, key: Column | None = None) -> DataFrame:
    """Rows as topic records. The topic may come from each row."""
    topic = F.lit(topic) if isinstance(topic, str) else topic
    key = F.lit(None).cast("string") if key is None else key.cast("string")
    return df.select(key.alias("key"), value.alias("value"), topic.alias("topic"))


def read_topic(
    spark: SparkSession, topic: str, *, servers: str | None = None, folder: str | None = None,
    starting: str | int = "earliest", group_id: str | None = None, streaming: bool = True,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Records of a topic with text key and value.

    ``starting`` is ``earliest``, ``latest``, or for file topics the first offset to read.
    ``latest`` of a file topic is what comes after the records that are there when this is
    called. ``folder`` reads the file form, ``servers`` the Kafka form.
    """
    reader = spark.readStream if streaming else spark.read
    if servers:
        options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": str(starting)}
        if group_id:
            options["kafka.group.id"] = group_id
        raw = reader.format("kafka").options(**options).load()
        return raw.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})
    if not folder:
        raise ValueError("either servers or folder is needed")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    records = reader.schema(ENVELOPE).json(folder).select(*FIELDS).where(F.col("topic") == topic)
    if starting == "latest":
        there = spark.read.schema(ENVELOPE).json(folder).where(F.col("topic") == topic)
        starting = (there.agg(F.max("offset")).first()[0] or -1) + 1 if not there.isEmpty() else 0
    return records if starting == "earliest" else records.where(F.col("offset") >= int(starting))


def write_topic(records: DataFrame, *, servers: str | None = None, folder: str | None = None) -> None:
    """Append a batch of records; also the body of a streaming ``foreachBatch``."""
    if servers:
        records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    else:
        records.write.mode("append").json(folder)


#: Manifests that are kept; a stream replays its last micro-batch only.
KEPT_MANIFESTS = 100


def write_batch_once(records: DataFrame, folder: str, batch_id: int, partitions: int = 1) -> None:
    """Write a micro-batch to a folder of its own, split by topic, exactly once.

    Offsets have no gaps within a topic and partition, over all micro-batches: a manifest per
    micro-batch says which offsets it has and which come next. The rows are first written aside, then
    numbered (each task's rows go on where those of the task before end), then the manifest is written,
    and only then one rename shows the batch to readers. So a batch that is half written is never
    seen, and a replay finds the manifest and gives the same offsets, however its rows are dealt.

    With one partition, the offsets of a topic follow the order of the micro-batch; with more,
    records of one key (of one value, where there is no key) share a partition, as in Kafka. A folder
    belongs to one stream and its checkpoint, and its file system must rename folders at once.
    """
    spark = records.sparkSession
    store = Store(spark, folder)
    aside, manifest, shown = f"{folder}/_aside/batch={batch_id}", f"{folder}/_manifest/{batch_id}", f"{folder}/batch={batch_id}"
    if not store.exists(manifest):
        following = _following(store, folder, batch_id)
        ranges = _number(records, f"{aside}-rows", aside, following, partitions)
        store.write(manifest, json.dumps({"offsets": ranges, "next": {**following, **{k: r[1] for k, r in ranges.items()}}}, sort_keys=True))
        store.remove(f"{aside}-rows")
    if not store.exists(shown):
        if json.loads(store.read(manifest))["offsets"]:
            store.rename(aside, shown)
        else:
            store.remove(aside)
    store.remove(f"{folder}/_manifest/{batch_id - KEPT_MANIFESTS}")


def _following(store: Store, folder: str, batch_id: int) -> dict[str, int]:
    """The next offset of each topic and partition (``topic/partition``) ahead of a micro-batch."""
    before = [batch_id - 1] if store.exists(f"{folder}/_manifest/{batch_id - 1}") else sorted(
        int(n) for n in store.names(f"{folder}/_manifest") if n.isdigit() and int(n) < batch_id)
    return json.loads(store.read(f"{folder}/_manifest/{before[-1]}"))["next"] if before else {}


def _number(records: DataFrame, rows: str, aside: str, following: dict[str, int], partitions: int) -> dict[str, list[int]]:
    """Write records with their offsets; gives the first and the next offset of each topic and partition."""
    spark = records.sparkSession
    place = F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(partitions)).cast("int")
    records.withColumns({
        "partition": place, "timestamp": F.current_timestamp(), "_task": F.spark_partition_id(), "_row": F.monotonically_increasing_id(),
    }).write.mode("overwrite").parquet(rows)
    written = spark.read.parquet(rows)
    group = ["topic", "partition"]
    # One row per task, topic and partition.
    counts = written.groupBy(*group, "_task").agg(F.count(F.lit(1)).alias("_n"))
    totals = {f"{r['topic']}/{r['partition']}": r["n"] for r in counts.groupBy(*group).agg(F.sum("_n").alias("n")).collect()}
    first = spark.createDataFrame(
        [(k, following.get(k, 0)) for k in totals], "_topic STRING, _first BIGINT")
    ahead = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).join(
        first, F.concat_ws("/", "topic", F.col("partition").cast("string")) == F.col("_topic")).select(
        *group, "_task", (F.col("_ahead") + F.col("_first")).alias("_start"))
    within = F.row_number().over(Window.partitionBy(*group, "_task").orderBy("_row")) - 1
    numbered = written.withColumn("offset", within.cast("bigint")).join(starts, [*group, "_task"]).withColumn(
        "offset", F.col("offset") + F.col("_start"))
    fields = [f for f in FIELDS if f in numbered.columns]
    numbered.select(*fields).write.mode("overwrite").partitionBy("topic").json(aside)
    return {k: [following.get(k, 0), following.get(k, 0) + n] for k, n in totals.items()}
