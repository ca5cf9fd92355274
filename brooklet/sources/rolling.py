"""A streaming file sink whose parts grow over micro-batches and roll by size or age."""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklet.sources.store import Store

# Parts roll at five megabytes or after ten seconds.
ROLL_BYTES, ROLL_SECONDS = 5 * 1024 * 1024, 10.0
#: Manifests that are kept; a stream replays its last micro-batch only.
KEPT_MANIFESTS = 100


class RollingSink:
    """Rows in one folder per ``bucket``, as parts of about ``roll_bytes`` (``bucket=.../part=.../piece=...``).

    A micro-batch writes its rows aside, as in-progress pieces of their buckets. A bucket whose pieces have
    gathered ``roll_bytes``, or whose oldest is ``roll_seconds`` old, is rolled: its pieces become one
    pending part, or several of about that size, and are finished by one rename, so readers see whole parts
    only. The manifest of a micro-batch says what is in progress after it and which buckets it rolled. A replay
    finds it and only finishes what is pending: no row is in two parts, however the rows were dealt.

    What a micro-batch reads back are the buckets that it rolls. A folder belongs to one stream and its checkpoint;
    its file system must rename folders at once. Buckets are path-safe text, and columns are no maps.
    """

    def __init__(
        self, spark: SparkSession, path: str, kind: str = "parquet", roll_bytes: int = ROLL_BYTES, roll_seconds: float = ROLL_SECONDS,
        clock: Callable[[], float] = time.time,
    ):
        self.spark, self.path, self.kind = spark, path, kind
        self.roll_bytes, self.roll_seconds, self.clock = roll_bytes, roll_seconds, clock
        self.store = Store(spark, path)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The body of ``foreachBatch``; ``batch`` has a ``bucket`` column."""
        if self.store.exists(f"{self.path}/_manifest/{batch_id}"):
            self._publish(batch_id)
            return
        in_progress, now = self._before(batch_id)["open"], self.clock()
        piece = f"_progress/batch={batch_id}"
        batch.write.mode("overwrite").partitionBy("bucket").format(self.kind).save(f"{self.path}/{piece}")
        # One entry per bucket of the micro-batch.
        for name in self.store.names(f"{self.path}/{piece}"):
            if name.startswith("bucket="):
                bucket = in_progress.setdefault(name, {"since": now, "bytes": 0, "pieces": []})
                bucket["bytes"] += self.store.size(f"{self.path}/{piece}/{name}")
                bucket["pieces"].append(f"{piece}/{name}")
        rolled = {n: b for n, b in in_progress.items() if b["bytes"] >= self.roll_bytes or now - b["since"] >= self.roll_seconds}
        self._roll(rolled, batch.schema, batch_id, {n: b for n, b in in_progress.items() if n not in rolled})

    def finish(self, schema: T.StructType, batch_id: int) -> None:
        """Roll all that is in progress, as a micro-batch of its own without rows: at the end of a bounded stream."""
        if not self.store.exists(f"{self.path}/_manifest/{batch_id}"):
            self._roll(self._before(batch_id)["open"], schema, batch_id, {})
        self._publish(batch_id)

    def _before(self, batch_id: int) -> dict:
        numbers = sorted(int(n) for n in self.store.names(f"{self.path}/_manifest") if n.isdigit() and int(n) < batch_id)
        return json.loads(self.store.read(f"{self.path}/_manifest/{numbers[-1]}")) if numbers else {"open": {}}

    def _roll(self, rolled: dict, schema: T.StructType, batch_id: int, left: dict) -> None:
        pending = f"{self.path}/_pending/batch={batch_id}"
        if rolled:
            pieces = [f"{self.path}/{p}" for b in rolled.values() for p in b["pieces"]]
            rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/_progress").format(self.kind).load(pieces).drop("batch")
            parts = {n.removeprefix("bucket="): math.ceil(b["bytes"] / self.roll_bytes) for n, b in rolled.items()}
            sizes = self.spark.createDataFrame(list(parts.items()), "_bucket STRING, _parts INT")
            # One row per rolled bucket.
            dealt = rows.join(F.broadcast(sizes), F.col("bucket").cast("string") == F.col("_bucket")).withColumn(
                "piece", F.pmod(F.xxhash64(*rows.columns), F.col("_parts")))
            # A folder of its own for each piece: tasks that have several do not mix them.
            dealt.repartition(max(1, sum(parts.values())), "bucket", "piece").drop("_bucket", "_parts").write.mode(
                "overwrite").partitionBy("bucket", "piece").format(self.kind).save(pending)
        self.store.write(f"{self.path}/_manifest/{batch_id}", json.dumps({
            "open": left, "rolled": sorted(rolled), "spent": sorted(p for b in rolled.values() for p in b["pieces"])}))
        self._publish(batch_id)

    def _publish(self, batch_id: int) -> None:
        found = json.loads(self.store.read(f"{self.path}/_manifest/{batch_id}"))
        for bucket in found["rolled"]:
            pending, part = f"{self.path}/_pending/batch={batch_id}/{bucket}", f"{self.path}/{bucket}/part={batch_id}"
            if not self.store.exists(part):
                self.store.rename(pending, part)
        for piece in found["spent"]:
            self.store.remove(f"{self.path}/{piece}")
        self.store.remove(f"{self.path}/_manifest/{batch_id - KEPT_MANIFESTS}")
