"""Upsert tables in hash buckets: a micro-batch reads and folds only the buckets of its keys."""

from __future__ import annotations

import json
from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklet.sources.changelog import latest_per_key
from brooklet.sources.store import Store

#: Rows of a bucket, after folding, beyond which buckets are halved.
BUCKET_ROWS = 100_000
#: Manifests that are kept; readers and replays go back no further.
KEPT_MANIFESTS = 100


PLACE = ("kind", "upto", "fold", "level", "bucket")


@dataclass
class Manifest:
    """What a table consists of after a micro-batch.

    ``files`` has, for each bucket that has rows, its folders from the oldest to the newest; the
    first may be a base, which holds all before it. There are ``2 ** level`` buckets. A folder may be
    that of a wider bucket, from before buckets were halved.
    """

    level: int
    schema: dict | None
    files: dict[int, list[str]]

    @classmethod
    def parse(cls, text: str) -> Manifest:
        found = json.loads(text)
        return cls(found["level"], found["schema"], {int(k): v for k, v in found["files"].items()})

    def text(self) -> str:
        return json.dumps({"level": self.level, "schema": self.schema, "files": self.files}, sort_keys=True)

    def folders(self) -> set[str]:
        return {f for listed in self.files.values() for f in listed}

    def halved(self) -> Manifest:
        """Twice as many buckets. Nothing is moved: both halves of a bucket share its folders until they are folded."""
        width = 1 << self.level
        return Manifest(self.level + 1, self.schema, {k + half: list(v) for k, v in self.files.items() for half in (0, width)})


class BucketedTable:
    """An upsert table in a shared folder, cut into buckets by the hash of its keys.

    A micro-batch writes its last row per key as one delta folder per bucket that it touches, folds
    those of them that have gathered ``compact_every`` deltas, and then commits by a manifest, written at
    once. Buckets are halved when folded ones grow beyond ``bucket_rows``, so a bucket has one size however
    large the table is, and what ``read`` with ``of`` and the folding read follows the micro-batch.

    A micro-batch whose manifest is there is committed: a replay of it changes nothing, and one that was
    half written is not seen and is written again. Folders that neither of the last two manifests names are
    removed. Between rows of a key with equal orders the later micro-batch wins. A key whose last row has
    the boolean column ``dropped`` set is gone for readers at once, and for good when its bucket is
    folded. A table belongs to one stream and its checkpoint; its columns stay the same, and none is
    called as a part of ``PLACE``.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], order: list[str],
        compact_every: int = 20, dropped: str | None = None, bucket_rows: int = BUCKET_ROWS, level: int = 3,
    ):
        self.spark, self.path, self.keys, self.order = spark, path, keys, order
        self.compact_every, self.dropped, self.bucket_rows, self.level = compact_every, dropped, bucket_rows, level
        self.store = Store(spark, path)

    # Manifests -------------------------------------------------------------------------

    def batches(self) -> list[int]:
        """The micro-batches whose manifests are kept, in order."""
        return sorted(int(n) for n in self.store.names(f"{self.path}/_manifest") if n.lstrip("-").isdigit())

    def manifest(self, before: int | None = None) -> Manifest | None:
        """The last one, or the last one ahead of a micro-batch."""
        numbers = [n for n in self.batches() if before is None or n < before]
        return Manifest.parse(self.store.read(f"{self.path}/_manifest/{numbers[-1]}")) if numbers else None

    def exists(self, before: int | None = None) -> bool:
        return self.manifest(before) is not None

    # Buckets ---------------------------------------------------------------------------

    def bucket(self, level: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(1 << level)).cast("int")

    def _touched(self, of: DataFrame, level: int) -> list[int]:
        """The buckets of some rows' keys: at most one number each, and at most as many as there are buckets."""
        return sorted(r[0] for r in of.select(self.bucket(level)).distinct().collect())

    def _rows(self, manifest: Manifest, buckets: list[int] | None, schema: T.StructType) -> DataFrame:
        """The last row of each key of some buckets, or of all; also those that are dropped."""
        wanted = sorted(manifest.files) if buckets is None else [b for b in buckets if b in manifest.files]
        folders = sorted({f for b in wanted for f in manifest.files[b]})
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.option("basePath", f"{self.path}/data").schema(schema).parquet(*[f"{self.path}/data/{f}" for f in folders])
        # A folder from before buckets were halved holds rows of others too; it counts for those only that name it.
        here = self.bucket(manifest.level)
        named = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in PLACE], here.cast("string"))
        wide = sorted(f"{f}/{b}" for b in wanted for f in manifest.files[b] if f"/level={manifest.level}/" not in f)
        rows = rows.where((F.col("level") == manifest.level) | named.isin(wide))
        return latest_per_key(rows, self.keys, [*self.order, "upto"])

    # Reading and writing ---------------------------------------------------------------

    def read(self, before: int | None = None, of: DataFrame | None = None) -> DataFrame:
        """The current rows; with ``before`` as they were ahead of that micro-batch, with ``of`` at least
        those of its keys: no other buckets are opened."""
        manifest = self.manifest(before)
        if manifest is None or manifest.schema is None:
            raise ValueError(f"nothing was written to {self.path} so far")
        schema = _schema(manifest)
        rows = self._rows(manifest, None if of is None else self._touched(of, manifest.level), schema)
        rows = rows.where(~F.coalesce(F.col(self.dropped), F.lit(False))) if self.dropped else rows
        return rows.select(*schema.fieldNames())

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Commit the last row of each key of a micro-batch."""
        if self.store.exists(f"{self.path}/_manifest/{batch_id}"):
            return
        manifest = self.manifest(batch_id) or Manifest(self.level, None, {})
        manifest.schema = manifest.schema or batch.schema.jsonValue()
        last = latest_per_key(batch, self.keys, self.order).select(*_schema(manifest).fieldNames())
        place = f"kind=delta/upto={batch_id}/fold=0/level={manifest.level}"
        last.withColumn("bucket", self.bucket(manifest.level)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.path}/data/{place}")
        for name in self.store.names(f"{self.path}/data/{place}"):
            if name.startswith("bucket="):
                manifest.files.setdefault(int(name.removeprefix("bucket=")), []).append(f"{place}/{name}")
        full = [b for b, listed in manifest.files.items() if len(listed) > self.compact_every]
        written = {f for f in manifest.folders() if f.startswith(f"{place}/")}
        manifest = self._folded(manifest, full, batch_id)
        self._commit(manifest, batch_id)
        for folder in written - manifest.folders():  # Folded at once, so no manifest names it.
            self.store.remove(f"{self.path}/data/{folder}")

    def compact(self) -> None:
        """Fold all buckets, within the last micro-batch."""
        batches = self.batches()
        if batches:
            manifest = self.manifest()
            self._commit(self._folded(manifest, sorted(manifest.files), batches[-1]), batches[-1])

    def _folded(self, manifest: Manifest, buckets: list[int], batch_id: int) -> Manifest:
        """Some buckets, each as one base folder."""
        if not buckets:
            return manifest
        rows = self._rows(manifest, buckets, _schema(manifest))
        rows = rows.where(~F.coalesce(F.col(self.dropped), F.lit(False))) if self.dropped else rows
        # A micro-batch's own fold is fold 0; folding all buckets after it makes further ones.
        used = {f.rsplit("/", 1)[0] for f in manifest.folders()}
        place = next(p for p in (f"kind=base/upto={batch_id}/fold={i}/level={manifest.level}" for i in count()) if p not in used)
        rows.select(*_schema(manifest).fieldNames()).withColumn("bucket", self.bucket(manifest.level)).repartition("bucket").write.mode(
            "overwrite").partitionBy("bucket").parquet(f"{self.path}/data/{place}")
        written = set(self.store.names(f"{self.path}/data/{place}"))
        for b in buckets:
            manifest.files.pop(b)
            if f"bucket={b}" in written:
                manifest.files[b] = [f"{place}/bucket={b}"]
        largest = 0
        if any(b in manifest.files and manifest.files[b][0].startswith(f"{place}/") for b in buckets):
            folded = self.spark.read.parquet(f"{self.path}/data/{place}")
            largest = folded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        while largest and largest > self.bucket_rows:
            manifest, largest = manifest.halved(), largest / 2
        return manifest

    def _commit(self, manifest: Manifest, batch_id: int) -> None:
        before = [n for n in self.batches() if n < batch_id]
        self.store.remove(f"{self.path}/_manifest/{batch_id}")
        self.store.write(f"{self.path}/_manifest/{batch_id}", manifest.text())
        if len(before) > 1:
            one, two = (Manifest.parse(self.store.read(f"{self.path}/_manifest/{n}")) for n in before[-2:])
            for folder in one.folders() - two.folders() - manifest.folders():
                self.store.remove(f"{self.path}/data/{folder}")
        for number in before[:-KEPT_MANIFESTS]:
            self.store.remove(f"{self.path}/_manifest/{number}")


def _schema(manifest: Manifest) -> T.StructType:
    return T.StructType.fromJson(manifest.schema)
