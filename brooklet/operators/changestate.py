"""Upsert tables and routed tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklet.sources.changelog import latest_per_key


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists, on whichever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


class KeyedTable:
    """An upsert table in a shared folder: base and delta folders, merged when read.

    A micro-batch writes one delta, its last row per key, to a folder named after the batch,
    so its cost follows the batch and not the table. A replayed batch replaces its own folder,
    which makes the sink exactly-once. After every ``compact_every`` micro-batches the deltas
    are folded into a new base; readers open the newest complete base and the deltas after it,
    no other folder. A base that is complete is not written again, so a replay of the batch that
    made it reads nothing it writes. What is older than the base before the newest is removed. A
    key whose last row has the boolean column ``dropped`` set is gone, from the next base on for
    good.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], order: list[str],
        compact_every: int = 100, dropped: str | None = None,
    ):
        self.spark, self.path, self.keys, self.order = spark, path, keys, order
        self.compact_every, self.dropped = compact_every, dropped

    def exists(self) -> bool:
        return has_files(self.spark, self.path)

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        last = latest_per_key(batch, self.keys, self.order)
        last.write.mode("overwrite").parquet(f"{self.path}/kind=delta/upto={batch_id}")
        if batch_id % self.compact_every == self.compact_every - 1:
            self.compact(batch_id)

    def _folder(self, kind: str, upto: int) -> str:
        return f"{self.path}/kind={kind}/upto={upto}"

    def _complete(self, kind: str) -> list[int]:
        """The numbers of the folders whose writing has ended."""
        jvm, top = self.spark.sparkContext._jvm, f"{self.path}/kind={kind}"
        if not has_files(self.spark, top):
            return []
        folder = jvm.org.apache.hadoop.fs.Path(top)
        system = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        marks = system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{top}/upto=*/_SUCCESS"))
        return sorted(int(m.getPath().getParent().getName().removeprefix("upto=")) for m in marks)

    def read(self, before: int | None = None) -> DataFrame:
        """The current rows; with ``before``, as they were ahead of that micro-batch."""
        bases, deltas = ([n for n in self._complete(k) if before is None or n < before] for k in ("base", "delta"))
        later = [n for n in deltas if not bases or n > bases[-1]]
        folders = [self._folder("base", n) for n in bases[-1:]] + [self._folder("delta", n) for n in later]
        if not folders:
            # Nothing was written before: the columns of the table, without rows.
            return self.spark.read.parquet(self.path).drop("kind", "upto").limit(0)
        rows = self.spark.read.option("basePath", self.path).parquet(*folders)
        if not later:
            return rows.drop("kind", "upto")
        # Between equal orders the later batch wins.
        latest = latest_per_key(rows, self.keys, [*self.order, "upto"]).drop("kind", "upto")
        return latest.where(~F.col(self.dropped)) if self.dropped else latest

    def compact(self, upto: int | None = None) -> None:
        """Fold everything up to a micro-batch, the last one unless given, into a base."""
        bases, deltas = self._complete("base"), self._complete("delta")
        upto = max([*bases, *deltas], default=0) if upto is None else upto
        if upto in bases or not deltas:
            return
        self.read(before=upto + 1).write.mode("overwrite").parquet(self._folder("base", upto))
        if not bases:
            return
        # The base before stays for those who are reading it.
        for kind, numbers, oldest in (("base", bases, bases[-1]), ("delta", deltas, bases[-1] + 1)):
            for number in numbers:
                if number < oldest:
                    self._remove(self._folder(kind, number))

    def _remove(self, path: str) -> None:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


IDENTIFIER = re.compile(r"[A-Za-z_]\w*")


def _checked(name: str) -> str:
    if not IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def text_schema(columns: str, key: str | None = None) -> T.StructType:
    """All-string schema from a comma list; the key (default ``id``) comes from the config."""
    names = [_checked(c.strip()) for c in columns.split(",") if c.strip()]
    key = key or "id"
    if key not in names:
        names.insert(0, _checked(key))
    return T.StructType([T.StructField(n, T.StringType(), nullable=n != key) for n in names])


# What may follow the location of a table; text of other engines is refused.
CLAUSES = re.compile(r"(\s*(COMMENT\s+'[^']*'|TBLPROPERTIES\s*\(([^()';]|'[^']*')*\)))*\s*", re.IGNORECASE)


def _clauses(extend: str | None) -> str:
    if not CLAUSES.fullmatch(extend or ""):
        raise ValueError(f"not a comment or table properties: {extend!r}")
    return extend or ""


def create_table_if_absent(
    spark: SparkSession, name: str, columns: str, path: str, key: str | None = None, extend: str | None = None
) -> None:
    """The table a routed record goes to: text columns, stored as Parquet at ``path``.

    ``extend`` is the configured text after the column list; here it may set table properties, as
    in ``COMMENT 'x'`` or ``TBLPROPERTIES (...)``.
    """
    fields = ", ".join(f"`{f.name}` STRING" for f in text_schema(columns, key))
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{_checked(name)}` ({fields}) USING parquet LOCATION '{location}' {_clauses(extend)}")
