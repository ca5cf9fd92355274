"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.session import scratch_path

#: ASCII white space as a character class of Java's, DuckDB's and Python's patterns.
WHITE = r"\x20\x09-\x0D"
WORD = rf"[^{WHITE}]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE_CHARS = " \t\n\x0b\x0c\r"


def lower_ascii(text: Column) -> Column:
    """A to Z lower-cased, all other letters as they are."""
    return F.translate(text, UPPER, LOWER)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows from a table in the shared folder: lineage ends there, and a lost executor
    costs a read. The table goes when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """What is run in here leaves no shuffle files: for tables that are written down, and then read instead."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Python tasks get at most so many rows at once, as texts may be very long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) != rows:
        spark.conf.set(key, str(rows))


def free_name(wanted: str, taken: Sequence[str]) -> str:
    """``wanted``, or with underscores before it, so that it clashes with no column of ``taken``."""
    names = {name.lower() for name in taken}
    while wanted.lower() in names:
        wanted = f"_{wanted}"
    return wanted


def digest(text: Column) -> Column:
    """SHA-256 of the text's UTF-8 bytes as lower-case hex."""
    return F.sha2(text.cast("binary"), 256)
