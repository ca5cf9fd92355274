"""Spark session and shared-folder settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "brooklet", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution on.

    Shuffle partitions are left to the cluster's own setting unless given: adaptive
    execution coalesces small ones, and splits skewed ones in joins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    ``spark.checkpoint.dir`` decides; a temporary folder is made only where it is unset
    and the session is local, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="brooklet-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created there yet."""
    return f"{shared_folder(spark)}/{label}-{os.urandom(6).hex()}"


def materialised(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """The rows as a table in the shared folder, split by a column if asked: what several readers
    need is computed once, and its lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
