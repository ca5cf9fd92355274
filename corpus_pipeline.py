"""The corpus pipeline: quality, line dedup, near-dedup, mixing, packing.

``STAGES`` are functions of (session, documents, folder of tables). All but the last give the
columns of ``documents``; ``run`` writes each stage's rows to a table and reads them again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm import line_dedup, mixing, near_dedup, packing, quality
from brooklet.llm.catalog import END_ID, SEQUENCE, held_out, tokenizer_definition
from brooklet.llm.common import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _like(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, the number of characters counted anew."""
    rows = rows.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else rows
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def _carried(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``doc_id`` and ``text`` beside all columns of ``docs`` under names that no operator uses, and these names."""
    names = {f"carried_{i}": c for i, c in enumerate(docs.columns)}
    columns = [F.col(f"`{c}`").alias(n) for n, c in names.items()]
    return docs.select("doc_id", "text", *columns), names


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, unchanged."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows, names = _carried(docs)
    scored = quality.score(rows, labels, learn_from=~held_out(F.col("doc_id")), carry=list(names))
    return scored.filter("score >= 0.5").select(*[F.col(n).alias(c) for n, c in names.items()])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long lines that five documents share; none is dropped."""
    rows, names = _carried(docs)
    names = {n: c for n, c in names.items() if c != "text"}
    kept = line_dedup.drop_shared_lines(rows, carry=list(names))
    return _like(kept.select("text", *[F.col(n).alias(c) for n, c in names.items()]), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, that with the smallest id."""
    found = near_dedup.near_duplicates(docs, words=5, part=80, whole=100)
    kept = found.filter("kept").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    keyed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), near_dedup.text_key(F.col("text")).alias("key"))
    same = keyed["id"].eqNullSafe(kept["id"]) & (keyed["key"] == kept["key"])
    return keyed.join(kept, same, "left_semi").dropDuplicates(["id", "key"]).select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, in its order."""
    return _like(mixing.mixed_documents(docs), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of token ids."""
    return packing.pack(docs, tokenizer_definition(), SEQUENCE, END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifier nor the tokenizer; the tests hold each stage against
#: a plain version of it instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
