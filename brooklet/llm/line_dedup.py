"""Removal of lines that many documents share, in DataFrame expressions.

Lines are exploded with their place, their normalised keys hashed, and the distinct documents of
each hash counted. Lines of hashes over the threshold go, except in the last document that holds
them; what is left is put together by place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.llm.common import WHITE_CHARS, lower_ascii, text_or_empty, written


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A to Z lower-cased."""
    return lower_ascii(F.trim(line, F.lit(WHITE_CHARS)))


def _long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``id``, ``place`` and a 128-bit hash ``h``, ``g`` of each line whose key is long enough.

    Only hashes and places leave the scan. A line shorter than ``min_chars`` can have no longer
    key, so its key is not even made.
    """
    lines = F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(
        i.alias("place"), F.when(F.length(line) >= min_chars, line_key(line)).alias("key")))
    wanted = F.filter(lines, lambda x: F.length(x["key"]) >= min_chars)
    hashed = F.transform(wanted, lambda x: F.struct(
        x["place"].alias("place"), F.xxhash64(x["key"]).alias("h"), F.xxhash64(F.lit(1), x["key"]).alias("g")))
    return docs.select("id", F.explode(hashed).alias("line")).select("id", "line.*")


def drop_shared_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_column: str = "doc_id", text_column: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text`` (the lines that stay, joined by newlines),
    ``n_lines`` (before), ``n_dropped``, and the columns ``carry`` as they are.

    Texts are split at newlines; null and empty texts are one empty line. Keys (``line_key``) of
    at least ``min_chars`` code points that are found in at least ``min_docs`` documents lose all
    their lines except in the document with the largest id that holds them, which keeps them all.
    Rows that repeat an id count as one document; each loses the places that any of them loses.
    A null id is a document of its own, below all others. Other columns play no part.

    Distinct documents are counted in two steps, so a line that most documents share is combined
    before it is shuffled; the lines are then matched with the keys over the threshold by a join
    that adaptive execution can split. Texts are moved once at most, to meet their places.
    """
    here = docs.select(
        F.col(f"`{id_column}`").alias("id"), text_or_empty(F.col(f"`{text_column}`")).alias("text"),
        *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(carry)])
    carried = [f"_{i}" for i in range(len(carry))]
    lines = _long_lines(here, min_chars)
    # Written down, so that the join may send it to all tasks, or else split its largest keys.
    shared = written(
        lines.groupBy("h", "g", "id").agg(F.lit(1).alias("one"))
        .groupBy("h", "g").agg(F.count("one").alias("docs"), F.max("id").alias("last"))
        .filter(F.col("docs") >= min_docs).select(F.col("h").alias("sh"), F.col("g").alias("sg"), "last"),
        "shared-lines")
    gone = (
        lines.join(shared, (F.col("h") == F.col("sh")) & (F.col("g") == F.col("sg")) & ~F.col("id").eqNullSafe(F.col("last")))
        .groupBy(F.col("id").alias("of")).agg(F.collect_set("place").alias("gone"))
    )
    parts = F.split("text", "\n", -1)
    none = F.array().cast("array<int>")
    kept = here.join(gone, F.col("id").eqNullSafe(F.col("of")), "left").select(
        "id", *carried, "text", parts.alias("parts"), F.coalesce("gone", none).alias("gone"),
    ).withColumn("stay", F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "gone"))
    text = F.when(F.size("gone") == 0, F.col("text")).otherwise(
        F.array_join(F.transform("stay", lambda i: F.get("parts", i)), "\n"))
    return kept.select(
        F.col("id").alias("doc_id"), text.alias("text"), F.size("parts").cast("long").alias("n_lines"),
        (F.size("parts") - F.size("stay")).cast("long").alias("n_dropped"),
        *[F.col(a).alias(c) for a, c in zip(carried, carry, strict=True)],
    )
