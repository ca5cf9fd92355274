"""Exact dedup by deterministic block naming (Karp, Miller and Rosenberg, 1972), in DataFrame
expressions.

A normalised text is cut into blocks of fixed size. Distinct blocks are sorted and get integer
names; then adjacent names are paired and the distinct pairs named in turn, until each text has
one name. Two texts of as many levels have the same name only if they are equal.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brooklet.llm.common import WHITE_CHARS, digest, text_or_empty, written

BLOCK_BYTES = 4096
#: Names sorted together in one group; a group's distinct blocks are held in memory at once.
BUCKET_ROWS = 128
SEEDS = 16


class HashClash(RuntimeError):
    """Different blocks shared a 128-bit key under every seed."""


def without_white(text: Column) -> Column:
    return F.translate(text, WHITE_CHARS, "")


def _blocks(bytes_: Column, size: int) -> Column:
    last = F.greatest(F.lit(0), F.floor((F.octet_length(bytes_) - 1) / size).cast("int"))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(bytes_, i * size + 1, F.lit(size)))


def _keys(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed + i), block) for i in range(2)]


def _buckets(rows: int) -> int:
    return max(1, -(-rows // BUCKET_ROWS))


def _name_blocks(blocks: DataFrame, rows: int, seed: int) -> DataFrame:
    """``k0``, ``k1``, ``name``: the integer name of each distinct block by the block's keys.

    Blocks are dealt into buckets by hash. A bucket's distinct blocks are gathered, combined
    before the shuffle so that a block which comes a million times travels once per task, and
    sorted by their bytes; rank and bucket make the name. The bytes end here.
    """
    buckets = _buckets(rows)
    bucket = F.pmod(F.xxhash64(F.lit(-1), "block"), F.lit(buckets))
    ranked = blocks.groupBy(bucket.alias("bucket")).agg(F.array_sort(F.collect_set("block")).alias("blocks"))
    named = ranked.select("bucket", F.posexplode("blocks").alias("rank", "block"))
    return named.select(
        *[k.alias(f"k{i}") for i, k in enumerate(_keys(F.col("block"), seed))],
        (F.col("rank").cast("long") * F.lit(buckets) + F.col("bucket")).alias("name"),
    )


def _name_pairs(pairs: DataFrame, rows: int) -> DataFrame:
    """``l``, ``r``, ``name``: the distinct pairs, sorted by bucket and numbered."""
    buckets = _buckets(rows)
    distinct = pairs.groupBy("l", "r").agg(F.lit(1).alias("one")).withColumn(
        "bucket", F.pmod(F.xxhash64("l", "r"), F.lit(buckets)))
    rank = F.row_number().over(W.partitionBy("bucket").orderBy("l", "r")).cast("long")
    return distinct.select(
        F.col("l").alias("nl"), F.col("r").alias("nr"), (rank * F.lit(buckets) + F.col("bucket")).alias("name"))


def name_texts(texts: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Names of the column ``text`` of ``texts``, which has no nulls.

    Gives two tables: the given rows without ``text`` but with a number ``row``, and ``row``,
    ``level``, ``name``. Rows of one level and name, and no others, have equal texts.

    Names travel by 128-bit keys of the blocks, so that bytes are shuffled once. That is exact:
    the names are checked to be one per key, and if ever a key has two, all is named again under
    other keys. One job per level; there are about log2(longest text / block_bytes) levels.
    """
    bytes_ = F.col("text").cast("binary")
    for seed in range(SEEDS):
        keys = F.transform(_blocks(F.col("bytes"), block_bytes), lambda b: F.struct(  # noqa: B023
            *[k.alias(f"k{i}") for i, k in enumerate(_keys(b, seed))]))  # noqa: B023
        others = [c for c in texts.columns if c != "text"]
        rows = written(texts.select(
            F.monotonically_increasing_id().alias("row"), *others, bytes_.alias("bytes"),
        ).select("row", *others, keys.alias("keys")), "block-keys")
        size = rows.agg(F.sum(F.size("keys")).alias("blocks"), F.max(F.size("keys")).alias("most")).first()
        if not size["blocks"]:
            empty = rows.select("row", F.lit(0).alias("level"), F.lit(0).cast("long").alias("name"))
            return rows.drop("keys"), empty
        blocks = texts.select(bytes_.alias("bytes")).select(F.explode(_blocks(F.col("bytes"), block_bytes)).alias("block"))
        names = written(_name_blocks(blocks, size["blocks"], seed), "block-names")
        if names.groupBy("k0", "k1").agg(F.count("name").alias("names")).filter("names > 1").isEmpty():
            break
    else:
        raise HashClash(f"{SEEDS} seeds")

    places = rows.select("row", F.size("keys").alias("blocks"), F.posexplode("keys").alias("place", "key"))
    current = places.select("row", "blocks", "place", "key.*").join(names, ["k0", "k1"]).select(
        "row", "blocks", "place", "name")
    level, most, done = 0, size["most"], []
    while most > 1:
        current = written(current, f"names-{level}")
        done.append(current.filter("blocks = 1").select("row", F.lit(level).alias("level"), "name"))
        side = F.col("place") % 2
        pairs = current.filter("blocks > 1").groupBy(
            "row", F.ceil(F.col("blocks") / 2).cast("int").alias("blocks"), F.floor(F.col("place") / 2).cast("int").alias("place"),
        ).agg(
            F.max(F.when(side == 0, F.col("name"))).alias("l"),
            F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1).cast("long")).alias("r"),
        )
        pair_names = _name_pairs(pairs, current.filter("blocks > 1").count())
        current = pairs.join(pair_names, (F.col("l") == F.col("nl")) & (F.col("r") == F.col("nr"))).select(
            "row", "blocks", "place", "name")
        level, most = level + 1, -(-most // 2)
    done.append(current.filter("blocks = 1").select("row", F.lit(level).alias("level"), "name"))
    return rows.drop("keys"), reduce(DataFrame.unionAll, done)


def dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256`` (of the normalised text).

    Texts are equal when they are identical without ASCII white space; null counts as empty. Of
    equal texts the row with the most code points stays, then that with the smallest id, a null
    id last; of rows that are alike in both, one stays. Other columns play no part.

    Sizes and winners of groups are combined before the shuffle; the winners then meet their
    groups in a join that adaptive execution can split.
    """
    text = text_or_empty(F.col(f"`{text_column}`"))
    given = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.length(text).alias("chars"), without_white(text).alias("text"))
    rows, names = name_texts(given.select("doc_id", "chars", digest(F.col("text")).alias("sha"), "text"), block_bytes)
    named = rows.join(names, "row")
    first = F.struct(
        (-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("without"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    # Written down, so that the join may send it to all tasks, or else split the largest groups.
    groups = written(named.groupBy(F.col("level").alias("gl"), F.col("name").alias("gn")).agg(
        F.min(first).alias("first"), F.count(F.lit(1)).alias("group_size")), "groups")
    return named.join(groups, (F.col("level") == F.col("gl")) & (F.col("name") == F.col("gn"))).select(
        "doc_id", F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
