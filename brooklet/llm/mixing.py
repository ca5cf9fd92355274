"""Mixing of sources to target weights by a low-discrepancy schedule.

A slot of the mix takes one block of equally many words. Slot ``i`` looks up the golden-ratio
point ``frac(i * phi)`` in the cumulative weights, which names its source; slots are ranked within
their source, and the slot of rank ``r`` takes block ``r`` of the source's shuffled documents, which
are gone through again when they end. Any stretch of the schedule is close to the weights.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brooklet.llm.common import WHITE, WORD, written

# Fixed value: the fractional part of the golden ratio.
GOLDEN = (math.sqrt(5) - 1) / 2

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK_WORDS = 256
MAX_REPEATS = 3
#: Slots ranked together, and documents summed up together, in one task.
STRETCH = 1 << 16
ROWS_PER_BUCKET = 16_384


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source``, ``source_size``, ``target``, ``quota`` for ``source``, ``source_size``.

    Sources in order of code points, null last, weigh ``weights``, repeating, and share the sum of
    all sizes. Targets stop at ``max_repeats`` times their source's size; the excess is shared again
    by weight until none is above. Who stops is found by order instead of rounds: the sources with
    the least size per weight stop first, so running sums over them tell, for each, the share that
    the others would get. ``quota`` is the target in whole words. One row per source.
    """
    by_name = W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    ranked = sizes.withColumn("turn", (F.row_number().over(by_name) - 1) % len(weights))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("turn"))
    full = W.orderBy("stop", F.col("source").isNull(), F.col("source").cast("binary"))
    before, whole = full.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    room = F.lit(max_repeats).cast("long") * F.col("source_size")
    shares = ranked.withColumn("weight", weight).withColumn("room", room).withColumn(
        "stop", F.col("room").cast("double") / F.col("weight"),
    ).select(
        "*", F.sum("source_size").over(whole).alias("total"), F.sum("weight").over(whole).alias("weights"),
        F.coalesce(F.sum("room").over(before), F.lit(0)).alias("stopped"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("stopped_weight"),
    ).withColumn(
        # Words a unit of weight gets if exactly the sources before this one have stopped.
        "level", (F.col("total") - F.col("stopped")).cast("double") / (F.col("weights") - F.col("stopped_weight")),
    )
    open_level = F.min(F.when(F.col("level") <= F.col("stop"), F.struct("stop", "level"))).over(whole)["level"]
    target = F.least(F.col("room").cast("double"), F.coalesce(F.col("weight") * open_level, F.col("room").cast("double")))
    return shares.withColumn("target", target).select(
        "source", "source_size", "target", F.least(F.round("target").cast("long"), F.col("room")).alias("quota"))


def _before(df: DataFrame, group: str, block: str, order: Sequence[str], amount: str, column: str) -> DataFrame:
    """Add ``column``: the sum of ``amount`` over the rows before, in ``group`` by ``block`` and ``order``.

    Blocks' totals give the offsets, windows hold one block each. ``df`` is read twice.
    """
    earlier = W.partitionBy("of").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    offsets = df.groupBy(F.col(group).alias("of"), F.col(block).alias("at")).agg(F.sum(amount).alias("amounts")).select(
        "of", "at", F.coalesce(F.sum("amounts").over(earlier), F.lit(0)).alias("offset"))
    inside = F.coalesce(F.sum(amount).over(
        W.partitionBy(group, block).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    same = F.col(group).eqNullSafe(F.col("of")) & (F.col(block) == F.col("at"))
    return df.withColumn("inside", inside).join(offsets, same).withColumn(
        column, (F.col("offset") + F.col("inside")).cast("long")).drop("inside", "offset", "of", "at")


def schedule(plan: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix: ``slot``, ``source``, ``rank``, ``first`` (its first word among the
    words that the source gives) and ``words``.

    ``plan`` is what ``targets`` gives. A source whose quota is used up leaves its later slots
    empty; blocks that the sequence has left open when it ends come after it, source by source,
    so every source gives its quota to the word. The last block of a source may be short.
    """
    spark = plan.sparkSession
    plan = plan.filter("quota > 0")
    sums = plan.agg(F.sum("quota").alias("words"), F.count(F.lit(1)).alias("sources")).first()
    slots = -(-(sums["words"] or 0) // block_words) + (sums["sources"] or 0)
    up_to = W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    cumulative = plan.withColumn("upper", F.sum("quota").over(up_to)).select(
        "source", "quota", "upper", (F.col("upper") - F.col("quota")).alias("lower"))
    point = F.pmod(F.col("id").cast("double") * F.lit(GOLDEN), F.lit(1.0))
    drawn = spark.range(slots).select(
        F.col("id").alias("slot"), F.floor(point * F.lit(sums["words"] or 0)).cast("long").alias("word"))
    # Sources and slots meet in cells of the line of words: a cell has few sources, a slot one cell.
    width = max(1, (sums["words"] or 0) // (1024 + 4 * (sums["sources"] or 0)))
    covered = cumulative.select("*", F.explode(F.sequence(
        F.floor(F.col("lower") / width), F.floor((F.col("upper") - 1) / width))).alias("cell"))
    drawn = drawn.withColumn("cell", F.floor(F.col("word") / width)).join(covered, "cell").filter(
        (F.col("word") >= F.col("lower")) & (F.col("word") < F.col("upper"))).select(
        "slot", "source", "quota", F.floor(F.col("slot") / STRETCH).alias("stretch"), F.lit(1).alias("one"))
    ranked = _before(drawn, "source", "stretch", ["slot"], "one", "rank")
    blocks = F.ceil(F.col("quota") / block_words).cast("long")
    taken = ranked.filter(F.col("rank") < blocks).select("slot", "source", "rank", "quota")
    given = drawn.groupBy(F.col("source").alias("of")).agg(F.count(F.lit(1)).alias("drawn"))
    open_ = plan.join(given, F.col("source").eqNullSafe(F.col("of")), "left").withColumn(
        "drawn", F.coalesce("drawn", F.lit(0)).cast("long")).filter(F.col("drawn") < blocks).withColumn(
        "open", blocks - F.col("drawn")).withColumn(
        "at", F.coalesce(F.sum("open").over(up_to.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    tail = open_.select("source", "quota", "drawn", "at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("open") - 1)).alias("i")).select(
        (F.lit(slots) + F.col("at") + F.col("i")).alias("slot"), "source", (F.col("drawn") + F.col("i")).alias("rank"), "quota")
    first = F.col("rank") * block_words
    return taken.unionByName(tail).select(
        "slot", "source", "rank", first.alias("first"), F.least(F.lit(block_words), F.col("quota") - first).cast("long").alias("words"))


def shuffle_key(doc_id: Column, text: Column, seed: int = 0) -> Column:
    """What the documents of a source are ordered by."""
    return F.xxhash64(F.lit(seed), doc_id, text)


def first_words(text: Column, n: Column) -> Column:
    """The text up to its ``n``-th word, white space as it is."""
    words = F.split(text, rf"(?<=[^{WHITE}])(?=[{WHITE}])", -1)
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, seed: int = 0, id_column: str = "doc_id", text_column: str = "text", **parameters) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, in the order of its slots.

    A document that an epoch takes in part has its first words only: the mix goes through a
    source from its start, so only the last document before the end is cut. Parameters are those of
    ``mix``. Rows equal in id and text share what is taken of them all.
    """
    key = shuffle_key(F.col(f"`{id_column}`"), F.col(f"`{text_column}`"), seed)
    documents, taken = mix(docs, seed=seed, id_column=id_column, text_column=text_column, **parameters)
    turns = taken.groupBy("row", "doc_id", "shuffle", "epoch").agg(F.min("slot").alias("slot"), F.min("at").alias("at"), F.sum("words").alias("words"))
    sizes = documents.select(F.col("row").alias("of"), "size")
    turns = turns.join(sizes, F.col("row") == F.col("of")).select("slot", "at", "doc_id", "shuffle", "words", (F.col("words") < F.col("size")).alias("cut"))
    texts = docs.select(F.struct("*").alias("doc"), F.col(f"`{id_column}`").alias("id"), key.alias("key")).dropDuplicates(["id", "key"])
    met = turns.join(texts, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("shuffle") == F.col("key"))).orderBy("slot", "at", "doc_id")
    text = F.col(f"doc.`{text_column}`")
    return met.select(*[
        F.when(F.col("cut"), first_words(text, F.col("words"))).otherwise(text).alias(c) if c == text_column else F.col(f"doc.`{c}`")
        for c in docs.columns])


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS,
    seed: int = 0, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs``: a table of documents, and a table of what each slot takes of them.

    Documents: ``row``, ``doc_id``, ``shuffle`` (``shuffle_key``), ``source``, ``size``, ``source_size``,
    ``target``. Pieces: ``slot``, ``row``, ``doc_id``, ``shuffle``, ``epoch``, ``begin`` and ``words``: words
    ``begin`` to ``begin + words`` of the document, the slot's pieces being in ascending order of ``at``.

    Null ids and sources are values of their own; null texts have no words, are never drawn and
    still count as documents; rows that repeat are drawn each for itself. Other columns play no
    part. Sources are shuffled by a hash of id and text, so reruns agree. Sums over a source are
    made block-wise: no task holds a source, only the plan with its row per source.
    """
    text = F.col(f"`{text_column}`")
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").alias("doc_id"),
        F.col(f"`{source_column}`").alias("source"), word_count(text).alias("size"),
        shuffle_key(F.col(f"`{id_column}`"), text, seed).alias("shuffle"),
    ), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = written(targets(sizes, weights, max_repeats), "mix-plan")
    sourced = plan.select(F.col("source").alias("of"), "source_size", "target")
    documents = rows.join(sourced, F.col("source").eqNullSafe(F.col("of"))).select(
        "row", "doc_id", "shuffle", "source", "size", "source_size", "target")

    buckets = max(1, -(-rows.count() // ROWS_PER_BUCKET))
    # Buckets are stretches of the hash, so that their order is that of the shuffle.
    bucket = F.floor((F.shiftright("shuffle", 32) + F.lit(1 << 31)) * F.lit(buckets) / F.lit(1 << 32)).cast("long")
    stream = _before(rows.filter("size > 0").withColumn("bucket", bucket), "source", "bucket", ["shuffle", "doc_id", "row"], "size", "start")
    # Blocks of an epoch: a document lies in each block that it has words in.
    pieces = stream.select(
        "row", "doc_id", "shuffle", "source", "size", "start",
        F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))).alias("block"))
    begin = F.greatest(F.col("block") * block_words, F.col("start"))
    pieces = pieces.select(
        "row", "doc_id", "shuffle", F.col("source").alias("of"), "block", begin.alias("word"), (begin - F.col("start")).alias("begin"),
        (F.least((F.col("block") + 1) * block_words, F.col("start") + F.col("size")) - begin).alias("length"))
    # A slot's words may end one epoch and begin the next, so they may lie in several blocks.
    slots = schedule(plan, block_words).join(sourced.select("of", "source_size"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    epoch, last = F.floor(F.col("first") / F.col("source_size")), F.floor((F.col("first") + F.col("words") - 1) / F.col("source_size"))
    parts = slots.select("*", F.explode(F.sequence(epoch, last)).alias("epoch")).select(
        "slot", "source", "epoch", (F.col("epoch") * F.col("source_size")).alias("base"),
        F.greatest(F.col("first") - F.col("epoch") * F.col("source_size"), F.lit(0)).alias("low"),
        F.least(F.col("first") + F.col("words") - F.col("epoch") * F.col("source_size"), F.col("source_size")).alias("high"))
    parts = parts.select("*", F.explode(F.sequence(F.floor(F.col("low") / block_words), F.floor((F.col("high") - 1) / block_words))).alias("part"))
    met = parts.join(pieces, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("block")))
    low = F.greatest("low", "word")
    high = F.least(F.col("high"), F.col("word") + F.col("length"))
    taken = met.filter(high > low).select(
        "slot", "row", "doc_id", "shuffle", "epoch", (F.col("base") + low).alias("at"), (F.col("begin") + low - F.col("word")).alias("begin"),
        (high - low).alias("words"))
    return documents, taken
