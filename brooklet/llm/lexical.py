"""Ranked lexical search in reverse: items wait in an inverted index, documents stream past.

The items' terms make an inverted index of bounded size, which every task gets. Each document's
counts of these terms run through it once, and give the document's score for all items at once;
a task keeps the best few documents of each item, and the tasks' lists are merged.

Where the items' index would pass its bound, items are dealt to blocks, each with an index of its
own that all documents stream through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brooklet.llm.common import small_batches, written
from brooklet.llm.words import kinds_of_bytes, slabs, split_words, valid_text

#: Entries (an item and one of its terms), and items, that one index may hold; a single item with
#: more terms has an index to itself.
ENTRIES, ITEMS = 1 << 18, 1 << 12
#: Scores that a task computes at once, and entries that it adds up for them.
CELLS, ADDED = 1 << 20, 1 << 21
#: Lists of an item that one task merges first.
PARTS = 32

SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
KINDS = kinds_of_bytes(SEPARATORS)


@dataclass
class Index:
    """Terms in order, and for each the items that hold it."""

    rows: np.ndarray  # Numbers of the items' rows, by place of the item.
    item_ids: list  # By place of the item.
    terms: list[str]
    starts: np.ndarray  # Where each term's entries begin; one more at the end.
    items: np.ndarray  # Places of items, by entry.
    counts: np.ndarray  # How often the item has the term, by entry.


def _entries(items: DataFrame) -> DataFrame:
    """``item`` (a number of the row), ``item_id``, ``term`` and ``count`` for each row and term."""

    def run(batches):
        import pyarrow as pa

        for table in slabs(batches, "text"):
            words = split_words(table.column("text").combine_chunks(), KINDS, small=True)
            distinct, codes = words.encoded()
            row = np.repeat(np.arange(len(table)), words.lengths())
            pairs, counts = np.unique(row * max(len(distinct), 1) + codes, return_counts=True)
            at = pa.array(pairs // max(len(distinct), 1))
            yield pa.RecordBatch.from_arrays([
                table.column("item").combine_chunks().take(at), table.column("item_id").combine_chunks().take(at),
                distinct.take(pa.array(pairs % max(len(distinct), 1))).cast(pa.large_string()).cast(pa.string()), pa.array(counts.astype(np.int64)),
            ], names=["item", "item_id", "term", "count"])

    return items.mapInArrow(run, "item long, item_id long, term string, count long")


def _blocks(entries: DataFrame) -> int:
    """Into how many blocks items are dealt by hash, so that no block is over twice the bounds."""
    total, items = entries.agg(F.count(F.lit(1)), F.count_distinct("item")).first()
    blocks = max(1, math.ceil(total / ENTRIES), math.ceil(items / ITEMS))
    while blocks > 1:
        sizes = entries.groupBy(F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block"), "item").agg(F.count(F.lit(1)).alias("n"))
        sizes = sizes.groupBy("block").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("items"))
        if sizes.filter((F.col("items") > 1) & ((F.col("n") > 2 * ENTRIES) | (F.col("items") > 2 * ITEMS))).isEmpty():
            break
        blocks *= 2
    return blocks


def _index(entries: DataFrame, block: int, blocks: int) -> Index:
    rows = entries.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toPandas() if blocks > 1 else entries.toPandas()
    rows = rows.sort_values(["term", "item"], kind="stable")
    items, first = np.unique(rows["item"].to_numpy(), return_index=True)
    ids = rows["item_id"].astype("Int64").iloc[first]
    terms, starts = np.unique(rows["term"].to_numpy(dtype=object), return_index=True)
    return Index(
        items, [None if x is None or x != x else int(x) for x in ids.astype(object).where(ids.notna(), None)], list(terms), np.append(starts, len(rows)),
        np.searchsorted(items, rows["item"].to_numpy()), rows["count"].to_numpy(np.int64))


def _counted(docs: DataFrame, index: Index) -> DataFrame:
    """``doc_id``, ``n`` (all terms of the document), and ``terms`` and ``counts`` of those in the index,
    for each document with a term."""
    terms = docs.sparkSession.sparkContext.broadcast(index.terms)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        known = pa.array([t.encode() for t in terms.value], pa.large_binary())
        for table in slabs(batches, "text"):
            words = split_words(table.column("text").combine_chunks(), KINDS, small=True)
            distinct, codes = words.encoded()
            places = pc.fill_null(pc.index_in(distinct, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = words.lengths()
            term, row = places[codes], np.repeat(np.arange(len(table)), lengths)
            pairs, counts = np.unique((row * len(known) + term)[term >= 0], return_counts=True)
            some = np.flatnonzero(lengths)
            offsets = pa.array(np.append(np.searchsorted(pairs // max(len(known), 1), some), len(pairs)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                table.column("doc_id").combine_chunks().take(pa.array(some)), pa.array(lengths[some]),
                pa.ListArray.from_arrays(offsets, pa.array((pairs % max(len(known), 1)).astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32))),
            ], names=["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


def length_factors(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """``m`` of the ranking formula by document length, in whole numbers of any size."""
    if int(n.max(initial=0)) * 75 * documents < 1 << 63:
        return 25 + 75 * n * documents // total
    return np.array([25 + 75 * int(x) * documents // total for x in n], np.int64)


class Best:
    """The best documents of each item: highest score first, then smallest id, null ids last."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.least = np.ones(items, np.int64)  # A document below this score has no place.
        self.item = self.score = self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """Scores of documents (rows) for items (columns)."""
        at, item = np.nonzero(scores >= self.least)
        if not len(at):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[at, item]])
        doc, null = np.concatenate([self.doc, doc[at]]), np.concatenate([self.null, null[at]])
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        stay = order[rank < self.k]
        full = order[rank == self.k - 1]
        self.least[item[rank == self.k - 1]] = score[full]
        self.item, self.score, self.doc, self.null = item[rank < self.k], score[stay], doc[stay], null[stay]


def _scored(counted: DataFrame, index: Index, weights: np.ndarray, documents: int, total: int, k: int) -> DataFrame:
    """Each task's best documents of each item: ``item``, ``item_id``, ``doc_id``, ``score``."""
    shared = counted.sparkSession.sparkContext.broadcast((
        index.rows, index.item_ids, index.starts, index.items, index.counts * np.repeat(weights, np.diff(index.starts))))

    def pieces(begin: np.ndarray, work: np.ndarray, items: int) -> Iterator[tuple[int, int]]:
        """Runs of documents with bounded work; ``begin`` is where a document's terms begin."""
        before, done, rows = np.concatenate([[0], np.cumsum(work)])[begin], 0, max(1, CELLS // max(items, 1))
        while done < len(begin) - 1:
            end = int(np.searchsorted(before, before[done] + ADDED, side="right")) - 1
            end = min(max(end, done + 1), done + rows, len(begin) - 1)
            yield done, end
            done = end

    def run(batches):
        import pyarrow as pa

        rows, item_ids, starts, items, gains = shared.value
        holders, best = np.diff(starts), Best(len(item_ids), k)
        for batch in batches:
            lists = batch.column(2)
            begin = lists.offsets.to_numpy().astype(np.int64)
            terms = lists.values.to_numpy().astype(np.int64)
            counts = batch.column(3).values.to_numpy().astype(np.int64)[:len(terms)]
            ids = batch.column(0)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            doc = ids.fill_null(0).to_numpy()
            m = length_factors(batch.column(1).to_numpy(), documents, total)
            terms, counts, begin = terms[begin[0]:begin[-1]], counts[begin[0]:begin[-1]], begin - begin[0]
            impact = 1_000_000_000 * counts // (1000 * counts + 8 * np.repeat(m, np.diff(begin)))
            for first, last in pieces(begin, holders[terms], len(item_ids)):
                at = slice(begin[first], begin[last])
                many = holders[terms[at]]
                ends = np.cumsum(many)
                entry = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[terms[at]] - (ends - many), many)
                row = np.repeat(np.repeat(np.arange(last - first), np.diff(begin[first:last + 1])), many)
                scores = np.zeros((last - first) * len(item_ids), np.int64)
                np.add.at(scores, row * len(item_ids) + items[entry], gains[entry] * np.repeat(impact[at], many))
                best.add(scores.reshape(last - first, -1), doc[first:last], null[first:last])
        yield pa.RecordBatch.from_arrays([
            pa.array(rows[best.item].astype(np.int64)), pa.array([item_ids[i] for i in best.item.tolist()], pa.int64()),
            pa.array(best.doc, mask=best.null), pa.array(best.score),
        ], names=["item", "item_id", "doc_id", "score"])

    return counted.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The best of all tasks' lists: parts of an item's lists first, then what is left of them."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    lists = lists.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    for by in (["item", "part"], ["item"]):
        lists = lists.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)
    return lists.select("item_id", "rank", "doc_id", "score")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each row of ``items``: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Terms are runs of ASCII letters and digits and characters beyond ASCII, A to Z lower-cased; bytes
    that are no UTF-8 count as U+FFFD. With N documents that have a term, L their terms together, n those
    of one document and df the documents that hold a term, a term weighs floor(1000 ln((2N + 2) / (2df + 1)));
    m is 25 + 75nN div L, and a document that has the term tf times scores the weight times
    10^9 tf div (1000 tf + 8m) for each time that the item has it.

    Documents score above 0 or are left out. Equal scores go by id, null ids last. Null and empty texts
    have no terms: such items have no rows, such documents count nowhere. Each row is a document or an
    item of its own, also if it repeats an id; equal rows of ``docs`` take as many ranks. Very long texts
    are read whole, at least one at a time. An empty table on either side gives no rows. Other columns
    play no part.

    Documents are read once for each block of items (one block up to ``ENTRIES`` entries and ``ITEMS``
    items), and their counts of the items' terms are written down; nothing of them is shuffled but
    each task's ``k`` best.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), valid_text(F.col(f"`{text_column}`")).alias("text"))
    entries = written(_entries(items.select(
        F.monotonically_increasing_id().alias("item"), F.col(f"`{item_column}`").cast("long").alias("item_id"),
        valid_text(F.col(f"`{item_text_column}`")).alias("text"))), "entries")
    blocks, lists = _blocks(entries), None
    for block in range(blocks):
        index = _index(entries, block, blocks)
        counted = written(_counted(texts, index), "counted")
        documents, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toPandas()
        df = np.zeros(len(index.terms), np.int64)
        df[holding["term"].to_numpy(np.int64)] = holding["df"].to_numpy(np.int64)
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        found = _scored(counted, index, weights, documents, max(total, 1), k)
        lists = found if lists is None else lists.unionAll(found)
    return _merged(lists, k)
