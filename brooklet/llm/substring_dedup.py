"""Removal of passages that stand earlier in the corpus, by relative Lempel-Ziv parsing.

The reference is the corpus itself, cut into blocks by its content: every window of words has an
anchor, its run of a few words with the least hash, and the windows in a row with one anchor are a
block. Equal windows have equal anchors, so the index of blocks is asked by anchor: no block without
that anchor can hold the window.

A document is factored against the index from left to right. A block whose whole text stands earlier
extends the factor that ends before it, if both come from one place. At the boundaries, where a block's
anchor is known but its text is not, its windows are looked up one by one. What comes from one place
without a gap is one factor, and all factors are long enough to be duplicate spans.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.bits import bit_table, marked
from brooklet.llm.common import WHITE_CHARS, shuffles_end, small_batches, written
from brooklet.llm.words import hashes_of, kinds_of_bytes, mixed, slabs, split_words, valid_text

KINDS = kinds_of_bytes(WHITE_CHARS.encode())
#: Words of an anchor.
ANCHOR = 8
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Where a block or window stands: ``at`` is its start and, in the low bits, how many windows it has.
PLACE = ("doc_id", "key", "at")
LOW = 16


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


class Runs:
    """Hashes of any runs of words of a slab of texts."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        powers = np.full(n + 1, BASE)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * powers[:n], out=self.sums[1:])
        back = np.full(n + 1, np.uint64(_inverse(int(BASE))))
        back[0] = 1
        self.back = np.multiply.accumulate(back)

    def of(self, begin: np.ndarray, length) -> np.ndarray:
        return mixed((self.sums[begin + length] - self.sums[begin]) * self.back[begin] + np.asarray(length, np.uint64))


class Blocks:
    """The blocks of a slab of texts: windows in a row that have one anchor."""

    def __init__(self, texts, size: int, anchor: int) -> None:
        words = split_words(texts, KINDS, small=False)
        distinct, codes = words.encoded()
        self.runs = Runs(hashes_of(distinct)[codes])
        lengths = words.lengths()
        row = np.repeat(np.arange(len(lengths)), lengths)
        self.size, windows = size, max(len(row) - size + 1, 0)
        grams = self.runs.of(np.arange(max(len(row) - anchor + 1, 0)), anchor)
        # The least hash of each window, with its place in the low bits, so that the first of equal ones counts.
        low = np.uint64((1 << (size - anchor).bit_length()) - 1)
        high, best = grams & ~low, np.full(windows, np.uint64(2**64 - 1))
        for i in range(size - anchor + 1):
            np.minimum(best, high[i:i + windows] | np.uint64(i), out=best)
        inside = np.flatnonzero(row[:windows] == row[size - 1:size - 1 + windows])  # Windows of one text.
        anchors = inside + (best[inside] & low).astype(np.int64)
        new = np.ones(len(inside), bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (inside[1:] != inside[:-1] + 1)
        first = np.flatnonzero(new)
        self.begin = inside[first]  # Of the block's text, among all words.
        self.windows = np.diff(np.append(first, len(inside)))
        self.anchor = grams[anchors[first]].view(np.int64)
        self.row = row[self.begin]
        self.start = self.begin - (words.ends - lengths)[self.row]

    def texts(self, here: np.ndarray) -> np.ndarray:
        """Hashes of some blocks' texts."""
        return self.runs.of(self.begin[here], self.windows[here] + self.size - 1).view(np.int64)


def _place_hashes(ids, keys, at: np.ndarray) -> np.ndarray:
    """Hashes of where blocks stand, for bit tables, from Arrow arrays of ids and keys."""
    ids, keys = (x.fill_null(-1).to_numpy(zero_copy_only=False).view(np.uint64) for x in (ids, keys))
    return mixed(mixed(ids * BASE + keys) + at.astype(np.uint64)).view(np.int64)


def _anchors(docs: DataFrame, size: int, anchor: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for table in slabs(batches, "text"):
            found = Blocks(table.column("text").combine_chunks(), size, anchor).anchor
            distinct, counts = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(counts)], names=["hash", "n"])

    return docs.mapInArrow(run, "hash long, n long")


def _blocks(docs: DataFrame, shared: DataFrame, size: int, anchor: int) -> DataFrame:
    """Blocks with an anchor of ``shared``, and some others: ``doc_id``, ``key``, ``at``, ``anchor`` and ``a`` (a hash of
    the text)."""
    wanted = docs.sparkSession.sparkContext.broadcast(bit_table(shared))

    def run(batches):
        import pyarrow as pa

        for table in slabs(batches, "text"):
            blocks = Blocks(table.column("text").combine_chunks(), size, anchor)
            here = np.flatnonzero(marked(wanted.value, blocks.anchor))
            row = pa.array(blocks.row[here])
            yield pa.RecordBatch.from_arrays([
                table.column("doc_id").combine_chunks().take(row), table.column("key").combine_chunks().take(row),
                pa.array(blocks.start[here] << LOW | blocks.windows[here]), pa.array(blocks.anchor[here]), pa.array(blocks.texts(here)),
            ], names=["doc_id", "key", "at", "anchor", "a"])

    return docs.mapInArrow(run, "doc_id long, key long, at long, anchor long, a long")


def _windows(docs: DataFrame, places: DataFrame, size: int, anchor: int) -> DataFrame:
    """The windows of the blocks at ``places`` (``PLACE``), and of some others, in the form of blocks."""

    def hashed(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_place_hashes(batch.column(0), batch.column(1), batch.column(2).to_numpy()))], names=["hash"])

    wanted = docs.sparkSession.sparkContext.broadcast(bit_table(places.select(*PLACE).mapInArrow(hashed, "hash long")))

    def run(batches):
        import pyarrow as pa

        for table in slabs(batches, "text"):
            blocks = Blocks(table.column("text").combine_chunks(), size, anchor)
            ids, keys = (table.column(c).combine_chunks().take(pa.array(blocks.row)) for c in ("doc_id", "key"))
            here = np.flatnonzero(marked(wanted.value, _place_hashes(ids, keys, blocks.start << LOW | blocks.windows)))
            many = blocks.windows[here]
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            begin, start = (np.repeat(x[here], many) + step for x in (blocks.begin, blocks.start))
            at = pa.array(np.repeat(here, many))
            yield pa.RecordBatch.from_arrays([
                ids.take(at), keys.take(at), pa.array(start << LOW | 1), pa.array(np.repeat(blocks.anchor[here], many)),
                pa.array(blocks.runs.of(begin, size).view(np.int64)),
            ], names=["doc_id", "key", "at", "anchor", "a"])

    return docs.mapInArrow(run, "doc_id long, key long, at long, anchor long, a long")


def _repeated(windows: DataFrame) -> DataFrame:
    """Windows whose hash occurs twice, and some others."""
    with shuffles_end(windows.sparkSession):
        twice = written(windows.groupBy(F.col("a").alias("hash")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"), "repeated")
    wanted = windows.sparkSession.sparkContext.broadcast(bit_table(twice))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array(marked(wanted.value, batch.column(4).to_numpy())))

    return windows.mapInArrow(run, windows.schema)


def _firsts(units: DataFrame) -> DataFrame:
    """Each text of blocks or windows: where it stands first, and how often."""
    return units.groupBy("anchor", "a").agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("copies"))


def _copies(units: DataFrame, firsts: DataFrame) -> DataFrame:
    """Where units stand that stand earlier too, and where they do first."""
    same = (F.col("anchor") == F.col("of")) & (F.col("a") == F.col("of_a"))
    later = ~F.struct(*PLACE).eqNullSafe(F.col("first"))
    found = firsts.filter("copies > 1").select(F.col("anchor").alias("of"), F.col("a").alias("of_a"), "first")
    return units.join(found, same & later).select(
        *PLACE, F.col("first.doc_id").alias("source_id"), F.col("first.key").alias("source_key"), F.col("first.at").alias("source_at"))


def _pieces(docs: DataFrame, size: int, anchor: int) -> DataFrame:
    """The pieces of each document's factors, and where they are copied from: ``of``, ``of_key``, ``pieces``."""
    spark = docs.sparkSession
    with shuffles_end(spark):
        shared = written(_anchors(docs, size, anchor).groupBy("hash").agg(F.sum("n").alias("n")).filter("n > 1").select("hash"), "shared-anchors")
    blocks = written(_blocks(docs, shared, size, anchor), "blocks")
    with shuffles_end(spark):
        texts = written(_firsts(blocks), "block-texts")
        # An anchor in different texts: the first of each equal text is looked at window by window.
        several = texts.groupBy("anchor").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("anchor")
        edges = written(texts.join(several, "anchor", "left_semi").select("first.*"), "edges")
    windows = written(_windows(docs, edges, size, anchor), "windows")
    repeated = _repeated(windows)
    with shuffles_end(spark):
        # Written down like the blocks', so that the join may split the windows of a hot one.
        firsts = written(_firsts(repeated), "window-firsts")
    with shuffles_end(spark):
        found = _copies(blocks, texts).unionAll(_copies(repeated, firsts))
        return written(found.groupBy(F.col("doc_id").alias("of"), F.col("key").alias("of_key")).agg(
            F.collect_list(F.struct("at", "source_id", "source_key", "source_at")).alias("pieces")), "pieces")


def _joined(row: np.ndarray, start: np.ndarray, windows: np.ndarray, source: Sequence[np.ndarray]) -> np.ndarray:
    """Of pieces in order, which begin a factor: those that do not follow on the one before, in the text and in the source."""
    new = np.ones(len(row), bool)
    if len(row):
        new[1:] = (row[1:] != row[:-1]) | (start[1:] > (start + windows)[:-1])
        for x in source:
            new[1:] |= x[1:] != x[:-1]
    return new


def _cut(docs: DataFrame, size: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for table in slabs(batches, "text"):
            words = split_words(table.column("text").combine_chunks(), KINDS, small=False)
            lengths = words.lengths()
            pieces = table.column("pieces").combine_chunks()
            counts = pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False)
            row, flat = np.repeat(np.arange(len(table)), counts), pieces.flatten()
            at, key, source_at = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "source_key", "source_at"))
            start, windows = at >> LOW, at & (1 << LOW) - 1
            ids = flat.field("source_id")
            null, source = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
            shift = (source_at >> LOW) - start
            order = np.lexsort((start, shift, key, source, null, row))
            row, start, windows, null, source, key, shift = (x[order] for x in (row, start, windows, null, source, key, shift))
            first = np.flatnonzero(_joined(row, start, windows, (null, source, key, shift)))
            ends = np.maximum.reduceat(start + windows, first) if len(first) else start
            length = ends - start[first] + size - 1
            change = np.zeros(len(words) + 1, np.int64)
            begin = (words.ends - lengths)[row[first]] + start[first]
            np.add.at(change, begin, 1)
            np.add.at(change, begin + length, -1)
            stays = np.cumsum(change[:-1]) == 0
            left = np.concatenate([[0], np.cumsum(stays)])[np.concatenate([[0], words.ends])]
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), words.values.filter(pa.array(stays)).cast(pa.binary())), b" ")
            by_place = np.lexsort((length, start[first], row[first]))
            of, from_ = row[first][by_place], first[by_place]
            factors = pa.StructArray.from_arrays([
                pa.array(start[from_]), pa.array(length[by_place]), pa.array(source[from_], mask=null[from_]), pa.array((start + shift)[from_]),
            ], names=["start", "length", "source_id", "source_start"])
            kept = np.diff(left)
            yield pa.RecordBatch.from_arrays([
                table.column("doc_id").combine_chunks(), texts.cast(pa.string()), pa.array(lengths.astype(np.int64)),
                pa.array((lengths - kept).astype(np.int64)), pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(table) + 1)).astype(np.int32)), factors),
            ], names=["doc_id", "text", "n_words", "n_removed", "factors"])

    return docs.mapInArrow(
        run, "doc_id long, text string, n_words long, n_removed long, "
        "factors array<struct<start: long, length: long, source_id: long, source_start: long>>")


def drop_repeated_passages(
    docs: DataFrame, size: int = 20, anchor: int = ANCHOR, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text`` (the words that stay, joined by one space), ``n_words``
    (before), ``n_removed``, and ``factors``, the long factors of the parse in order: ``start`` and ``length``
    in words of the document, ``source_id`` and ``source_start`` of the earlier place.

    Words are what stands between ASCII white space; bytes that are no UTF-8 count as U+FFFD. A window is
    ``size`` words of one document in a row. Each word goes that is covered by a window whose words also
    start at an earlier place: in a document with a smaller id, or earlier in the same one. Windows are
    judged on the input, so a passage stays at its first place only, and passages may overlap themselves.

    Null and empty texts have no words. A null id is below all others. Of different texts with one id, that
    with the smaller hash is earlier; rows equal in id and text are one document, so both stay as one does.
    Very long texts are worked on whole. An empty table gives no rows. Other columns play no part.

    Texts are read four times and shuffled once, to meet their pieces. Of their windows only hashes are: of
    blocks (about one in seven words) with an anchor that occurs twice, and of windows that occur twice in blocks
    which differ from another block of their anchor; bit tables of at most 32 MB leave out most others. Copies
    are counted and firsts found by aggregates that combine before the shuffle; joins with the firsts may be
    split. Blocks and windows are equal if the 64-bit hashes of their anchors and those of their words are.
    """
    small_batches(docs.sparkSession)
    text = valid_text(F.col(f"`{text_column}`"))
    here = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    met = here.join(_pieces(here, size, anchor), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")), "left")
    return _cut(met.select("doc_id", "text", "pieces"), size)
