"""Packing of documents into training sequences: concatenate and cut.

Pass one tokenises every document once and keeps the ids with each document's place among its
partition's ids. Partition totals, summed up in order, give every partition its place in the one
long stream of ids. Pass two cuts that stream at multiples of the sequence length: the records
it gives are pieces of documents, a document that crosses a boundary giving one on either side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brooklet.llm.common import small_batches, written
from brooklet.llm.words import valid_text

#: Parts that a task remembers, twice at most, and those that it looks up in one go; only speed
#: depends on them.
REMEMBERED_PARTS, LOOK_UP = 300_000, 4_000
BATCH_TEXTS = 1024

TOKENS = "doc_id long, part long, place long, tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, at long"


MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class WordTokenizer:
    """Ids of texts by way of the parts of their words.

    The tokenizers that fit drop white space, and cut what is left into letters and marks before
    they look anything up. So a text's ids are those of its words one after the other, those of
    a word of letters and ASCII marks after them are the letters' and the marks', and a part that
    comes again needs no second look. Words are cut at ASCII white space only; words of any other
    make are parts as a whole. ``width`` bytes hold an id.
    """

    def __init__(self, definition: str) -> None:
        import numpy as np
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True  # Their strings in a text are ordinary text.
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = bool(suffix) and token.endswith(suffix)
        self.recent: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def look_up(self, parts: list[str], whole: bool) -> None:
        """Ids of parts, found in one go: one text of all of them, cut after their last ids. Parts that
        are not surely ``whole`` may have none or several that end a word, and go by their places."""
        import numpy as np

        found = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
        ids = np.array(found.ids, dtype=self.kind)
        cuts = np.flatnonzero(self.ends[ids]) + 1 if whole else ()
        if len(cuts) != len(parts):  # Some are cut further, or not at all.
            places = np.array([begin for begin, _ in found.offsets], dtype=np.int64)
            cuts = np.searchsorted(places, np.cumsum(np.fromiter((len(t) + 1 for t in parts), np.int64, len(parts))))
        raw, begin = ids.tobytes(), 0
        for part, cut in zip(parts, (cuts * self.width).tolist(), strict=True):
            self.recent[part] = raw[begin:cut]
            begin = cut

    def known(self, parts: list[str]) -> list[bytes]:
        """The parts' ids; the new ones are looked up."""
        if len(self.recent) > REMEMBERED_PARTS:
            self.recent, self.older = {"": b""}, self.recent
        plain, odd, older, recent = [], [], self.older, self.recent
        for part in parts:
            if part not in recent:
                if (ids := older.get(part)) is not None:
                    recent[part] = ids
                else:
                    (plain if part.isalpha() or not part.strip(MARKS) else odd).append(part)
        for group, whole in ((plain, True), (odd, False)):
            for begin in range(0, len(group), LOOK_UP):
                self.look_up(group[begin:begin + LOOK_UP], whole)
        return [recent[part] for part in parts]

    def ids(self, texts):
        """Ids of an Arrow array of texts: all of them, and where each text's end."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        words = lists.flatten().dictionary_encode()
        distinct, codes = words.dictionary, words.indices.to_numpy(zero_copy_only=False)
        letters = pc.ascii_rtrim(distinct, MARKS)
        plain = pc.or_(pc.utf8_is_alpha(letters), pc.equal(pc.binary_length(letters), 0))
        # Every word as two strings of the same bytes: letters and marks, or the whole and nothing.
        ends = np.frombuffer(distinct.buffers()[1], np.int64, len(distinct) + 1, 8 * distinct.offset)
        cut = ends[:-1] + pc.binary_length(pc.if_else(plain, letters, distinct)).to_numpy(zero_copy_only=False)
        bounds = np.append(np.stack([ends[:-1], cut], 1).ravel(), ends[-1:])
        halves = pa.LargeStringArray.from_buffers(2 * len(distinct), pa.py_buffer(bounds), distinct.buffers()[2])
        lower = pc.and_(pc.string_is_ascii(halves), pa.array(np.repeat(plain.to_numpy(zero_copy_only=False), 2)))
        pairs = pc.if_else(lower, pc.ascii_lower(halves), halves).dictionary_encode()
        parts = self.known(pairs.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(parts), self.kind)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // self.width
        starts = np.cumsum(lengths) - lengths
        both = pairs.indices.to_numpy(zero_copy_only=False).reshape(-1, 2)[codes].ravel()
        sizes = lengths[both]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.repeat(starts[both] - ends + sizes, sizes) + np.arange(total)]
        offsets = lists.offsets.to_numpy()
        return ids, np.concatenate([[0], ends])[2 * (offsets[1:] - offsets[0])]


def tokenize(docs: DataFrame, definition: str, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document's ids with ``end_id`` after them, written to a table: ``doc_id``, ``part``
    (the task that read it), ``place`` (ids of that task before it), ``tokens`` and ``ids``.

    ``definition`` is the tokenizer's JSON text. A null text counts as empty. A task holds one
    batch of texts at a time.
    """
    spark = docs.sparkSession
    small_batches(spark, BATCH_TEXTS)
    shared = spark.sparkContext.broadcast(definition)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, place = TaskContext.get().partitionId(), 0
        tokenizer = WordTokenizer(shared.value)
        end = end_id.to_bytes(tokenizer.width, "little")
        for batch in batches:
            found, ends = tokenizer.ids(batch.column(1))
            ids, begin = [], 0
            for cut in ends.tolist():
                ids.append(found[begin:cut].tobytes() + end)
                begin = cut
            counts = [len(i) // tokenizer.width for i in ids]
            places = []
            for n in counts:
                places.append(place)
                place += n
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), pa.array([part] * len(ids), pa.int64()), pa.array(places, pa.int64()),
                pa.array(counts, pa.int64()), pa.array(ids, pa.binary()),
            ], names=["doc_id", "part", "place", "tokens", "ids"])

    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), valid_text(F.col(f"`{text_column}`")).alias("text"))
    return written(rows.mapInArrow(run, TOKENS), "tokens")


def id_width(definition: str) -> int:
    return WordTokenizer(definition).width


def cut_stream(tokens: DataFrame, length: int, width: int) -> DataFrame:
    """Cut the stream of all ids at multiples of ``length``.

    ``tokens`` is what ``tokenize`` wrote. One row per piece: ``doc_id``, ``start`` (its
    document's ids before it), ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset`` in that sequence. Every sequence is full except the last.
    What is broadcast has one row per task of the first pass.
    """
    if length < 1:
        raise ValueError("sequences need room for one id")
    small_batches(tokens.sparkSession, BATCH_TEXTS)
    totals = tokens.groupBy("part").agg(F.sum("tokens").alias("total"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    placed = tokens.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("place")).alias("at"), "tokens", "ids")

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = [[] for _ in range(6)]
            for doc, at, total, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                wide = np.frombuffer(ids, f"<u{width}").astype("<u4")
                begin = 0
                while begin < total:
                    size = min(total - begin, length - (at + begin) % length)
                    for column, value in zip(out, (doc, begin, size, wide[begin:begin + size].tobytes(), total, at + begin), strict=True):
                        column.append(value)
                    begin += size
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "at"])

    return placed.mapInArrow(cut, PIECES).select(
        "doc_id", "start", "length", "ids", "doc_tokens", F.floor(F.col("at") / length).cast("long").alias("sequence_id"),
        (F.col("at") % length).alias("offset"),
    )


def pack(docs: DataFrame, definition: str, length: int = 2048, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All documents as pieces of sequences of ``length`` ids; see ``cut_stream``.

    A document is its ids and ``end_id``; each id lies in one piece. Documents keep the order of
    the input's partitions. Null and empty texts are the end id alone, bytes that are no
    UTF-8 count as U+FFFD; an empty table has no
    pieces; repeated rows are packed as often as they come; other columns play no part.
    """
    return cut_stream(tokenize(docs, definition, end_id, id_column, text_column), length, id_width(definition))


def sequences(pieces: DataFrame, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``ids`` (binary, padded to ``length``) and
    ``used``. A sequence has at most ``length`` pieces, so groups are bounded."""
    room = F.unhex(F.lit(pad_id.to_bytes(4, "little").hex() * length))
    joined = pieces.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("used"))
    ids = F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return joined.select("sequence_id", F.concat(ids, F.substring(room, 1, ((length - F.col("used")) * 4).cast("int"))).alias("ids"), "used")

