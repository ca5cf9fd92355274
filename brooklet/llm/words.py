"""Words of many texts at once, as Arrow arrays, by classes of bytes.

A text is cut into words by what its bytes are: part of a word, between two words, or between two
pieces. All bytes of characters beyond ASCII are parts of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from brooklet.llm.common import text_or_empty

IN_WORD, BETWEEN_WORDS, BETWEEN_PIECES = 0, 1, 2
#: Bytes of texts that are worked on at once.
SLAB = 4 << 20

MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser in the manner of splitmix64: every bit of the result depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def kinds_of_bytes(between_words: bytes, between_pieces: bytes = b"") -> np.ndarray:
    """What each of the 256 bytes is to a word."""
    kinds = np.zeros(256, np.uint8)
    kinds[list(between_words)] = BETWEEN_WORDS
    kinds[list(between_pieces)] = BETWEEN_PIECES
    return kinds


SMALL = np.arange(256, dtype=np.uint8)
SMALL[ord("A"):ord("Z") + 1] += 32


@dataclass
class Words:
    """Words of texts, one after the other."""

    values: object  # An Arrow array of bytes.
    ends: np.ndarray  # For each text, the number of words up to its end.
    opens: np.ndarray  # Whether a word is the first one of its piece.

    def __len__(self) -> int:
        return len(self.values)

    def encoded(self) -> tuple[object, np.ndarray]:
        """The distinct words, and each word's place among them."""
        found = self.values.dictionary_encode()
        return found.dictionary, found.indices.to_numpy(zero_copy_only=False)

    def lengths(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)


def split_words(texts, kinds: np.ndarray, small: bool) -> Words:
    """The words of an Arrow array of texts without nulls; A to Z are lower-cased if ``small``."""
    import pyarrow as pa

    texts = texts.cast(pa.large_binary())
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[places[0]:places[-1]] if data is not None else np.zeros(0, np.uint8)
    places = places - places[0]
    kind = kinds[data]
    inside = kind == IN_WORD
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    edges = places[1:-1][(places[1:-1] > 0) & (places[1:-1] < len(data))]
    begins[edges] = inside[edges]
    finishes[edges - 1] = inside[edges - 1]
    begins, finishes = np.flatnonzero(begins), np.flatnonzero(finishes)
    offsets = np.zeros(len(begins) + 1, np.int64)
    np.cumsum(finishes - begins + 1, out=offsets[1:])
    letters = data[inside]
    values = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(SMALL[letters] if small else letters)])
    ends = np.searchsorted(begins, places[1:])
    opens = np.diff(np.searchsorted(np.flatnonzero(kind == BETWEEN_PIECES), begins), prepend=-1) != 0
    firsts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    opens[firsts[firsts < len(begins)]] = True
    return Words(values, ends, opens)


def hashes_of(words, seed: int = 0) -> np.ndarray:
    """64-bit hashes of an Arrow array of distinct words."""
    from pandas.util import hash_array

    plain = np.array(words.to_pylist(), dtype=object)
    return hash_array(plain, hash_key=f"{seed:016d}", categorize=False).astype(np.uint64) if len(plain) else np.zeros(0, np.uint64)


def slabs(batches, column: str) -> Iterator:
    """Rows of a task's batches as tables of at most ``SLAB`` bytes of texts in ``column``, or one row."""
    import pyarrow as pa
    import pyarrow.compute as pc

    waiting, held = [], 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        sizes = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < len(table):
            done = int(sizes[begin - 1]) if begin else 0
            end = int(np.searchsorted(sizes, done + SLAB - held, side="right"))
            if end <= begin and not waiting:
                end = begin + 1
            if end > begin:
                waiting.append(table.slice(begin, end - begin))
                held += int(sizes[end - 1]) - done
                begin = end
            if begin < len(table):
                yield pa.concat_tables(waiting).combine_chunks()
                waiting, held = [], 0
    if waiting:
        yield pa.concat_tables(waiting).combine_chunks()


def valid_text(column: str | Column) -> Column:
    """The text, null as empty; bytes that are no UTF-8 as U+FFFD."""
    return F.make_valid_utf8(text_or_empty(column))
