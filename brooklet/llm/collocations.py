"""Phrases whose words keep together, counted in direct-address tiles.

The frequent words of each language are ranked, and their ranks are their numbers. A pair of numbers
has its place in a square table, which is cut into tiles. Frequent words have small numbers, so few
tiles hold most pairs: a task counts those in arrays, by ``bincount``. Pairs of all other tiles, and of
words beyond the ranked ones, are sorted coordinates with counts. Frequent pairs are then ranked in turn,
and phrases of three words are pairs of a ranked pair and a word; and so on.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brooklet.llm.bits import bit_table, marked
from brooklet.llm.common import shuffles_end, small_batches, written
from brooklet.llm.words import hashes_of, kinds_of_bytes, mixed, slabs, split_words, valid_text

KINDS = kinds_of_bytes(b" \t", b".,;:!?\n\x0b\x0c\r")
#: Words, or phrases of one length, that are ranked; all tasks hold them.
RANKED = 1 << 17
#: Numbers along a tile's side; tiles that a task holds; a slab's pairs that make a tile worth an array.
SIDE, TILES, FULL = 256, 64, 1 << 12
#: Coordinates that a task holds, and that it gives away at once.
COORDINATES, GIVEN = 1 << 19, 1 << 16
#: Steps of a power of two in which frequencies are told apart when the cut of the ranked is found.
STEPS = 16
#: Parts of a language's phrases that are ranked first.
PARTS = 16

RARE, UNRANKED = -2, -1


def word_hashes(words, lang: str, seed: int) -> np.ndarray:
    """Hashes of distinct words of a language."""
    import zlib

    return mixed(hashes_of(words, seed) + np.uint64(zlib.crc32(lang.encode(), seed) << 20 | seed)).view(np.int64)


def _by_language(table):
    """The texts of each language of a slab."""
    import pyarrow.compute as pc

    langs = table.column("lang").combine_chunks().dictionary_encode()
    for i, lang in enumerate(langs.dictionary.to_pylist()):
        yield lang, table.column("text").combine_chunks().filter(pc.equal(langs.indices, i))


def _vocabulary(docs: DataFrame, seed: int) -> DataFrame:
    """``lang``, ``word``, ``h`` (its hash) and ``f`` (its occurrences)."""

    def run(batches):
        import pyarrow as pa

        for table in slabs(batches, "text"):
            for lang, texts in _by_language(table):
                distinct, codes = split_words(texts, KINDS, small=True).encoded()
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(distinct), pa.string()), distinct.cast(pa.large_string()).cast(pa.string()),
                    pa.array(word_hashes(distinct, lang, seed)), pa.array(np.bincount(codes, minlength=len(distinct)).astype(np.int64)),
                ], names=["lang", "word", "h", "n"])

    counts = docs.mapInArrow(run, "lang string, word string, h long, n long")
    return counts.groupBy("lang", "word").agg(F.first("h").alias("h"), F.sum("n").alias("f"))


def vocabulary(docs: DataFrame) -> tuple[DataFrame, int]:
    """The vocabulary and the seed of its hashes, with which no two words of it have one hash."""
    for seed in count():
        with shuffles_end(docs.sparkSession):
            found = written(_vocabulary(docs, seed), "vocabulary")
        if found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            return found, seed
    raise AssertionError


@dataclass
class Level:
    """Frequent words, or phrases of one length, as tasks know them."""

    keys: np.ndarray  # Hashes of the ranked, in order.
    numbers: np.ndarray  # Their numbers.
    words: np.ndarray  # By number: hashes of the words; 0 where a number is not given.
    rest: np.ndarray  # A bit table of the others' hashes.

    def find(self, keys: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Numbers of phrases by their hashes and words; ``UNRANKED`` or ``RARE`` where they have none."""
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            number = self.numbers[at]
            found = (self.keys[at] == keys) & (self.words[number] == words).all(axis=1)
            return np.where(found, number, np.where(marked(self.rest, keys), UNRANKED, RARE))
        return np.where(marked(self.rest, keys), UNRANKED, RARE)


def _cut(phrases: DataFrame) -> int:
    """The least step of frequency such that at most ``RANKED`` phrases are there or above."""
    step = F.floor(F.log2("f") * STEPS).cast("int")
    held, cut = 0, 1 << 20
    for r in phrases.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect():
        held += r["n"]
        if held > RANKED:
            break
        cut = r["step"]
    return cut


def level(phrases: DataFrame, size: int) -> Level:
    """Of phrases of ``size`` words (``lang``, ``key``, ``w0`` ..., ``f``), those that tasks know."""
    step = F.floor(F.log2("f") * STEPS).cast("int")
    cut = _cut(phrases)
    names = [f"w{i}" for i in range(size)]
    ranked = phrases.filter(step >= cut).select("lang", "key", *names, "f").toPandas()
    ranked = ranked.sort_values(["lang", "f", *names], ascending=[True, False, *[True] * size])
    place = ranked.groupby("lang").cumcount().to_numpy()
    sizes = ranked.groupby("lang").size().to_numpy()
    tiles = -(-sizes // SIDE)  # A language begins with a tile of its own.
    number = np.repeat((np.cumsum(tiles) - tiles) * SIDE, sizes) + place if len(ranked) else np.zeros(0, np.int64)
    words = np.zeros((int(number[-1]) + 1 if len(number) else 0, size), np.int64)
    words[number] = ranked[names].to_numpy(np.int64)
    keys = ranked["key"].to_numpy(np.int64)
    order = np.argsort(keys)
    return Level(keys[order], number[order].astype(np.int64), words, bit_table(phrases.filter(step < cut).select(F.col("key").alias("hash"))))


class Tiles:
    """Counts of pairs of a phrase and the word after it: arrays for full tiles, sorted coordinates for the rest."""

    def __init__(self, left: Level, right: Level) -> None:
        self.left, self.right = left, right
        self.arrays: dict[int, np.ndarray] = {}
        self.columns = -(-len(right.words) // SIDE) or 1
        self.sparse: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, left: np.ndarray, right: np.ndarray, words: np.ndarray):
        """Counts occurrences; gives coordinates (words, counts) when it holds too many."""
        tile = np.where((left >= 0) & (right >= 0), left // SIDE * self.columns + right // SIDE, -1)
        cell = left % SIDE * SIDE + right % SIDE
        found, counts = np.unique(tile, return_counts=True)
        for t, n in zip(found.tolist(), counts.tolist(), strict=True):
            if t >= 0 and t not in self.arrays and n >= FULL and len(self.arrays) < TILES:
                self.arrays[t] = np.zeros(SIDE * SIDE, np.int64)
            if t in self.arrays:
                self.arrays[t] += np.bincount(cell[tile == t], minlength=SIDE * SIDE)
        others = words[~np.isin(tile, list(self.arrays))] if self.arrays else words
        self.sparse.append((others, np.ones(len(others), np.int64)))
        self.held += len(others)
        if self.held > COORDINATES:
            self._sort()
            if self.held > COORDINATES // 2:
                yield self.sparse.pop()
                self.held = 0

    def _sort(self) -> None:
        words, counts = (np.concatenate(x) for x in zip(*self.sparse, strict=True))
        key = phrase_keys(words)
        order = np.argsort(key, kind="stable")
        words, counts = words[order], counts[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]).any(axis=1)  # Phrases with one key stay apart, as they must.
        first = np.flatnonzero(new)
        self.sparse = [(words[first], np.add.reduceat(counts, first) if len(first) else counts)]
        self.held = len(first)

    def rest(self):
        if self.sparse:
            self._sort()
            yield self.sparse.pop()
        for t, array in self.arrays.items():
            cells = np.flatnonzero(array)
            left, right = t // self.columns * SIDE + cells // SIDE, t % self.columns * SIDE + cells % SIDE
            yield np.hstack([self.left.words[left], self.right.words[right]]), array[cells]


def phrase_keys(words: np.ndarray) -> np.ndarray:
    """A hash of each row of words' hashes."""
    key = words[:, 0].view(np.uint64) if words.flags.c_contiguous and words.shape[1] == 1 else words[:, 0].astype(np.int64).view(np.uint64)
    for i in range(1, words.shape[1]):
        key = mixed(key * np.uint64(3) + np.ascontiguousarray(words[:, i]).view(np.uint64))
    return key.view(np.int64)


def _phrases(docs: DataFrame, size: int, seed: int, words: Level, left: Level, least: int) -> DataFrame:
    """Phrases of ``size`` words that occur at least ``least`` times: ``w0`` ..., ``f``, ``key``.

    ``left`` has the frequent phrases of one word less: all phrases that begin or end with a rarer one are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast((words, left))
    names = [f"w{i}" for i in range(size)]

    def coordinates(words: np.ndarray, counts: np.ndarray):
        import pyarrow as pa

        for i in range(0, len(counts), GIVEN):
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.ascontiguousarray(words[i:i + GIVEN, j])) for j in range(size)), pa.array(counts[i:i + GIVEN])], names=[*names, "n"])

    def run(batches):
        words, left = shared.value
        tiles = Tiles(left, words)
        for table in slabs(batches, "text"):
            for lang, texts in _by_language(table):
                split = split_words(texts, KINDS, small=True)
                if len(split) < size:
                    continue
                distinct, codes = split.encoded()
                hashes = word_hashes(distinct, lang, seed)
                number = words.find(hashes, hashes[:, None])[codes]
                word = hashes[codes]
                before = np.stack([word[i:len(word) - size + 2 + i] for i in range(size - 1)], axis=1)
                closed = split.opens.copy()  # Whether a piece opens after the first word of a phrase.
                inside = np.ones(len(word) - size + 1, bool)
                for i in range(1, size):
                    inside &= ~closed[i:len(closed) - size + 1 + i]
                for i in range(size):
                    inside &= number[i:len(number) - size + 1 + i] != RARE
                if size == 2:
                    unit = number
                else:
                    unit = np.full(len(before), RARE)
                    looked = np.zeros(len(before), bool)
                    looked[:-1] |= inside
                    looked[1:] |= inside
                    looked = np.flatnonzero(looked)
                    unit[looked] = left.find(phrase_keys(before[looked]), before[looked])
                    inside &= (unit[:-1] != RARE) & (unit[1:] != RARE)
                at = np.flatnonzero(inside)
                phrase = np.hstack([before[at], word[at + size - 1][:, None]])
                for found in tiles.add(unit[at], number[at + size - 1], phrase):
                    yield from coordinates(*found)
        for found in tiles.rest():
            yield from coordinates(*found)

    def keyed(batches):
        import pyarrow as pa

        for batch in batches:
            words = np.stack([batch.column(i).to_numpy() for i in range(size)], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(phrase_keys(words))], names=[*names, "f", "key"])

    columns = ", ".join(f"{x} long" for x in names)
    counts = docs.mapInArrow(run, f"{columns}, n long")
    found = counts.groupBy(*names).agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    return found.mapInArrow(keyed, f"{columns}, f long, key long")


def _scored(levels: list[DataFrame], size: int, share: int) -> DataFrame:
    """The phrases of ``size`` words of ``levels`` (by length) that no longer one displaces: ``w0`` ..., ``a``, ``l``, ``r``, ``score``."""
    here = levels[size - 1].select(*[f"w{i}" for i in range(size)], F.col("f").alias("a"))
    if size < len(levels):
        longer = levels[size]
        ends = [longer.select(*[F.col(f"w{i + b}").alias(f"x{i}") for i in range(size)], "f") for b in (0, 1)]
        longest = ends[0].unionAll(ends[1]).groupBy(*[f"x{i}" for i in range(size)]).agg(F.max("f").alias("longer"))
        here = here.join(longest, _same(range(size), "w", "x"), "left").filter(
            F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True))).select(*here.columns)
    for k in range(1, size):
        first = levels[k - 1].select(*[F.col(f"w{i}").alias(f"x{i}") for i in range(k)], F.col("f").alias(f"l{k}"))
        rest = levels[size - k - 1].select(*[F.col(f"w{i}").alias(f"y{i + k}") for i in range(size - k)], F.col("f").alias(f"r{k}"))
        here = here.join(first, _same(range(k), "w", "x")).drop(*[f"x{i}" for i in range(k)])
        here = here.join(rest, _same(range(k, size), "w", "y")).drop(*[f"y{i}" for i in range(k, size)])
    wide = lambda x: F.col(x).cast("decimal(38,0)")
    for k in range(1, size):
        here = here.withColumn(f"over{k}", F.lit(1_000_000).cast("decimal(38,0)") * wide("a") * wide("a")).withColumn(
            f"under{k}", wide(f"l{k}") * wide(f"r{k}")).withColumn(f"score{k}", F.expr(f"over{k} div under{k}"))
    least = F.least(*[F.struct(F.col(f"score{k}").alias("score"), F.lit(k), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, size)]) \
        if size > 2 else F.struct(F.col("score1").alias("score"), F.col("l1").alias("l"), F.col("r1").alias("r"))
    return here.withColumn("least", least).select(*[f"w{i}" for i in range(size)], "a", "least.l", "least.r", "least.score")


def _same(places, left: str, right: str) -> Column:
    found = F.lit(True)
    for i in places:
        found &= F.col(f"{left}{i}") == F.col(f"{right}{i}")
    return found


def mine_phrases(
    docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000,
    text_column: str = "text", lang_column: str = "lang",
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank`` (from 1), ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts are cut into pieces at ``.,;:!?``, line feeds, vertical tabs, form feeds and carriage returns, and
    pieces into words at spaces and tabs; A to Z are lower-cased, bytes that are no UTF-8 count as U+FFFD.
    Candidates are phrases of 2 to ``longest`` words that occur at least ``least`` times (``a``) within pieces of
    a language, overlaps included. Cut after its first k words, a candidate has l = f(first part), r = f(rest)
    and the score floor(1000000 a a / (l r)); the cut with the least score counts, the first of equal ones.
    Candidates whose words stand in a row inside a longer candidate, dropped or not, of at least ``share``
    percent of their occurrences, are dropped. ``n`` counts all words of the language.

    Phrases rank by score, then ``a``, then their UTF-8 bytes. A null language is ``und``; null and empty texts
    have no words; repeated rows count as often as they are there; very long texts are worked on whole. An
    empty table gives no rows. Numbers are exact as long as a phrase occurs less than 10^16 times. Other
    columns play no part.

    Texts are read ``longest`` times and never shuffled. Tasks hold ``RANKED`` words and phrases, ``TILES`` tiles
    and ``COORDINATES`` coordinates at most, and a bit table of 32 MB that leaves out most phrases with a rare
    part. Their counts are summed by phrase.
    """
    small_batches(docs.sparkSession)
    here = docs.select(
        F.coalesce(F.make_valid_utf8(F.col(f"`{lang_column}`").cast("string")), F.lit("und")).alias("lang"), valid_text(F.col(f"`{text_column}`")).alias("text"))
    every, seed = vocabulary(here)
    totals = every.groupBy(F.col("lang").alias("of")).agg(F.sum("f").alias("n"))
    frequent = written(every.filter(F.col("f") >= least).select(F.col("h").alias("w0"), F.col("h").alias("key"), "lang", "word", "f"), "frequent-words")
    lang = frequent.select(F.col("w0").alias("of_word"), "lang")
    words = left = level(frequent, 1)
    levels = [frequent]
    for size in range(2, longest + 1):
        found = _phrases(here, size, seed, words, left, least).join(lang, F.col("w0") == F.col("of_word")).drop("of_word")
        with shuffles_end(docs.sparkSession):
            levels.append(written(found, f"phrases-{size}"))
        if size < longest:
            left = level(levels[-1], size)
    candidates = None
    for size in range(2, longest + 1):
        found = _scored(levels, size, share)
        for i in range(size):
            name = frequent.select(F.col("w0").alias("of_word"), F.col("word").alias(f"word{i}"), *(["lang"] if i == 0 else []))
            found = found.join(name, F.col(f"w{i}") == F.col("of_word")).drop("of_word")
        found = found.select("lang", F.concat_ws(" ", *[f"word{i}" for i in range(size)]).alias("phrase"), "a", "l", "r", "score")
        candidates = found if candidates is None else candidates.unionAll(found)
    ranked = candidates.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    for by in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, F.col("lang") == F.col("of")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
