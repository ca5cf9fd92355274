"""Near-duplicates by MinHash with tensored banding, candidates confirmed on full shingle sets.

Two small collections of bands are hashed, and every band of the one is paired with every band of
the other to make the key of a table: ``n`` x ``n`` tables cost ``2 n`` bands. Documents that share
a key are candidates.

Candidates are not paired off within a bucket. The member that is in most and largest buckets is
the bucket's centre; members are compared with their centres first. What the links found there
leave in different components is compared in blocks around each centre, inside a task that emits
links only, and leaves out what the triangle inequality of the Jaccard distance rules out.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.llm.common import small_batches, text_or_empty, written
from brooklet.llm.components import connected_components
from brooklet.llm.words import valid_text

#: Members of a cluster that one task compares with as many others.
CHUNK = 256
#: Bits of the filter that says which texts to read again; more of them save work, no result
#: depends on them.
FILTER_BITS = 1 << 26

MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser in the manner of splitmix64: every bit of the result depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of an Arrow array of texts, A to Z lower-cased, and where each
    text's end. Words are what stands between ASCII white space."""
    import pyarrow as pa
    import pyarrow.compute as pc
    from pandas.util import hash_array

    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
    words = lists.flatten().dictionary_encode()
    hashes = hash_array(np.array(words.dictionary.to_pylist(), dtype=object), categorize=False).astype(np.uint64)
    empty = pc.equal(pc.binary_length(words.dictionary), 0).to_numpy(zero_copy_only=False)
    codes = words.indices.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    if not empty.any():
        return hashes[codes], offsets[1:]
    real = ~empty[codes]  # White space at the ends of a text leaves empty words.
    return hashes[codes[real]], np.concatenate([[0], np.cumsum(real)])[offsets[1:]]


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's runs of ``size`` words; of all words, if fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        out = mixed(out + words[i:len(words) - size + 1 + i])
    return np.unique(out)


def bands_for(threshold: float, rows: int, miss: float) -> int:
    """Bands in each collection so that a pair at the threshold shares no table with a
    probability of at most ``miss``."""
    return math.ceil(math.log(miss / 2) / math.log(1 - threshold ** rows))


def _signatures(docs: DataFrame, size: int, rows: int, bands: int) -> DataFrame:
    """``row``, ``doc_id``, ``text_key``, ``h``, ``g`` (a digest of the words), ``n`` (shingles) and ``bands``, both
    collections one after the other, for each document."""
    functions = 2 * bands * rows

    def run(batches):
        import pyarrow as pa

        odd = np.random.default_rng(7).integers(0, 1 << 62, functions).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            hashes, ends = word_hashes(batch.column(2))
            sets, digests, begin = [], [], 0
            for end in ends.tolist():
                words = hashes[begin:end]
                digests.append(hashlib.blake2b(words.tobytes(), digest_size=16).digest())
                sets.append(shingles(words, size))
                begin = end
            counts = np.array([len(s) for s in sets], np.int64)
            found = np.zeros((len(sets), 2 * bands), np.uint64)
            some = np.flatnonzero(counts)
            if len(some):
                every = np.concatenate([sets[i] for i in some])
                starts = np.cumsum(counts[some]) - counts[some]
                for band in range(2 * bands):
                    value = np.full(len(some), band, np.uint64)
                    for k in range(band * rows, (band + 1) * rows):
                        value = mixed(value + np.minimum.reduceat(every * odd[k], starts))
                    found[some, band] = value
            flat = pa.array(found.view(np.int64).ravel())
            offsets = pa.array(np.arange(0, found.size + 1, 2 * bands, dtype=np.int32))
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(3), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(counts),
                pa.ListArray.from_arrays(offsets, flat),
            ], names=["row", "doc_id", "text_key", "h", "g", "n", "bands"])

    return docs.mapInArrow(run, "row long, doc_id long, text_key long, h long, g long, n long, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``h``, ``g`` and ``elements``: the full shingle sets of the documents with ids in ``wanted``,
    and of some others: a bit table of fixed size says which texts to look at."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)) + 1
    bits = wanted.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    table = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in bits.toLocalIterator():
        part = np.frombuffer(r["bits"], np.uint8)
        begin = (r["part"] - 1) * len(part)
        table[begin:begin + len(part)] |= part
    shared = docs.sparkSession.sparkContext.broadcast(table)
    place = F.struct(F.bitmap_bucket_number(slot).alias("part"), F.bitmap_bit_position(slot).alias("bit"))

    def run(batches):
        import pyarrow as pa

        table = shared.value
        for batch in batches:
            at = (batch.column(1).to_numpy(zero_copy_only=False) - 1) * 32768 + batch.column(2).to_numpy(zero_copy_only=False)
            chosen = np.flatnonzero(table[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            hashes, ends = word_hashes(batch.column(0).take(pa.array(chosen)))
            sets, digests, begin = [], [], 0
            for end in ends.tolist():
                words = hashes[begin:end]
                digests.append(hashlib.blake2b(words.tobytes(), digest_size=16).digest())
                sets.append(shingles(words, size))
                begin = end
            if sets:
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([
                    pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)),
                        pa.array(np.concatenate(sets).view(np.int64))),
                ], names=["h", "g", "elements"])

    return docs.select("text", place.alias("place")).select("text", "place.*").mapInArrow(run, "h long, g long, elements array<long>")


def _linker(part: int, whole: int):
    """Compares the members of one block group: those of side 0 with one another and with those of
    side 1. Emits links that join components, no others."""
    gap = 1 - part / whole + 1e-9

    def run(table):
        import pyarrow as pa

        table = table.combine_chunks()
        ids, side, comp, n = (table.column(c).to_numpy() for c in ("cid", "side", "comp", "n"))
        away = table.column("away").to_numpy(zero_copy_only=False)
        lists = table.column("elements").combine_chunks()
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        values, offsets = values[offsets[0]:offsets[-1]], offsets - offsets[0]
        distinct, codes = np.unique(values, return_inverse=True)
        here = np.zeros(len(distinct), np.int64)
        comp, links = comp.copy(), []
        for x in np.flatnonzero(side == 0):
            far = np.abs(away - away[x]) > gap  # Unknown distances compare as not far.
            fits = (comp != comp[x]) & ~far & (part * np.maximum(n, n[x]) <= whole * np.minimum(n, n[x]))
            fits &= (side == 1) | (np.arange(len(ids)) > x)
            if not fits.any():
                continue
            mine = codes[offsets[x]:offsets[x + 1]]
            here[mine] = 1
            common = np.add.reduceat(here[codes], offsets[:-1])
            here[mine] = 0
            for y in np.flatnonzero(fits & (whole * common >= part * (n + n[x] - common))):
                if comp[y] != comp[x]:
                    links.append((ids[x], ids[y]))
                    comp[comp == comp[y]] = comp[x]
        u, v = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table({"u": pa.array(u), "v": pa.array(v)})

    return run


def _links(classes: DataFrame, sets: DataFrame, keys: DataFrame, part: int, whole: int) -> DataFrame:
    """Links ``u``, ``v`` between classes that lead to the components of all links among candidates.

    ``keys`` has ``key`` and ``cid`` of the classes that share a key with another.
    """
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    popular = keys.join(sizes, "key").groupBy("cid").agg(F.sum("size").alias("popular"))
    ranked = keys.join(popular, "cid")
    centres = ranked.groupBy("key").agg(F.max(F.struct("popular", (-F.col("cid")).alias("minus"))).alias("top")).select(
        "key", (-F.col("top.minus")).alias("centre"))
    numbers = classes.select("cid", "n")
    stars = written(
        keys.join(centres, "key").filter("cid <> centre").select("centre", "cid").distinct()
        .join(numbers, "cid").join(numbers.select(F.col("cid").alias("centre"), F.col("n").alias("m")), "centre"), "stars")
    fits = F.lit(part) * F.greatest("n", "m") <= F.lit(whole) * F.least("n", "m")
    compared = (
        stars.filter(fits).join(sets.select("cid", F.col("elements").alias("a")), "cid")
        .join(sets.select(F.col("cid").alias("centre"), F.col("elements").alias("b")), "centre")
    ).select("centre", "cid", "n", "m", F.size(F.array_intersect("a", "b")).cast("long").alias("common")).withColumn(
        "union", F.col("n") + F.col("m") - F.col("common"))
    compared = written(compared.select(
        "centre", "cid", (1 - F.col("common") / F.col("union")).alias("away"),
        (whole * F.col("common") >= part * F.col("union")).alias("linked")), "compared")
    first = compared.filter("linked").select(F.col("centre").alias("u"), F.col("cid").alias("v"))
    found = connected_components(first)

    def comp(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.join(found.select(F.col("node").alias(column), F.col("component").alias("_c")), column, "left").select(
            *df.columns, F.coalesce("_c", column).alias(name))

    members = stars.select("centre", "cid", "n").join(compared.select("centre", "cid", "away"), ["centre", "cid"], "left")
    members = comp(comp(members, "cid", "comp"), "centre", "main")
    # Clusters where somebody is not with the centre have pairs left to compare.
    outside = F.col("comp") != F.col("main")
    clusters = members.groupBy(F.col("centre").alias("of")).agg(
        F.count(F.when(outside, 1)).alias("out"), F.count(F.when(~outside, 1)).alias("in")).filter("out > 0 AND out + in > 1")
    members = members.join(clusters, F.col("centre") == F.col("of")).drop("of")
    together = F.col("out") + F.col("in") <= CHUNK
    outs = F.when(together, F.lit(1)).otherwise(F.ceil(F.col("out") / CHUNK)).cast("int")
    ins = F.when(together, F.lit(0)).otherwise(F.ceil(F.col("in") / CHUNK)).cast("int")
    chunk = F.xxhash64(F.lit(3), "cid")
    members = members.select(
        "centre", "cid", "n", "comp", F.coalesce("away", F.lit(float("nan"))).alias("away"), outs.alias("outs"), ins.alias("ins"),
        (outside | together).alias("out")).withColumn("chunk", F.pmod(chunk, F.when(F.col("out"), F.col("outs")).otherwise(F.col("ins"))).cast("int"))
    # A block compares a chunk of outsiders with a later chunk of them, or with a chunk of the rest.
    others = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("outs") - 1), lambda j: F.struct(
            F.least(j, F.col("chunk")).alias("i"), F.greatest(j, F.col("chunk")).alias("j"), F.lit(False).alias("rest"),
            F.when(F.col("chunk") <= j, 0).otherwise(1).alias("side"))),
        F.transform(F.filter(F.sequence(F.lit(0), F.col("ins")), lambda j: j < F.col("ins")), lambda j: F.struct(
            F.col("chunk").alias("i"), j.alias("j"), F.lit(True).alias("rest"), F.lit(0).alias("side"))))
    rest = F.transform(F.sequence(F.lit(0), F.col("outs") - 1), lambda i: F.struct(
        i.alias("i"), F.col("chunk").alias("j"), F.lit(True).alias("rest"), F.lit(1).alias("side")))
    blocks = members.select("centre", "cid", "n", "comp", "away", F.explode(F.when(F.col("out"), others).otherwise(rest)).alias("block"))
    blocks = blocks.select("centre", "block.*", "cid", "n", "comp", "away").join(sets, "cid")
    more = blocks.groupBy("centre", "i", "j", "rest").applyInArrow(_linker(part, whole), "u long, v long")
    return written(first.unionAll(more), "links")


def text_key(text: Column) -> Column:
    """Tells rows with one id but different texts apart."""
    return F.xxhash64(F.lit(13), text_or_empty(text))


def near_duplicates(
    docs: DataFrame, words: int = 5, part: int = 80, whole: int = 100, rows: int = 2, miss: float = 2e-4,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_key`` (``text_key`` of its text), ``n_shingles``,
    ``component_id`` and ``kept``.

    Words are what stands between ASCII white space, A to Z lower-cased; a text's set has its
    distinct runs of ``words`` words, or all its words as one run if they are fewer. Texts are linked
    when ``whole * intersection >= part * union`` of their sets; bytes that are no UTF-8 count as U+FFFD. ``component_id`` is the smallest
    id that links lead to, and the document of that id is ``kept``. Null and empty texts have no
    shingles and no links. Rows that repeat an id are linked each by its own text; of several with
    the smallest id, the first is kept. A row with a null id takes part, but is kept only if its
    component has no other id, which is then null. Other columns play no part.

    Sets are sets of 64-bit hashes. A pair at the threshold meets in no table with a probability
    of at most ``miss``, less above the threshold; ``rows`` minhashes make a band.

    Texts with the same words are one class from the first shuffle on, and classes alone are
    compared. Texts are read twice and never shuffled; sets of those classes only that share a
    key. All of a bucket's members meet its centre; the quadratic rest stays inside tasks, each with
    at most two chunks of ``CHUNK`` sets.
    """
    small_batches(docs.sparkSession)
    bands = bands_for(part / whole, rows, miss)
    here = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        valid_text(F.col(f"`{text_column}`")).alias("text"), text_key(F.col(f"`{text_column}`")).alias("text_key"))
    signed = written(_signatures(here, words, rows, bands), "signatures")
    classes = written(signed.filter("n > 0").groupBy("h", "g").agg(
        F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"),
    ).withColumn("cid", F.monotonically_increasing_id()), "classes")

    left = F.posexplode(F.slice("bands", 1, bands)).alias("i", "a")
    paired = classes.select("cid", "bands", left).select(
        "cid", "i", "a", F.posexplode(F.slice("bands", bands + 1, bands)).alias("j", "b"))
    entries = paired.select(F.xxhash64("i", "j", "a", "b").alias("key"), "cid")
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("key")
    keys = written(entries.join(shared, "key"), "keys")
    named = classes.join(keys.select("cid").distinct(), "cid").select("cid", "h", "g", "first")
    texts = here.select("doc_id", "text")
    found = _sets(texts, named.select(F.col("first").alias("doc_id")), words)
    sets = written(found.join(named.select("cid", "h", "g"), ["h", "g"]).dropDuplicates(["cid"]).select("cid", "elements"), "sets")
    components = connected_components(_links(classes, sets, keys, part, whole))

    whole_ = classes.select("cid", "h", "g", "first").join(components.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    smallest = whole_.groupBy("component").agg(F.min("first").alias("component_id"))
    placed = written(whole_.join(smallest, "component").select(F.col("h").alias("ch"), F.col("g").alias("cg"), "component", "component_id"), "components")
    # Written down, so that the last join may send the heads to all tasks, or split large components.
    joined = written(signed.select("row", "doc_id", "text_key", "h", "g", "n").join(placed, (F.col("h") == F.col("ch")) & (F.col("g") == F.col("cg")), "left").select(
        "row", "doc_id", "text_key", F.col("n").alias("n_shingles"), "component", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")), "members")
    at_head = F.col("doc_id").eqNullSafe(F.col("component_id"))
    heads = written(
        joined.filter(at_head & (F.col("n_shingles") > 0)).groupBy(F.col("component").alias("of")).agg(F.min("row").alias("head")), "heads")
    return joined.join(heads, F.col("component") == F.col("of"), "left").select(
        "doc_id", "text_key", "n_shingles", "component_id", F.when(F.col("n_shingles") > 0, F.col("row") == F.col("head")).otherwise(F.lit(True)).alias("kept"))
