"""Quality scores of documents: random-indexing word vectors, pooled, and a small network.

Every word has a sparse random index vector; a word's own vector is the sum of the index vectors
of its neighbours over the whole corpus (Sahlgren, 2005). A document is the mean and the spread of
its words' vectors. A two-layer network, fitted on labelled documents, scores it, and a temperature
fitted on others of them makes the scores probabilities.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.llm.common import small_batches
from brooklet.llm.words import valid_text

#: Rows of the table of word vectors, and their length: words share rows by hash, so the table that
#: every task holds has one size, whatever the vocabulary.
ROWS, DIMS = 1 << 15, 32
#: Neighbours on each side, and non-zero entries of an index vector.
WINDOW, NONZERO = 2, 2
#: Rows of the table that are summed up together.
BLOCK = 256

SAMPLE = 20_000
HIDDEN, EPOCHS, RATE, DECAY, BATCH = 32, 60, 0.004, 1e-4, 128
CALIBRATION_SHARE = 0.2

REMEMBERED_WORDS = 200_000
SLICE = 1 << 16
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def word_rows(word: bytes) -> int:
    """Two rows of the table in one number: the row of the word's core, and that of its shape
    (letter case, and marks around it)."""
    core = word.strip(MARKS)
    plain = core.decode()
    case = "A" if len(plain) > 1 and plain.isupper() else "T" if plain[:1].isupper() else "0" if plain.isdigit() else "a" if plain else ""
    at = word.find(core) if core else 0
    shape = b"\x00".join((case.encode(), word[:at][:3], word[at + len(core):][:3]))
    return (zlib.crc32(plain.lower().encode()) % (ROWS - 1) + 1) << 16 | zlib.crc32(shape, 1) % (ROWS - 1) + 1


class Reader:
    """Rows of texts' words, in order: core, shape, core, shape ..."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def rows(self, text: bytes) -> np.ndarray:
        words = text.split()
        known = self.known
        if len(known) > REMEMBERED_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = word_rows(word)
        both = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        out = np.empty(2 * len(words), np.int64)
        out[0::2], out[1::2] = both >> 16, both & 0xFFFF
        return out


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of every row's index vector; row 0 has none."""
    draw = np.random.default_rng(11)
    places = draw.integers(0, DIMS, (NONZERO, ROWS))
    signs = draw.choice([-1.0, 1.0], (NONZERO, ROWS))
    signs[:, 0] = 0
    return places, signs


def add_neighbours(table: np.ndarray, rows: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add to each row's vector the index vectors of its neighbours. Row 0 separates documents."""
    for begin in range(0, len(rows), SLICE):
        # Neighbours before and after a slice count as well.
        low, high = max(0, begin - WINDOW), min(len(rows), begin + SLICE + WINDOW)
        near, own, last = rows[low:high], np.arange(begin, min(begin + SLICE, len(rows))), len(rows)
        at, weight = [], []
        for step in [*range(-WINDOW, 0), *range(1, WINDOW + 1)]:
            inside = own[(own + step >= 0) & (own + step < last)]
            other = near[inside + step - low]
            for place, sign in zip(places, signs, strict=True):
                at.append(rows[inside] * DIMS + place[other])
                weight.append(sign[other])
        table += np.bincount(np.concatenate(at), np.concatenate(weight), table.size).astype(np.int64)


def word_vectors(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """The table of word vectors over all texts, rows of length one; ``ROWS`` x ``DIMS``.

    Each task sums up its texts in one table of fixed size and passes it on in blocks; a block's
    sums are added up as they arrive. Sums are whole numbers, so their order does not matter. The
    driver gets the one table.
    """
    small_batches(docs.sparkSession)

    def gather(batches):
        import pyarrow as pa

        reader, table = Reader(), np.zeros(ROWS * DIMS, np.int64)
        places, signs = index_vectors()
        gap = np.zeros(WINDOW, np.int64)
        for batch in batches:
            parts = []
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                parts += [reader.rows(text), gap]
            if parts:
                add_neighbours(table, np.concatenate(parts), places, signs)
        size = BLOCK * DIMS
        for block in range(ROWS // BLOCK):
            part = table[block * size:(block + 1) * size]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int32()), pa.array([part.astype("<i4").tobytes()], pa.binary())], names=["block", "sums"])

    def add_up(batches):
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = sums.setdefault(block, np.zeros(BLOCK * DIMS, np.int64))
                found += np.frombuffer(part, "<i4")
        yield pa.RecordBatch.from_arrays([
            pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["block", "sums"])

    schema = "block int, sums binary"
    parts = docs.select(valid_text(F.col(f"`{text_column}`")).alias("text")).mapInArrow(gather, schema)
    summed = parts.repartition(32, "block").mapInArrow(add_up, schema)
    table = np.zeros((ROWS, DIMS))
    for row in summed.collect():
        table[row["block"] * BLOCK:(row["block"] + 1) * BLOCK] = np.frombuffer(row["sums"], np.int64).reshape(BLOCK, DIMS)
    table[0] = 0
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(length > 0, length, 1)).astype(np.float32)


def pool(rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the vectors, and the logarithm of their number; zeros without words."""
    total, squares = np.zeros(DIMS), np.zeros(DIMS)
    for begin in range(0, len(rows), SLICE):
        part = vectors[rows[begin:begin + SLICE]]
        total += part.sum(0, dtype=np.float64)
        squares += np.einsum("ij,ij->j", part, part, dtype=np.float64)
    n = max(1, len(rows))
    mean = total / n
    return np.concatenate([mean, np.sqrt(np.maximum(squares / n - mean * mean, 0)), [np.log1p(len(rows)) / 10]])


@dataclass
class Network:
    """Standardised input, a hidden layer of hyperbolic tangents, one logit over a temperature."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 3) -> Network:
    """Fit the network by Adam on one part of the rows, and its temperature on the other."""
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(y))
    aside = order[:int(CALIBRATION_SHARE * len(y))] if len(y) >= 50 else order
    rows = np.setdiff1d(order, aside) if len(y) >= 50 else order
    xs, ys = x[rows], y[rows]
    scale = xs.std(0)
    net = Network(xs.mean(0), np.where(scale > 1e-9, scale, 1.0), draw.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN ** -0.5, HIDDEN), 0.0)
    values = {"w1": net.w1, "b1": net.b1, "w2": net.w2, "b2": np.zeros(1)}
    first, second = ({k: np.zeros_like(v) for k, v in values.items()} for _ in range(2))
    z, step = (xs - net.shift) / net.scale, 0
    for _ in range(EPOCHS):
        turn = draw.permutation(len(ys))
        for begin in range(0, len(turn), BATCH):
            part = turn[begin:begin + BATCH]
            hidden = np.tanh(z[part] @ values["w1"] + values["b1"])
            wrong = (1 / (1 + np.exp(-(hidden @ values["w2"] + values["b2"]))) - ys[part]) / len(part)
            back = np.outer(wrong, values["w2"]) * (1 - hidden * hidden)
            slopes = {"w1": z[part].T @ back + DECAY * values["w1"], "b1": back.sum(0), "w2": hidden.T @ wrong + DECAY * values["w2"], "b2": wrong.sum(keepdims=True)}
            step += 1
            for k, slope in slopes.items():
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope * slope
                values[k] -= RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    net.b2 = float(values["b2"][0])
    logits = net.logits(x[aside])

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, logits / t) - y[aside] * logits / t))

    net.temperature = min((float(t) for t in np.geomspace(0.25, 8, 121)), key=loss)
    return net


def _pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """``doc_id`` and ``pooled`` of rows with a binary ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches):
        import pyarrow as pa

        reader = Reader()
        for batch in batches:
            pooled = [pool(reader.rows(t), shared.value).tobytes() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(pooled, pa.binary())], names=["doc_id", "pooled"])

    return docs.mapInArrow(run, "doc_id long, pooled binary")


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, label: str = "quality", sample: int = SAMPLE) -> Network | None:
    """The network, or None without labelled documents.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and the label, 0 or 1. At most
    ``sample`` labelled rows take part, those with the least hashes of their id. Of labels that
    repeat the greatest counts; null ids and labels take no part. The driver gets a vector per row
    of the sample.
    """
    given = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    chosen = given.select("doc_id", "y", F.xxhash64(F.lit(9), "doc_id").alias("h")).join(
        docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy("h", "doc_id").limit(sample)
    chosen = {r["doc_id"]: r["y"] for r in chosen.collect()}
    if not chosen:
        return None
    spark = docs.sparkSession
    ids = spark.createDataFrame([(i,) for i in chosen], "doc_id long")
    wanted = docs.join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", "text")
    found = sorted((r["doc_id"], bytes(r["pooled"])) for r in _pooled(wanted, vectors).collect())
    x = np.stack([np.frombuffer(p) for _, p in found])
    return fit(x, np.array([chosen[i] for i, _ in found]))


def score(
    docs: DataFrame, labels: DataFrame, label: str = "quality", learn_from: Column | None = None,
    id_column: str = "doc_id", text_column: str = "text", carry: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``score``, 0 to 1, higher where label 1 is likelier,
    and the columns ``carry`` as they are.

    Word vectors come from all texts, the labels only from documents for which ``learn_from``, an
    expression over ``doc_id``, holds. Nothing but the text enters a score. Null texts count as
    empty, bytes that are no UTF-8 as U+FFFD, and texts without words get the score of a zero vector. Without labelled documents all
    scores are 0.5. Rows that repeat are scanned each for itself; other columns play no part. Tasks
    hold one batch of texts and the table of vectors.
    """
    small_batches(docs.sparkSession)
    here = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), valid_text(F.col(f"`{text_column}`")).alias("text"))
    vectors = word_vectors(here)
    learn = here if learn_from is None else here.filter(learn_from)
    network = train(learn, labels, vectors, label)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(batches):
        import pyarrow as pa

        reader, (vectors, network) = Reader(), shared.value
        for batch in batches:
            pooled = [pool(reader.rows(t), vectors) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            scores = network.scores(np.stack(pooled)) if network and pooled else np.full(len(pooled), 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), *batch.columns[2:]], names=["doc_id", "score", *batch.schema.names[2:]])

    kinds = dict(docs.dtypes)
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), valid_text(F.col(f"`{text_column}`")).alias("text"),
        *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(carry)])
    schema = ", ".join(["doc_id long, score double", *(f"_{i} {kinds[c]}" for i, c in enumerate(carry))])
    return rows.mapInArrow(run, schema).select("doc_id", "score", *[F.col(f"_{i}").alias(c) for i, c in enumerate(carry)])
