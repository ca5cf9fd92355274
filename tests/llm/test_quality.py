import random
import zlib

import numpy as np

from brooklet.llm import quality
from brooklet.llm.catalog import QUERIES


def test_held_out_accuracy_of_the_query(spark, sf, database):
    rows = {r["doc_id"]: r for r in QUERIES["op5_quality_classifier"](spark, sf).collect()}
    assert len(rows) == database.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())
    labels = database.execute("SELECT doc_id, quality FROM labels").fetchall()
    right = [rows[i]["predicted"] == q for i, q in labels if rows[i]["held_out"]]
    assert np.mean(right) > 0.9


def test_labels_that_are_held_out_change_nothing(spark, frame):
    draw = random.Random(1)
    texts = [(i, " ".join(draw.choice(["good", "fine", "well", "nice"] if i % 2 else ["!!BAD!!", "%%%", "junk###"]) for _ in range(30))) for i in range(120)]
    docs = frame(texts)
    labels = [(i, i % 2) for i in range(120)]
    wrong = [(i, q if i < 80 else 1 - q) for i, q in labels]
    learn = docs["doc_id"] < 80
    scored = []
    for given in (labels, wrong + [(None, 1), (5, None), (7, 0)]):
        table = spark.createDataFrame(given, "doc_id long, quality int")
        scored.append({r["doc_id"]: r["score"] for r in quality.score(docs, table, learn_from=learn).collect()})
    assert scored[0] == scored[1]
    assert all((scored[0][i] >= 0.5) == bool(i % 2) for i in range(80, 120))


def test_hostile_rows_no_labels_and_empty_tables(spark, frame, hostile):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.score(frame(hostile), labels, carry=["source", "score", "key"]).collect()
    assert len(rows) == len(hostile) and {r["source"] for r in rows} == {r[2] if len(r) > 2 else "s" for r in hostile}
    assert all(r[1] == 0.5 for r in rows)
    some = spark.createDataFrame([(4, 1), (5, 1), (6, 1), (20, 1)], "doc_id long, quality int")
    scores = [r["score"] for r in quality.score(frame(hostile), some).collect()]
    assert len(scores) == len(hostile) and all(0 <= s <= 1 for s in scores)
    assert quality.score(frame([]), some).count() == 0


def test_vectors_add_up_whatever_the_partitions(frame, hostile):
    one, many = (quality.word_vectors(frame(hostile, n).select("text")) for n in (1, 7))
    assert np.array_equal(one, many)


def test_neighbours_across_slices(monkeypatch):
    places, signs = quality.index_vectors()
    rows = np.random.default_rng(0).integers(0, quality.ROWS, 500)
    tables = []
    for size in (7, 10_000):
        monkeypatch.setattr(quality, "SLICE", size)
        table = np.zeros(quality.ROWS * quality.DIMS, np.int64)
        quality.add_neighbours(table, rows, places, signs)
        tables.append(table)
    assert np.array_equal(*tables)


def test_temperature_mends_scores_that_are_too_sure():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(4000, 5))
    y = (draw.random(4000) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    scores = quality.fit(x, y).scores(draw.normal(size=(2000, 5)))
    assert 0.3 < scores.mean() < 0.7 and scores.max() < 0.999
