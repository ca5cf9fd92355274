"""Snapshots in chunks, merged with the log under any interleaving."""

import random

import pytest
from pyspark.sql import functions as F

from brooklet.operators.snapshot import merged_snapshot


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_interleaving_gives_the_latest_state(spark, seed):
    draw = random.Random(seed)
    log, position, alive = [], 0, {}
    for _ in range(400):
        position += draw.randrange(1, 3)
        key = draw.randrange(40)
        kind = draw.choice(["UPDATE", "UPDATE", "DELETE"]) if key in alive else "CREATE"
        log.append((key, f"v{position}", kind, position))
        alive[key] = kind != "DELETE"
        if kind == "DELETE":
            del alive[key]

    def state(upto, keys):
        out = {}
        for k, v, kind, at in log:
            if k in keys and at <= upto:
                out[k] = v
                if kind == "DELETE":
                    del out[k]
        return out

    marks, rows = [], []
    for chunk in range(4):  # Keys 32 to 39 have no chunk: their changes come as they are.
        low = draw.randrange(0, position)
        high = low + draw.randrange(0, 150)
        marks.append((chunk, low, high))
        for k in range(8 * chunk, 8 * chunk + 8):
            rows += state(draw.randint(low, high), {k}).items()
    changes = spark.createDataFrame(log, "k long, v string, operation string, at long")
    feed = merged_snapshot(
        spark.createDataFrame(rows, "k long, v string"), spark.createDataFrame(marks, "chunk long, low long, high long"), changes, ["k"],
        F.floor(F.col("k") / 8), "at").collect()
    replayed = {}
    for r in sorted(feed, key=lambda r: r["at"]):
        if r["operation"] == "READ":
            assert r["k"] not in replayed
        replayed[r["k"]] = r["v"]
        if r["operation"] == "DELETE":
            replayed.pop(r["k"])
    assert replayed == state(10**9, set(range(40)))
    for chunk, _, high in marks:
        read = {r["k"]: r["v"] for r in feed if r["operation"] == "READ" and r["k"] // 8 == chunk}
        assert read == state(high, set(range(8 * chunk, 8 * chunk + 8)))
        assert all(r["at"] > high for r in feed if r["operation"] != "READ" and r["k"] // 8 == chunk)


def test_empty_tables(spark):
    changes = spark.createDataFrame([], "k long, v string, operation string, at long")
    rows, marks = spark.createDataFrame([], "k long, v string"), spark.createDataFrame([], "chunk long, low long, high long")
    assert merged_snapshot(rows, marks, changes, ["k"], F.floor(F.col("k") / 8), "at").count() == 0
