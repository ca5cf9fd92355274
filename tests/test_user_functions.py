"""User-defined aggregates and mappers."""

from pyspark.sql import functions as F

from brooklet.functions import user


def test_aggregate_merges_partial_results(spark, monkeypatch):
    mean = user.Aggregate(
        create=lambda: (0, 0), add=lambda s, v: (s[0] + 1, s[1] + v), merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        result=lambda s: (s[1] / s[0],), state="n BIGINT, total BIGINT", output="mean DOUBLE")
    rows = spark.range(0, 1000, 1, 8).select((F.col("id") % 7).cast("string").alias("k"), "id")
    monkeypatch.setattr(user, "HELD_KEYS", 3)
    found = {r.k: r["mean"] for r in user.aggregate(rows, ["k"], ["id"], mean).collect()}
    assert found == {str(k): sum(range(k, 1000, 7)) / len(range(k, 1000, 7)) for k in range(7)}


def test_mapper_may_drop_and_repeat_rows(spark):
    doubled = user.map_batches(
        spark.range(10), lambda b: b.loc[b.index.repeat(2)][b["id"].repeat(2) > 6], "id BIGINT")
    assert sorted(r.id for r in doubled.collect()) == [7, 7, 8, 8, 9, 9]
