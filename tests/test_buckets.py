"""Upsert tables in buckets: replays, folds, halved buckets, and what a micro-batch opens."""

import random

import pytest

from brooklet.operators.buckets import BucketedTable

SCHEMA = "k long, at long, v string, gone boolean"


def rows_of(df):
    return {r["k"]: (r["at"], r["v"]) for r in df.collect()}


def test_random_upserts_equal_a_dictionary(spark, tmp_path):
    """With folds, halved buckets, dropped keys, replays and null keys."""
    draw = random.Random(1)
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], ["at"], compact_every=2, dropped="gone", bucket_rows=4, level=1)
    want, before = {}, {}
    for batch_id in range(9):
        rows = [(draw.choice([*range(30), None]), 100 * batch_id + i, f"{batch_id}-{i}", draw.random() < 0.2) for i in range(12)]
        before = {k: v[:2] for k, v in want.items() if not v[2]}
        want.update({k: (at, v, gone) for k, at, v, gone in rows})
        df = spark.createDataFrame(rows, SCHEMA)
        table.upsert(df, batch_id)
        table.upsert(df.repartition(3), batch_id)
        assert rows_of(table.read()) == {k: v[:2] for k, v in want.items() if not v[2]}
        if batch_id:
            assert rows_of(table.read(before=batch_id)) == before
    assert table.manifest().level > 1
    table.compact()
    assert rows_of(table.read()) == {k: v[:2] for k, v in want.items() if not v[2]}
    assert all(len(v) == 1 for v in table.manifest().files.values())


def test_of_equal_orders_the_later_micro_batch_wins(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], ["at"])
    for batch_id, (at, v) in enumerate([(5, "a"), (5, "b"), (4, "c")]):
        table.upsert(spark.createDataFrame([(1, at, v, False)], SCHEMA), batch_id)
    assert rows_of(table.read()) == {1: (5, "b")}


def test_a_micro_batch_opens_its_own_buckets_only(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], ["at"], level=6)
    wanted = spark.range(2).withColumnRenamed("id", "k")
    buckets = {r["b"] for r in wanted.select(table.bucket(6).alias("b")).collect()}
    for batch_id in range(3):
        table.upsert(spark.range(2000 * (batch_id + 1)).selectExpr("id AS k", f"{batch_id}L AS at"), batch_id)
        found = table.read(of=wanted)
        opened = {int(part.removeprefix("bucket=")) for f in found.inputFiles() for part in f.split("/") if part.startswith("bucket=")}
        assert opened == buckets
        assert {0, 1} <= {r["k"] for r in found.select("k").collect()} and found.count() < 2000 * (batch_id + 1) / 8


def test_a_half_written_micro_batch_is_not_seen(spark, tmp_path):
    path = tmp_path / "t"
    table = BucketedTable(spark, str(path), ["k"], ["at"], level=1)
    table.upsert(spark.createDataFrame([(1, 1, "a", False)], SCHEMA), 0)
    table.upsert(spark.createDataFrame([(1, 2, "b", False), (2, 2, "b", False)], SCHEMA), 1)
    (path / "_manifest/1").unlink()
    assert rows_of(table.read()) == {1: (1, "a")}
    table.upsert(spark.createDataFrame([(1, 3, "c", False)], SCHEMA), 1)
    assert rows_of(table.read()) == {1: (3, "c")}


def test_superseded_folders_go(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], ["at"], compact_every=1, level=0)
    for batch_id in range(6):
        table.upsert(spark.createDataFrame([(1, batch_id, "x", False)], SCHEMA), batch_id)
    there = {str(p.relative_to(tmp_path / "t/data")) for p in (tmp_path / "t/data").rglob("bucket=*")}
    kept = table.manifest().folders() | table.manifest(before=5).folders()
    assert kept <= there and len(there) <= len(kept) + 2


def test_nothing_written(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], ["at"])
    assert not table.exists()
    with pytest.raises(ValueError, match="nothing was written"):
        table.read()
    table.upsert(spark.createDataFrame([], SCHEMA), 0)
    assert table.exists() and table.read().count() == 0
