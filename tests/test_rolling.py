"""The rolling sink: sizes, ages, replays and crashes; and interval joins whose cells are cut into tiles."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brooklet.operators.joins import interval_join, tiled_interval_join
from brooklet.sources.rolling import RollingSink


def rows(spark, first, n, buckets=2):
    return spark.range(first, first + n).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"), (F.col("id") % buckets).cast("string").alias("bucket"))


def parts(spark, path):
    """Ids by finished part."""
    found = {}
    for file in sorted(path.glob("bucket=*/part=*/piece=*/*.parquet")):
        for r in spark.read.parquet(str(file)).select("id").collect():
            found.setdefault(str(file.relative_to(path)), []).append(r["id"])
    return found


def test_parts_grow_over_micro_batches_and_roll_by_size(spark, tmp_path):
    path, limit = tmp_path / "s", 200_000
    sink = RollingSink(spark, str(path), roll_bytes=limit, roll_seconds=10**9, clock=lambda: 0.0)
    for i in range(8):
        sink.write(rows(spark, 1000 * i, 1000), i)
    sizes = [f.stat().st_size for f in path.glob("bucket=*/part=*/piece=*/*.parquet")]
    assert sizes and max(sizes) < 1.5 * limit and min(sizes) > limit / 3
    whole = sum(len(v) for v in parts(spark, path).values())
    assert 0 < whole < 8000
    sink.finish(rows(spark, 0, 1).schema, 8)
    assert sorted(i for v in parts(spark, path).values() for i in v) == list(range(8000))
    assert not list(path.glob("_progress/*/bucket=*"))


def test_one_large_micro_batch_is_several_parts(spark, tmp_path):
    path = tmp_path / "s"
    RollingSink(spark, str(path), roll_bytes=100_000).write(rows(spark, 0, 10_000, 1), 0)
    sizes = [f.stat().st_size for f in path.glob("bucket=*/part=*/piece=*/*.parquet")]
    assert len(sizes) > 4 and max(sizes) < 200_000


def test_parts_roll_by_age(spark, tmp_path):
    path, now = tmp_path / "s", [0.0]
    sink = RollingSink(spark, str(path), clock=lambda: now[0])
    seen = []
    for i in range(4):
        sink.write(rows(spark, 10 * i, 10, 1), i)
        seen.append(sum(len(v) for v in parts(spark, path).values()))
        now[0] += 5
    assert seen == [0, 0, 30, 30]


@pytest.mark.parametrize("crash", ["before the manifest", "after the manifest", "after the rename"])
def test_replays_leave_no_double_part(spark, tmp_path, crash):
    path, now = tmp_path / "s", [0.0]
    sink = RollingSink(spark, str(path), clock=lambda: now[0])
    sink.write(rows(spark, 0, 10, 1), 0)
    now[0] = 20
    if crash == "before the manifest":
        rows(spark, 10, 5, 1).write.partitionBy("bucket").parquet(f"{path}/_progress/batch=1")
        assert parts(spark, path) == {}
    else:
        sink.write(rows(spark, 10, 10, 1), 1)
        if crash == "after the manifest":
            (path / "_pending/batch=1").mkdir(parents=True, exist_ok=True)
            (path / "bucket=0/part=1").rename(path / "_pending/batch=1/bucket=0")
            assert parts(spark, path) == {}
    now[0] = 100
    sink.write(rows(spark, 10, 10, 1).repartition(3), 1)
    assert sorted(i for v in parts(spark, path).values() for i in v) == list(range(20))


def test_tiled_interval_join_equals_the_plain_one(spark):
    base = datetime(2024, 1, 1)
    left = spark.createDataFrame([("hot" if i % 3 else "cold", i, base + timedelta(seconds=i % 40)) for i in range(150)], "k string, l long, lt timestamp")
    right = spark.createDataFrame([("hot" if i % 4 else None, i, base + timedelta(seconds=i % 50)) for i in range(120)], "k string, r long, rt timestamp")
    span = (timedelta(seconds=-3), timedelta(seconds=9))
    want = sorted((x["l"], x["r"]) for x in interval_join(left, right, ["k"], "lt", "rt", *span).collect())
    for dense in (1, 4, 10**6):
        joined = tiled_interval_join(left, right, ["k"], "lt", "rt", *span, dense_rows=dense)
        assert sorted((x["l"], x["r"]) for x in joined.collect()) == want
        assert joined.columns == ["k", "l", "lt", "r", "rt"]


def test_a_dense_cell_spreads_over_many_tiles(spark):
    """One key and one second with all rows: no tile has more than about the limit of either side."""
    left = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("l"), F.lit("2024-01-01").cast("timestamp").alias("lt"))
    right = spark.range(50).select(F.lit(1).alias("k"), F.col("id").alias("r"), F.lit("2024-01-01").cast("timestamp").alias("rt"))
    joined = tiled_interval_join(left, right, ["k"], "lt", "rt", timedelta(0), timedelta(seconds=1), dense_rows=500)
    assert joined.count() == 4000 * 50
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_row" in plan and "_column" in plan
