"""Running values are the same with and without cutting large keys into blocks."""

import pytest
from pyspark.sql import functions as F

from brooklet.operators.ordered import (
    BLOCK, find_splits, latest, running, running_count, running_max, running_min, running_sum, with_blocks,
)
from brooklet.tables import load


def values():
    return {
        "n": running_count(),
        "prior_n": running_count(inclusive=False),
        "total": running_sum(F.when(F.col("event_type") == "view", 1)),
        "high": running_max(F.col("value"), inclusive=False),
        "low": running_min(F.struct("value", "event_id")),
        "seen": latest(F.when(F.col("event_type") == "signup", F.col("event_id")), inclusive=False),
    }


@pytest.mark.parametrize("keys", [["user_id"], [], ["event_type"]])
@pytest.mark.parametrize("backwards", [False, True])
def test_blocks_do_not_change_running_values(spark, sf, keys, backwards):
    events = load(spark, sf, "events")
    # A third of all rows on one key.
    events = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")))
    order = ["ts", "event_id"]
    whole = running(events, keys, order, values(), backwards=backwards, block_rows=10**9)
    cut = running(events, keys, order, values(), backwards=backwards, block_rows=16)
    assert find_splits(events, keys, order, 16).rows
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))


def test_blocks_follow_the_order_and_stay_small(spark, sf):
    events = load(spark, sf, "events").withColumn("k", F.lit("all"))
    splits = find_splits(events, ["k"], ["ts", "event_id"], 3)
    blocks = with_blocks(events, splits).groupBy(BLOCK).agg(
        F.count("*").alias("n"), F.min("event_id").alias("lo"), F.max("event_id").alias("hi")
    ).orderBy(BLOCK).collect()
    assert max(b.n for b in blocks) <= 3
    assert len(blocks) == 334
    assert all(a.hi < b.lo for a, b in zip(blocks, blocks[1:]))


def test_null_keys_are_cut_like_others(spark, sf):
    events = load(spark, sf, "events").withColumn("k", F.when(F.col("event_id") % 2 == 0, 7))
    splits = find_splits(events, ["k"], ["ts", "event_id"], 20)
    assert {r["k"] for r in splits.rows} == {None, 7}
    sizes = with_blocks(events, splits).groupBy("k", BLOCK).count().collect()
    assert max(s["count"] for s in sizes) <= 20
    counted = running(events, ["k"], ["ts", "event_id"], {"n": running_count()}, splits=splits)
    whole = running(events, ["k"], ["ts", "event_id"], {"n": running_count()}, block_rows=10**9)
    assert counted.exceptAll(whole).isEmpty()


def test_equal_copies_are_sampled_once(spark):
    copies = spark.range(1000).select(F.lit(1).alias("k"), F.lit(5).alias("at"))
    assert not find_splits(copies, ["k"], ["at"], 4).rows
