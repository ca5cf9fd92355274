"""Random inputs against plain Python."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from brooklet.operators import sequences


def plain_walk(masks, last, state):
    step, n = state
    out = []
    for mask in masks:
        if mask >> step & 1:
            step, n = (0, n + 1) if step == last else (step + 1, n)
        out.append((step, n))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 7)), min_size=1, max_size=60), st.integers(0, 2))
def test_walking_in_jumps_equals_walking_row_by_row(rows, step):
    rows = sorted(rows, key=lambda r: r[0])
    met = [[i for i in range(3) if r[1] >> i & 1] for r in rows]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows]), pa.array(met, pa.list_(pa.int32())), pa.array([2] * len(rows))], names=["k", "_steps", "_last"])
    jumps = sequences._next_hits(batch)
    for (key,), begin, end in sequences._runs(batch, ["k"]):
        masks = [m for k, m in rows if k == key]
        assert end - begin == len(masks)
        assert sequences._advance(jumps, begin, end, 2, (step, 0)) == plain_walk(masks, 2, (step, 0))[-1]


def test_sampled_cut_points_bound_the_blocks(spark):
    from pyspark.sql import functions as F

    from brooklet.operators.ordered import BLOCK, find_splits, running, running_count, with_blocks

    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("at"))
    splits = find_splits(rows, ["k"], ["at"], 640)  # One row in ten is sampled.
    assert [r.k for r in splits.rows] == [0]
    sizes = with_blocks(rows.where("k = 0"), splits).groupBy(BLOCK).count().collect()
    assert len(sizes) > 5 and max(s["count"] for s in sizes) < 3 * 640
    counted = running(rows, ["k"], ["at"], {"n": running_count()}, splits=splits).where("k = 0")
    assert counted.where(F.col("n") != F.col("at") / 3 + 1).count() == 0
    assert counted.count() == 6_667
