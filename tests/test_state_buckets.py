"""Streams keep one state for many keys, and give the rows of plain runs whatever the number of buckets."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from brooklet.catalog import QUERIES
from brooklet.catalog import patterns as catalog_patterns
from brooklet.operators import joins, patterns, windows
from brooklet.session import scratch_path
from brooklet.streaming import processors, runner, stateful

BASE = datetime(2024, 1, 1)
#: Neighbours that are equal as doubles.
LARGE = 2**60


@pytest.fixture
def own_store(spark):
    before = spark.conf.get(processors.PROVIDER)
    yield
    spark.conf.set(processors.PROVIDER, before)


def in_batches(spark, path, parts, schema):
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{path}/{i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def run(spark, df):
    """What a stream wrote, and the most states it kept."""
    path = scratch_path(spark, "buckets")
    query = runner.start(df, runner.parquet_batches(f"{path}/out"), f"{path}/checkpoint")
    query.awaitTermination()
    states = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"])
    return spark.read.option("basePath", f"{path}/out").parquet(f"{path}/out").select(*df.columns), states


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("buckets", [2, 50])
def test_asof_join(spark, tmp_path, own_store, buckets):
    """a state and its calls for every key made the join of many keys fail."""
    def at(i):
        return BASE + timedelta(minutes=i // 8)

    facts, versions = "k long, at timestamp, id long, text string", "k long, since timestamp, tie long, v string"
    left = [(i % 41 if i % 13 else None, at(i), LARGE + i, f"t{i}") for i in range(400)]
    changes = [(i % 37, at(i) if i % 11 else None, LARGE + i % 2 * 37 - i, f"v{i}") for i in range(400)]
    end = datetime(2100, 1, 1)
    streams = [
        in_batches(spark, f"{tmp_path}/l", [left[:150], left[150:], [(-1, end, None, None)]], facts),
        in_batches(spark, f"{tmp_path}/v", [changes[:250], changes[250:], [(-1, end, None, None)]], versions)]
    orders = {"left_order": ("at", "id"), "version_order": ("since", "tie")}
    found, states = run(spark, processors.asof_join(*streams, ["k"], **orders, disorder="1 hour", buckets=buckets))
    whole = joins.asof_join(spark.createDataFrame(left, facts), spark.createDataFrame(changes, versions), ["k"], **orders)
    assert rows_of(found) == rows_of(whole.select(*found.columns))
    assert found.where(F.col("v").isNotNull()).count() > 100
    assert states <= buckets


@pytest.mark.parametrize("buckets", [2, 50])
def test_patterns(spark, tmp_path, own_store, buckets):
    """a state and its calls for every key."""
    schema = "key string, at timestamp, id long, kind string"
    rows = [(f"k{i * 7 % 60}" if i % 9 else None, BASE + timedelta(seconds=5 * i), LARGE + i, "abc"[i * i % 7 % 3]) for i in range(600)]
    parts = [rows[:200], rows[200:400], rows[400:], [("nobody", datetime(2100, 1, 1), -1, None)]]
    kind = F.col("kind")
    pattern = patterns.Pattern.begin(kind == "a").followed_by(kind == "b").next(kind == "c").within(timedelta(minutes=40))
    stream = in_batches(spark, f"{tmp_path}/in", parts, schema)
    found, states = run(spark, processors.match_pattern(stream, ["key"], "at", "id", pattern, "1 minute", buckets=buckets))
    whole = patterns.match_pattern(spark.createDataFrame(rows, schema), ["key"], "at", ["at", "id"], "id", pattern)
    assert rows_of(found) == rows_of(whole.select(*found.columns))
    assert {r["reason"] for r in found.collect()} == {"match", "timeout"}
    assert states <= buckets


@pytest.mark.parametrize("by", ["v", "n", "s", "d"])
@pytest.mark.parametrize("buckets", [1, 50])
def test_running_argmin(spark, tmp_path, buckets, by):
    """a call of pandas for every key; null keys, values and large numbers of one bucket keep apart."""
    schema = "k string, id long, v double, n long, s string, d timestamp"

    def row(i):
        n = i * 31 % 17
        return (f"k{i % 23}" if i % 8 else None, LARGE + i, None if i % 5 == 0 else n / 4, None if i % 6 == 0 else LARGE + n,
                None if i % 7 == 0 else f"s{n}", None if i % 4 == 0 else BASE + timedelta(microseconds=n))

    rows = [row(i) for i in range(300)]
    stream = in_batches(spark, f"{tmp_path}/in", [rows[:100][::-1], rows[100:110], rows[110:][::-1]], schema)
    found, states = run(spark, stateful.running_argmin(stream, ["k"], ["id"], by, buckets=buckets))
    assert found.columns == ["k", "id", "v", "n", "s", "d", *[f"least_{c}" for c in ("id", "v", "n", "s", "d")]]
    whole = windows.running_argmin(spark.createDataFrame(rows, schema), ["k"], ["id"], by)
    assert rows_of(found) == rows_of(whole.select(
        "k", "id", "v", "n", "s", "d", *[F.col(f"least.{c}").alias(f"least_{c}") for c in ("id", "v", "n", "s", "d")]))
    assert states <= buckets


def test_state_is_compressed():
    """buckets of many rows took a multiple of their size in the store and on the way to it."""
    rows = pd.DataFrame({"key": [f'{{"k":{i % 50}}}' for i in range(5000)], "at": range(5000), "payload": [f'{{"k":{i % 50},"text":"row {i}"}}' for i in range(5000)]})
    state = stateful.packed(rows)
    assert len(state) < rows["payload"].str.len().sum() / 3
    pd.testing.assert_frame_equal(stateful.unpacked(state), rows)


def test_stretches_of_time_bound_a_micro_batch(spark, tmp_path, monkeypatch):
    """F2: a micro-batch was a third of the tables, and all its rows wait in state for the next one."""
    first, days = datetime(1993, 1, 1), 2000
    orders = [(i, i % 23, first + timedelta(days=i * 7 % days) if i % 19 else None, f"p{i % 5}") for i in range(600)]
    # A tenth of all shipments are of one day, and no order is placed in the last months.
    shipped = [first + timedelta(days=900 if i % 10 == 0 else i * 11 % (days + 400)) if i % 31 else None for i in range(3000)]
    items = [(i % 600, i % 7, i % 11, i // 600, at) for i, at in enumerate(shipped)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(catalog_patterns, "PART_ROWS", 400, raising=False)
    monkeypatch.setattr(catalog_patterns, "FILE_ROWS", 100, raising=False)
    queries, start, store = [], runner.start, spark.conf.get(processors.BOUNDED, None)
    monkeypatch.setattr(runner, "start", lambda *a, **b: queries.append(start(*a, **b)) or queries[-1])
    found = rows_of(QUERIES["stream_dim_refresh"](spark, str(tmp_path)))
    whole = QUERIES["dim_refresh"](spark, str(tmp_path))
    assert found == rows_of(whole.select("order_id", "supplier_id", "part_id", "shipped", "version_id", "priority"))
    assert sum("p1" in r for r in found) > 100
    taken = [p["numInputRows"] for p in queries[0].recentProgress if p["numInputRows"]]
    # Shipments are read twice, for those with and those without a time; one stretch holds the day of many rows.
    assert len(taken) > 6
    assert max(taken) < 2 * (400 + 300)
    assert spark.conf.get(processors.BOUNDED, None) == store
