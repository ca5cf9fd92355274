"""Event patterns against plain runs of them, also with keys cut into blocks, and as streams."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brooklet.operators.patterns import Pattern, match_pattern

BASE = datetime(2024, 1, 1)


def kind(name):
    return F.col("kind") == name


#: Patterns by name: a pattern, and the same as (condition, strict) of plain kinds with a limit in seconds.
def patterns():
    return {
        "bounce": (Pattern.begin(kind("a")).next(kind("a")).within(timedelta(seconds=10)), [("a", False), ("a", True)], 10),
        "funnel": (Pattern.begin(kind("a")).followed_by(kind("b")).followed_by(kind("c")).within(timedelta(seconds=40)),
                   [("a", False), ("b", False), ("c", False)], 40),
        "times": (Pattern.begin(kind("b")).times(3), [("b", False)] * 3, None),
        "in a row": (Pattern.begin(kind("b")).times(2, consecutive=True).followed_by(kind("a")).within(timedelta(seconds=25)),
                     [("b", False), ("b", True), ("a", False)], 25),
        "mixed": (Pattern.begin(kind("a")).followed_by(kind("b")).next(kind("c")).followed_by(kind("a")), [("a", False), ("b", False), ("c", True), ("a", False)], None),
        "alone": (Pattern.begin(kind("c")).within(timedelta(seconds=5)), [("c", False)], 5),
    }


def brute(rows, stages, limit):
    out = []
    for key in {r[0] for r in rows}:
        mine = sorted((at, i, k) for g, at, i, k in rows if g == key)
        for begin, (at, i, k) in enumerate(mine):
            if k != stages[0][0]:
                continue
            met, stage, reason = [i], 1, None
            for later, j, other in mine[begin + 1:] if len(stages) > 1 else []:
                if limit is not None and (later - at).total_seconds() >= limit:
                    reason = "timeout"
                    break
                if other == stages[stage][0]:
                    met, stage = [*met, j], stage + 1
                    if stage == len(stages):
                        break
                elif stages[stage][1]:
                    reason = "dead"
                    break
            if stage == len(stages):
                reason = "match"
            elif reason is None and limit is not None:
                reason = "timeout"
            if reason in ("match", "timeout"):
                out.append((key, i, reason, met))
    return sorted(out, key=str)


def events(seed, n=300):
    draw = random.Random(seed)
    rows, at = [], BASE
    for i in range(n):
        at += timedelta(seconds=draw.choice([0, 1, 3, 9, 10, 30]))
        rows.append((draw.choice(["x", "x", "x", "y", None]), at, i, draw.choice(["a", "b", "c", None])))
    return rows


SCHEMA = "key string, at timestamp, id long, kind string"


@pytest.mark.parametrize("block_rows", [10**6, 20])
@pytest.mark.parametrize("name", ["bounce", "funnel", "times", "in a row", "mixed", "alone"])
def test_against_plain_runs(spark, name, block_rows):
    pattern, stages, limit = patterns()[name]
    rows = events(len(name))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    ends = match_pattern(df, ["key"], "at", ["at", "id"], "id", pattern, block_rows=block_rows)
    assert ends.columns == ["key", "at", "id", "kind", "reason", "met"]
    assert sorted(((r["key"], r["id"], r["reason"], r["met"]) for r in ends.collect()), key=str) == brute(rows, stages, limit)


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert match_pattern(df, ["key"], "at", ["at", "id"], "id", patterns()["funnel"][0]).count() == 0


def test_a_stage_is_there_at_least_once():
    with pytest.raises(ValueError, match="once"):
        Pattern.begin(F.lit(True)).times(0)


@pytest.mark.parametrize("name", ["bounce", "mixed"])
def test_stream_over_micro_batches(spark, tmp_path, name):
    """Rows out of order across micro-batches, null keys, and runs that only the watermark ends."""
    from brooklet.streaming import processors, runner

    pattern, stages, limit = patterns()[name]
    rows = events(7, 120)
    shuffled = sorted(rows, key=lambda r: (r[1] + timedelta(seconds=(r[2] * 7) % 20), r[2]))
    parts = [shuffled[:40], shuffled[40:80], shuffled[80:], [("nobody", datetime(2100, 1, 1), -1, None)]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/source/{i}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/source/*")
    ends = processors.match_pattern(stream, ["key"], "at", "id", pattern, "40 seconds")
    found = runner.run_to_table(spark, ends, "pattern-test").collect()
    assert sorted(((r["key"], r["id"], r["reason"], r["met"]) for r in found), key=str) == brute(rows, stages, limit)
