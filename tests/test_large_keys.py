"""Operators give the same rows when large keys are cut into blocks."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from brooklet.catalog import blocks, rules as rule_queries
from brooklet.functions.predicates import event_flag
from brooklet.operators import joins, lateness, rules, sequences, visits, windows
from brooklet.tables import load

ORDER = ["ts", "event_id"]
NEVER = 10**9


@pytest.fixture(scope="module")
def events(spark, sf):
    """A third of all rows belong to user 0."""
    rows = load(spark, sf, "events")
    return rows.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")))


def same(a, b):
    left, right = sorted(map(str, a.collect())), sorted(map(str, b.select(*a.columns).collect()))
    assert left == right
    return len(left)


def test_sessions(events):
    gap = F.lit(timedelta(hours=3))

    def run(rows):
        return windows.session_windows(events, ["user_id"], "ts", ORDER, gap, {"n": F.count(F.lit(1))}, rows)

    assert same(run(NEVER), run(20)) > 100


@pytest.mark.parametrize("keys", [["user_id"], []])
def test_count_windows(events, keys):
    def tumbling(rows):
        return windows.count_windows(events, keys, ORDER, 10, {"first": F.min("event_id")}, rows)

    def sliding(rows, stretch):
        return windows.sliding_count_windows(
            events, keys, ORDER, 10, 2, {"n": F.count(F.lit(1)), "ids": F.sum("event_id")}, rows, stretch)

    assert same(tumbling(NEVER), tumbling(25))
    assert same(sliding(NEVER, NEVER), sliding(25, 40))


def test_bounces(events):
    def run(rows):
        return visits.bounces(events, "user_id", "ts", ORDER, F.col("event_type") == "view", timedelta(hours=2),
                              block_rows=rows)

    assert same(run(NEVER), run(20))


def test_rolling_argmin(events):
    rows = events.drop("props")
    assert same(windows.running_argmin(rows, ["user_id"], ORDER, "value", NEVER),
                windows.running_argmin(rows, ["user_id"], ORDER, "value", 20))


def test_asof_joins_agree(events):
    versions = events.where(F.col("event_type") == "signup").select(
        "user_id", F.col("ts").alias("v_ts"), F.col("event_id").alias("v_id"))

    def run(small, rows=NEVER):
        return joins.asof_join(events, versions, ["user_id"], left_order=("ts", "event_id"),
                               version_order=("v_ts", "v_id"), small_rows=small, block_rows=rows)

    assert same(run(10_000), run(0)) == 1000
    assert same(run(10_000), run(0, 20)) == 1000


def test_asof_join_without_key(events):
    versions = events.where(F.col("event_type") == "signup").select(
        F.col("ts").alias("v_ts"), F.col("event_id").alias("v_id"))

    def run(rows):
        return joins.asof_join(events, versions, [], left_order=("ts", "event_id"), version_order=("v_ts", "v_id"),
                               block_rows=rows)

    assert same(run(NEVER), run(30)) == 1000


def test_validity_closes_at_the_next_change(events):
    changes = events.where(F.col("event_type") == "signup").select("user_id", *ORDER)
    spans = joins.validity(changes, ["user_id"], ORDER)
    open_ended = spans.where(F.col("valid_to").isNull()).count()
    assert open_ended == changes.select("user_id").distinct().count()
    assert spans.where(F.col("valid_to") < F.col("ts")).count() == 0


def stepping(events):
    specs = [event_flag(s, rule_queries.COLUMNS) for s in rule_queries.STEPS]
    return events.select("user_id", *ORDER, sequences.step_hits(specs).alias("hits"))


def brute_force(rows):
    """One pass per user in plain Python."""
    state, out = {}, []
    for r in sorted(rows, key=lambda r: (r.ts, r.event_id)):
        step, n = state.get(r.user_id, (0, 0))
        if r.hits[step]:
            step, n = (0, n + 1) if step == 2 else (step + 1, n)
        state[r.user_id] = (step, n)
        out.append((r.event_id, step, n))
    return state, sorted(out)


@pytest.mark.parametrize("block", [NEVER, 12])
def test_sequences_match_brute_force(events, block):
    rows = stepping(events)
    state, progress = brute_force(rows.collect())
    walked = sequences.sequence_progress(rows, ["user_id"], ORDER, 3, block_rows=block)
    assert sorted((r.event_id, r.step, r.n) for r in walked.collect()) == progress
    final = sequences.sequence_state(rows, ["user_id"], ORDER, 3, block_rows=block)
    assert {r.user_id: (r.step, r.n) for r in final.collect()} == state


def test_sequences_go_on_from_a_given_state(events):
    rows = stepping(events)
    cut = F.lit("2024-01-12 00:00:00").cast("timestamp_ntz")
    early = sequences.sequence_state(rows.where(F.col("ts") < cut), ["user_id"], ORDER, 3).withColumnsRenamed(
        {"step": "s0", "n": "n0"})
    late = rows.where(F.col("ts") >= cut).join(early, "user_id", "left")
    whole = sequences.sequence_progress(rows, ["user_id"], ORDER, 3).where(F.col("ts") >= cut)
    for block in (NEVER, 12):
        resumed = sequences.sequence_progress(late, ["user_id"], ORDER, 3, ("s0", "n0"), block_rows=block)
        assert same(whole.select("event_id", "step", "n"), resumed) > 100


def test_late_rows_and_refires(events):
    def run(rows):
        arrived = events.select("event_id", "user_id", "ts", (F.col("user_id") % 2).alias("source"),
                                (F.col("event_id") + F.col("event_id") * 37 % 50).alias("arrival"))
        return lateness.late_window_counts(
            arrived, ["source"], ["user_id"], ["arrival", "event_id"], "ts", timedelta(seconds=3), "1 day",
            timedelta(hours=12), rows)

    assert same(run(NEVER), run(10)) > 100


def test_rule_matches(spark, sf, events):
    history = events.withColumnRenamed("user_id", "guid").withColumn("event_pk", F.col("event_id"))
    which = rule_queries.rules()
    everyone = history.select("guid").distinct()
    audience = everyone.select(F.lit("M1-R1").alias("rule_id"), "guid").unionByName(
        everyone.select(F.lit("M2-R1").alias("rule_id"), "guid"))

    def run(rows):
        return rules.match_rules(history, which, audience, rule_queries.COLUMNS, ["event_pk"], block_rows=rows)

    assert same(run(NEVER), run(15)) > 20


def test_new_user_flag(events):
    claims = events.select("user_id", *ORDER, F.when(F.col("event_type") == "signup", "1").otherwise("0").alias("is_new"))
    flagged = visits.correct_new_flag(claims, "user_id", ORDER)
    assert flagged.count() == claims.count()
    kept = flagged.where("is_new = '1'").groupBy("user_id").count().where("count <> 1").count()
    assert kept == 0


def test_block_queries_make_no_more_blocks_for_more_rows(spark):
    assert [blocks.block_rows(spark.range(n)) for n in (0, 1_000, 100_000, 5_000_000)] == [100, 100, 100, 5_000]
