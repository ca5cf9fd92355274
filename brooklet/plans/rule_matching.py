"""Live rule matching."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brooklet.functions.predicates import EventColumns
from brooklet.operators.buckets import BucketedTable
from brooklet.operators.ordered import running, running_count
from brooklet.operators.rules import (
    RULE_KEY, Rule, fan_out, last_state, live_rules, rule_progress, verdicts,
)
from brooklet.sources.changelog import latest_per_key
from brooklet.streaming import runner, stateful


def start(
    events: DataFrame, rules: list[Rule], audience: DataFrame, columns: EventColumns, order: list[str], path: str,
    baselines: DataFrame | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Match a stream of events against the rules; matches go to ``path``.

    Counters and sequence steps are state per (rule, user), starting from ``baselines``. A
    restart with more rules keeps the state of the old ones. Caps per user are applied per
    micro-batch, on top of the matches written by earlier ones.
    """
    rows = fan_out(events, rules, audience, columns, order)
    start_columns = None
    if baselines is not None:
        rows = rows.join(baselines, RULE_KEY, "left")
        start_columns = ("base_counts", "base_step", "base_sequences")
    size = max((len(r.counts) for r in rules), default=0)
    progress = stateful.rule_progress(rows, RULE_KEY, ["match_time", *order], size, start_columns)
    matched = verdicts(progress, rules)
    def write(batch: DataFrame, batch_id: int) -> None:
        _keep_capped(batch, path, order, batch_id)

    return runner.start(matched, runner.reused(write), f"{path}/checkpoint", trigger=trigger)


def _keep_capped(matched: DataFrame, path: str, order: list[str], batch_id: int) -> None:
    """Write matches of a micro-batch, as far as their cap leaves room after earlier ones."""
    spark = matched.sparkSession
    counts = BucketedTable(spark, f"{path}/match_counts", RULE_KEY, ["n"])
    counted = running(matched, RULE_KEY, ["match_time", *order], {"_match": running_count()})
    if counts.exists(batch_id):
        before = counts.read(before=batch_id, of=matched).withColumnRenamed("n", "_before")
        counted = counted.join(before, RULE_KEY, "left").withColumn(
            "_match", F.col("_match") + F.coalesce("_before", F.lit(0))).drop("_before")
    kept = counted.where(F.col("_cap").isNull() | (F.col("_match") <= F.col("_cap"))).persist()
    try:
        kept.drop("_cap", "_match").write.mode("overwrite").parquet(f"{path}/matches/batch={batch_id}")
        capped = kept.where(F.col("_cap").isNotNull())
        counts.upsert(capped.select(*RULE_KEY, F.col("_match").alias("n")), batch_id)
    finally:
        kept.unpersist()


def start_following(
    events: DataFrame, current: Callable[[SparkSession], tuple[list[Rule], DataFrame]], columns: EventColumns,
    order: list[str], path: str, baselines: DataFrame | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Live matching that follows changes of the rules while it runs.

    ``current`` gives the rules in force and their audience ``(rule_id, guid)``; it is asked
    before every micro-batch, for instance from the state of a rule changelog. The counters
    then live in an upsert table instead of the state store, and a micro-batch is matched by
    the batch operators, which also split large users.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rules, audience = current(spark)
        if not rules:
            return
        table = BucketedTable(spark, f"{path}/state", RULE_KEY, ["since"])
        rows = fan_out(batch, rules, audience, columns, order)
        known = [] if baselines is None else [baselines.withColumn("since", F.lit(-1))]
        if table.exists(batch_id):
            known.append(table.read(before=batch_id, of=rows))
        start_state = None
        if known:
            both = known[0] if len(known) == 1 else known[0].unionByName(known[1])
            start_state = latest_per_key(both, RULE_KEY, ["since"]).drop("since")
        progress = rule_progress(rows, rules, ["match_time", *order], start_state).persist()
        try:
            _keep_capped(verdicts(progress, rules), path, order, batch_id)
            state = last_state(progress, ["match_time", *order])
            table.upsert(state.withColumn("since", F.lit(batch_id)), batch_id)
        finally:
            progress.unpersist()

    return runner.start(events, runner.reused(write), f"{path}/checkpoint", trigger=trigger)


def rules_in_force(changes: DataFrame, order: list[str]) -> list[Rule]:
    """Rules of a changelog with their JSON in ``rule_define_json``; as many rows as rules."""
    rows = live_rules(changes, order).select("rule_define_json").collect()
    return [Rule.parse(row[0]) for row in rows]


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", f"{path}/matches").parquet(f"{path}/matches")
