"""Audiences, behaviour history and rule matching."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.catalog.registry import query
from brooklet.functions.predicates import (
    Attribute, EventColumns, EventSpec, event_flag, event_ids, json_attribute,
)
from brooklet.functions.times import text
from brooklet.operators import audience as people
from brooklet.operators import bitmaps
from brooklet.operators import rules as rule_ops
from brooklet.operators import sequences
from brooklet.operators.ordered import running, running_count
from brooklet.sources.changelog import changelog_view
from brooklet.plans import rule_publication
from brooklet.session import scratch_path
from brooklet.tables import load

ORDER = ["match_time", "event_pk"]
COLUMNS = EventColumns("event_type", "ts", json_attribute("props"))

PROFILE = [
    {"tagId": "balance", "compareType": "between", "compareValue": "0,6000"},
    {"tagId": "segment", "compareType": "match", "compareValue": "building"},
    {"tagId": "nation", "compareType": "ge", "compareValue": "5"},
]
PROFILE_SQL = "c_acctbal BETWEEN 0 AND 6000 AND c_mktsegment = 'BUILDING' AND c_nationkey >= 5"
# A wider audience, so that enough event users are in it.
WIDE_PROFILE = [{"tagId": "balance", "compareType": "between", "compareValue": "0,8000"}]
WIDE_SQL = "c_acctbal BETWEEN 0 AND 8000"


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").select(
        F.col("c_custkey").alias("guid"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))


def history(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").withColumnsRenamed({"user_id": "guid"}).withColumn("event_pk", F.col("event_id"))


@query(f"SELECT c_custkey AS guid FROM customer WHERE {PROFILE_SQL}")
def profile_audience(spark: SparkSession, sf: str) -> DataFrame:
    return people.select_audience(profiles(spark, sf), PROFILE)


@query(f"""
    SELECT CASE WHEN c_custkey > 0 THEN 1 + (c_custkey - 1) // 32768 ELSE c_custkey // 32768 END AS bucket,
           count(*) AS members FROM customer WHERE {WIDE_SQL} GROUP BY 1""")
def audience_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    bitmaps = people.to_bitmaps(people.select_audience(profiles(spark, sf), WIDE_PROFILE))
    return people.bitmap_members(bitmaps)


VIEWED = EventSpec("view", (Attribute("k", ">=", "30"),), "2024-01-05 00:00:00", "2024-01-25 00:00:00")


@query(f"""
    SELECT user_id AS guid, count(*) AS action_count FROM events
    WHERE event_type = 'view' AND json_extract_string(props, '$.k') >= '30'
      AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'
      AND user_id IN (SELECT c_custkey FROM customer WHERE {WIDE_SQL})
    GROUP BY 1""")
def action_count_history(spark: SparkSession, sf: str) -> DataFrame:
    chosen = people.select_audience(profiles(spark, sf), WIDE_PROFILE)
    return people.action_counts(history(spark, sf), chosen, VIEWED, COLUMNS)


STEPS = [EventSpec("view"), EventSpec("click"), EventSpec("purchase")]


def stepping(events: DataFrame) -> DataFrame:
    hits = sequences.step_hits([event_flag(s, COLUMNS) for s in STEPS])
    return events.select("guid", F.col("ts").alias("match_time"), "event_pk", hits.alias("hits"))


def _walk(source: str, hit: str) -> str:
    return f"""
    WITH RECURSIVE numbered AS (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM ({source})),
    walk AS (
        SELECT user_id, CAST(0 AS BIGINT) AS rn, 0 AS step, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS event_id
        FROM (SELECT DISTINCT user_id FROM numbered)
        UNION ALL
        SELECT w.user_id, m.rn, CASE WHEN NOT {hit} THEN w.step WHEN w.step = 2 THEN 0 ELSE w.step + 1 END,
               CASE WHEN {hit} AND w.step = 2 THEN w.n + 1 ELSE w.n END, m.event_id
        FROM walk w JOIN numbered m ON m.user_id = w.user_id AND m.rn = w.rn + 1)"""


HIT = "(m.event_type = CASE w.step WHEN 0 THEN 'view' WHEN 1 THEN 'click' ELSE 'purchase' END)"
STEPPING_SQL = "SELECT * FROM events WHERE event_type IN ('view', 'click', 'purchase')"


@query(_walk(STEPPING_SQL, HIT) + """
    SELECT user_id AS guid, step, n FROM walk
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) = 1""")
def sequence_history(spark: SparkSession, sf: str) -> DataFrame:
    events = history(spark, sf).where(event_ids(STEPS, COLUMNS))
    return sequences.sequence_state(stepping(events), ["guid"], ORDER, 3)


@query("""
    SELECT user_id AS guid, event_id, event_type,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position
    FROM events WHERE event_type IN ('view', 'click', 'purchase')""")
def matched_events(spark: SparkSession, sf: str) -> DataFrame:
    """Every user's matching events (any step), in order of time."""
    events = history(spark, sf).where(event_ids(STEPS, COLUMNS))
    listed = sequences.ordered_matches(events, ["guid"], ["ts", "event_pk"], ["event_type"])
    return listed.select("guid", F.col("event_pk").alias("event_id"), "event_type", "position")


SEQUENCE_PROGRESS = _walk("SELECT * FROM events", HIT) + "SELECT event_id, user_id AS guid, step, n FROM walk WHERE rn > 0"


@query(SEQUENCE_PROGRESS)
def sequence_progress(spark: SparkSession, sf: str) -> DataFrame:
    walked = sequences.sequence_progress(stepping(history(spark, sf)), ["guid"], ORDER, 3)
    return walked.select(F.col("event_pk").alias("event_id"), "guid", "step", "n")


# Rules --------------------------------------------------------------------------------


def _event(event: str, count: int = 0, condition: int = 0, window: tuple = (), **attributes: str) -> dict:
    spec = {
        "eventId": event, "eventCount": count, "conditionId": condition,
        "attributeParams": [
            {"attributeName": n, "compareType": v[:2] if v[1] == "=" else v[0], "compareValue": v.lstrip("<>=")}
            for n, v in attributes.items()
        ],
    }
    if window:
        spec["windowStart"], spec["windowEnd"] = window
    return spec


# The keys of the rule format; ids, attributes and numbers are of these queries.
RULE_1 = json.dumps({
    "ruleModelId": "1", "ruleId": "M1-R1",
    "triggerEvent": _event("purchase"),
    "profileCondition": WIDE_PROFILE,
    "actionCountCondition": {
        "eventParams": [
            _event("view", 2, 1, ("2024-01-03 00:00:00", "2024-01-28 00:00:00"), k=">=30"),
            _event("click", 3, 2),
            _event("error", 5, 3, k="<50"),
        ],
        "combineExpr": "res_1 && (res_2 || res_3)",
    },
})
RULE_2 = json.dumps({
    "ruleModelId": "2", "ruleId": "M2-R1",
    "triggerEvent": _event("purchase"),
    "profileCondition": WIDE_PROFILE,
    "actionCountCondition": {
        "eventParams": [_event("view", 2, 1, (), k=">=30"), _event("click", 3, 2)],
        "combineExpr": "res_1 && res_2",
    },
    "actionSequenceCondition": {
        "eventParams": [_event("view"), _event("click"), _event("purchase")],
        "conditionId": 4, "sequenceCount": 3,
    },
    "combineExpr": "res_0 && res_1", "maxMatchCount": 2,
})


def rules() -> list[rule_ops.Rule]:
    return [rule_ops.Rule.parse(RULE_1), rule_ops.Rule.parse(RULE_2)]


def rule_audience(spark: SparkSession, sf: str, which: list[rule_ops.Rule]) -> DataFrame:
    return rule_publication.audience_of(which, profiles(spark, sf))


K = "json_extract_string(props, '$.k')"
R1_C1 = (f"(event_type = 'view' AND {K} >= '30' AND ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-28')")
R1_C2, R1_C3 = "(event_type = 'click')", f"(event_type = 'error' AND {K} < '50')"
R2_C1, R2_C2 = f"(event_type = 'view' AND {K} >= '30')", "(event_type = 'click')"
ALL_CONDITIONS = [("M1-R1", 1, R1_C1), ("M1-R1", 2, R1_C2), ("M1-R1", 3, R1_C3),
                  ("M2-R1", 1, R2_C1), ("M2-R1", 2, R2_C2)]
FANOUT_SQL = " UNION ALL ".join(
    f"SELECT '{r}' AS rule_id, {c} AS condition_id, event_id, user_id AS guid, ts FROM events WHERE {test}"
    for r, c, test in ALL_CONDITIONS)


def conditions_met(spark: SparkSession, sf: str) -> DataFrame:
    conditions = spark.createDataFrame(rule_ops.conditions_of(rules()), rule_ops.CONDITIONS_SCHEMA)
    events = load(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("guid"), "ts", "event_type",
        F.from_json("props", "map<string,string>").alias("properties"))
    return rule_ops.match_conditions(events, rule_ops.hinted(conditions, conditions.count()), "event_type", "ts", "properties")


@query(f"SELECT rule_id, condition_id, event_id FROM ({FANOUT_SQL})")
def rule_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return conditions_met(spark, sf).select("rule_id", "condition_id", "event_id")


@query(f"""
    SELECT rule_id, condition_id, guid, event_id, row_number() OVER (
        PARTITION BY rule_id, condition_id, guid ORDER BY ts, event_id) AS n FROM ({FANOUT_SQL})""")
def rule_counters(spark: SparkSession, sf: str) -> DataFrame:
    counted = running(conditions_met(spark, sf), ["rule_id", "condition_id", "guid"], ["ts", "event_id"],
                      {"n": running_count()})
    return counted.select("rule_id", "condition_id", "guid", "event_id", "n")


def _counted(test: str, name: str) -> str:
    return (f"sum(CASE WHEN {test} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id"
            f" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {name}")


MODEL_1 = f"""
    SELECT 'M1-R1' AS rule_id, user_id AS guid, strftime(ts, '%Y-%m-%d %H:%M:%S') AS match_time, event_id FROM (
        SELECT *, {_counted(R1_C1, 'c1')}, {_counted(R1_C2, 'c2')}, {_counted(R1_C3, 'c3')} FROM events
        WHERE user_id IN (SELECT c_custkey FROM customer WHERE {WIDE_SQL}))
    WHERE event_type = 'purchase' AND c1 >= 2 AND (c2 >= 3 OR c3 >= 5)"""


def matches(spark: SparkSession, sf: str, which: list[rule_ops.Rule]) -> DataFrame:
    found = rule_ops.match_rules(history(spark, sf), which, rule_audience(spark, sf, which), COLUMNS, ["event_pk"])
    return found.select("rule_id", "guid", text(F.col("match_time")).alias("match_time"),
                        F.col("event_pk").alias("event_id"))


@query(MODEL_1)
def rule_model1_matches(spark: SparkSession, sf: str) -> DataFrame:
    return matches(spark, sf, rules()[:1])


MODEL_2 = _walk("SELECT * FROM events", HIT) + f""",
    counted AS (
        SELECT *, {_counted(R2_C1, 'c1')}, {_counted(R2_C2, 'c2')} FROM events
        WHERE user_id IN (SELECT c_custkey FROM customer WHERE {WIDE_SQL}))
    SELECT 'M2-R1' AS rule_id, c.user_id AS guid, strftime(c.ts, '%Y-%m-%d %H:%M:%S') AS match_time, c.event_id
    FROM counted c JOIN walk w ON w.event_id = c.event_id
    WHERE c.event_type = 'purchase' AND c1 >= 2 AND c2 >= 3 AND w.n >= 3
    QUALIFY row_number() OVER (PARTITION BY c.user_id ORDER BY c.ts, c.event_id) <= 2"""


@query(MODEL_2)
def rule_model2_matches(spark: SparkSession, sf: str) -> DataFrame:
    return matches(spark, sf, rules()[1:])


@query("""
    WITH people AS (SELECT c_custkey, 'N' || c_nationkey || '-' || c_mktsegment AS rule_id, 1 + c_nationkey % 5 AS least FROM customer),
    counted AS (
        SELECT *, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS views FROM events)
    SELECT rule_id, user_id AS guid, event_id FROM counted JOIN people ON user_id = c_custkey
    WHERE event_type = 'purchase' AND views >= least""")
def rule_many_matches(spark: SparkSession, sf: str) -> DataFrame:
    """A rule for each nation and segment of the customers, over a hundred of them."""
    people_of = load(spark, sf, "customer").select(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string"), F.lit("-"), F.col("c_mktsegment")).alias("rule_id"),
        F.col("c_custkey").alias("guid"), "c_nationkey")
    groups = people_of.select("rule_id", "c_nationkey").distinct().orderBy("rule_id").collect()
    which = [rule_ops.Rule.parse(json.dumps({
        "ruleModelId": "1", "ruleId": g["rule_id"], "triggerEvent": _event("purchase"),
        "actionCountCondition": {"eventParams": [_event("view", 1 + g["c_nationkey"] % 5, 1, ())], "combineExpr": "res_1"},
    })) for g in groups]
    found = rule_ops.match_rules(history(spark, sf), which, people_of.select("rule_id", "guid"), COLUMNS, ["event_pk"])
    return found.select("rule_id", "guid", F.col("event_pk").alias("event_id"))


CUTOFF = "2024-01-15 00:00:00"


@query(_walk("SELECT * FROM events", HIT) + f""",
    counted AS (
        SELECT *, {_counted(R2_C1, 'c1')}, {_counted(R2_C2, 'c2')} FROM events
        WHERE user_id IN (SELECT c_custkey FROM customer WHERE {WIDE_SQL}))
    SELECT c.user_id AS guid, c.event_id, CAST(c1 AS BIGINT) AS count_1, CAST(c2 AS BIGINT) AS count_2,
           w.n AS sequences
    FROM counted c JOIN walk w ON w.event_id = c.event_id
    WHERE c.ts >= TIMESTAMP '{CUTOFF}' AND ({R2_C1} OR c.event_type IN ('view', 'click', 'purchase'))""")
def rule_baseline_handoff(spark: SparkSession, sf: str) -> DataFrame:
    """History before the cutoff as baselines, live events counted on from them."""
    which, events = rules()[1:], history(spark, sf)
    chosen = rule_audience(spark, sf, which)
    cutoff = F.lit(CUTOFF).cast("timestamp_ntz")
    start = rule_ops.baselines(events.where(F.col("ts") < cutoff), which, chosen, COLUMNS, ["event_pk"])
    live = rule_ops.fan_out(events.where(F.col("ts") >= cutoff), which, chosen, COLUMNS, ["event_pk"])
    progress = rule_ops.rule_progress(live, which, ["event_pk"], start)
    return progress.select("guid", F.col("event_pk").alias("event_id"), F.col("count_0").alias("count_1"),
                           F.col("count_1").alias("count_2"), "sequences")


@query("""
    SELECT 'R' || o_custkey AS rule_id, CAST(o_orderkey AS VARCHAR) AS rule_desc,
           CASE o_orderstatus WHEN 'O' THEN 'INSERT' ELSE 'UPDATE_AFTER' END AS operation
    FROM (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW')
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
        AND o_orderstatus <> 'F'""")
def rule_changelog_state(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as edits of one rule per customer; low priority ones are before-images."""
    status = F.col("o_orderstatus")
    kind = (F.when(F.col("o_orderpriority") == "5-LOW", "UPDATE_BEFORE").when(status == "O", "INSERT")
            .when(status == "P", "UPDATE_AFTER").otherwise("DELETE"))
    image = F.to_json(F.struct(
        F.concat(F.lit("R"), F.col("o_custkey").cast("string")).alias("rule_id"),
        F.col("o_orderkey").cast("string").alias("rule_desc"), F.col("o_orderkey").alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("changed")))
    changes = load(spark, sf, "orders").select(
        kind.alias("operation"), F.from_json(image, "map<string,string>").alias("after"))
    typed = changelog_view(changes, "rule_info", {
        "rule_id": "string", "rule_desc": "string", "id": "bigint", "changed": "date"})
    return rule_ops.live_rules(typed.where(F.col("id") >= 0), ["changed", "id"]).select(
        "rule_id", "rule_desc", "operation")


@query(f"""
    WITH people AS (SELECT c_custkey AS guid FROM customer WHERE {WIDE_SQL}),
    early AS (SELECT * FROM events WHERE ts < TIMESTAMP '{CUTOFF}' AND user_id IN (SELECT guid FROM people)),
    counted AS (
        SELECT 'M1-R1' AS rule_id, user_id AS guid, [count(*) FILTER ({R1_C1}), count(*) FILTER ({R1_C2}), count(*) FILTER ({R1_C3})] AS n
        FROM early GROUP BY user_id
        UNION ALL SELECT 'M2-R1', user_id, [count(*) FILTER ({R2_C1}), count(*) FILTER ({R2_C2}), 0] FROM early GROUP BY user_id),
    rules AS (SELECT * FROM (VALUES ('M1-R1', '1'), ('M2-R1', '2')) AS t(rule_id, rule_model_id))
    SELECT rule_id, rule_model_id, (SELECT count(*) FROM people) AS audience, CAST(sum(n[1]) AS BIGINT) AS first_counts,
           CAST(sum(n[2]) AS BIGINT) AS second_counts, CAST(sum(n[3]) AS BIGINT) AS third_counts
    FROM rules JOIN counted USING (rule_id) GROUP BY rule_id, rule_model_id""")
def rule_published(spark: SparkSession, sf: str) -> DataFrame:
    """Two rules published: metadata, audience and history baselines as they are stored."""
    store = rule_publication.RuleStore(spark, scratch_path(spark, "published"))
    for model in ("1", "2"):
        store.add_model(model, f"model {model}", 1)
    cutoff = F.lit(CUTOFF).cast("timestamp_ntz")
    rule_publication.publish(store, [RULE_1, RULE_2], profiles(spark, sf), history(spark, sf), COLUMNS, ["event_pk"], cutoff)
    stored = store.rules_of("1").unionByName(store.rules_of("2")).join(store.audience_sizes(), "rule_id")
    counts = store.baselines().groupBy("rule_id").agg(*[
        F.coalesce(F.sum(F.get("base_counts", F.lit(i))), F.lit(0)).alias(n) for i, n in enumerate(("first_counts", "second_counts", "third_counts"))])
    return stored.join(counts, "rule_id").select("rule_id", "rule_model_id", "audience", "first_counts", "second_counts", "third_counts")


ALGEBRA = "c_acctbal BETWEEN 0 AND 8000 AND c_nationkey >= 5 AND NOT (c_mktsegment = 'BUILDING')"


def _algebra(spark: SparkSession, sf: str) -> DataFrame:
    """Those of two rules' audiences and not of a third one's, from stored containers."""
    path = scratch_path(spark, "audiences")
    conditions = {"wide": WIDE_PROFILE, "far": PROFILE[2:], "builders": PROFILE[1:2]}
    for name, profile in conditions.items():
        bitmaps.to_containers(people.select_audience(profiles(spark, sf), profile)).write.parquet(f"{path}/{name}")
    wide, far, builders = (spark.read.parquet(f"{path}/{name}") for name in conditions)
    return bitmaps.combine(bitmaps.combine(wide, far, "and"), builders, "and not")


@query(f"SELECT c_custkey AS guid FROM customer WHERE {ALGEBRA}")
def audience_algebra(spark: SparkSession, sf: str) -> DataFrame:
    return bitmaps.members_of(_algebra(spark, sf))


@query(f"SELECT event_id, user_id AS guid FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE {ALGEBRA})")
def audience_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events of an audience's members, which are probed in its containers."""
    rows = history(spark, sf).select(F.col("event_pk").alias("event_id"), "guid")
    return bitmaps.only_members(rows, _algebra(spark, sf))
