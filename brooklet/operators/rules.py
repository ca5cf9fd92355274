"""Marketing rules: definitions, counters, matches and history baselines.

All rules are evaluated in one pass, as rows of a table. An event becomes one row per rule it
matters to, with the rule's conditions as boolean arrays; running counters are kept per (rule, user).
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.functions.predicates import EventColumns, EventSpec, combine_results, event_ids
from brooklet.operators.ordered import BLOCK_ROWS, Splits, find_splits, running, running_count, running_sum
from brooklet.operators.sequences import sequence_progress, sequence_state
from brooklet.sources.changelog import current_state

RULE_KEY = ["rule_id", "guid"]


@dataclass(frozen=True)
class Rule:
    rule_id: str
    model_id: str
    trigger: EventSpec | None
    profile: tuple[dict, ...]
    counts: tuple[EventSpec, ...]
    count_expression: str
    sequence: tuple[EventSpec, ...] = ()
    sequence_condition: int = 0
    sequence_count: int = 0
    expression: str = "res_0"
    max_matches: int | None = None

    @classmethod
    def parse(cls, text: str) -> Rule:
        """From rule JSON. Model 1 has no sequence and no cap."""
        rule = json.loads(text)
        counts = rule.get("actionCountCondition") or {}
        sequence = rule.get("actionSequenceCondition") or {}
        specs = tuple(EventSpec.parse(e) for e in counts.get("eventParams") or [])
        cap = rule.get("maxMatchCount", rule.get("max_match_count")) if sequence else None
        default = " && ".join(f"res_{s.condition_id}" for s in specs)
        trigger = rule.get("triggerEvent")
        return cls(
            rule_id=rule["ruleId"], model_id=rule["ruleModelId"],
            trigger=EventSpec.parse(trigger) if trigger else None,
            profile=tuple(rule.get("profileCondition") or ()),
            counts=specs, count_expression=counts.get("combineExpr") or default,
            sequence=tuple(EventSpec.parse(e, sequence) for e in sequence.get("eventParams") or []),
            sequence_condition=int(sequence.get("conditionId") or 0),
            sequence_count=int(sequence.get("sequenceCount") or 0),
            expression=(rule.get("combineExpr") or "res_0 && res_1") if sequence else "res_0",
            max_matches=None if cap is None else int(cap),
        )


def in_time(order: list[str]) -> list[str]:
    """Rows of fan-out are ordered by time first, whatever else makes the order unique."""
    return ["match_time", *[c for c in order if c != "match_time"]]


# Fan-out ------------------------------------------------------------------------------


def conditions_of(rules: list[Rule]) -> list[tuple]:
    """All count conditions as rows (rule_id, condition_id, event_id, from, to, attributes)."""
    return [
        (r.rule_id, s.condition_id, s.event_id, s.window_start, s.window_end,
         [(a.name, a.compare, a.value) for a in s.attributes])
        for r in rules for s in r.counts
    ]


CONDITIONS_SCHEMA = (
    "rule_id STRING, condition_id INT, event_id STRING, window_start STRING, window_end STRING,"
    " attributes ARRAY<STRUCT<name: STRING, compare: STRING, value: STRING>>"
)


def attributes_hold(attributes: Column, properties: Column) -> Column:
    """Every attribute condition holds on the property map; a missing property fails."""

    def holds(a: Column) -> Column:
        actual = F.try_element_at(properties, a["name"])
        test = (
            F.when(a["compare"] == "=", actual == a["value"]).when(a["compare"] == ">", actual > a["value"])
            .when(a["compare"] == "<", actual < a["value"]).when(a["compare"] == ">=", actual >= a["value"])
            .when(a["compare"] == "<=", actual <= a["value"])
        )
        return F.coalesce(test, F.lit(False))

    return F.forall(attributes, holds)


def match_conditions(
    events: DataFrame, conditions: DataFrame, event_id: str, time: str, properties: str
) -> DataFrame:
    """Each event with every rule condition it meets, the conditions being a table.

    ``conditions`` comes from compiled rules or from the current state of a rule changelog.
    """
    c = conditions.withColumnRenamed("event_id", "_event_id")
    start, end = (F.col(x).cast("timestamp_ntz") for x in ("window_start", "window_end"))
    meets = (
        (F.col(event_id) == F.col("_event_id"))
        & (start.isNull() | (F.col(time) >= start)) & (end.isNull() | (F.col(time) <= end))
    )
    matched = events.join(c, meets).where(attributes_hold(F.col("attributes"), F.col(properties)))
    return matched.drop("_event_id", "window_start", "window_end", "attributes")


CONDITION = (
    "STRUCT<role: STRING, i: INT, since: TIMESTAMP_NTZ, until: TIMESTAMP_NTZ,"
    " attributes: ARRAY<STRUCT<name: STRING, compare: STRING, value: STRING>>>")
RULE_INDEX = f"rule_id STRING, on_event STRING, counts INT, steps INT, named ARRAY<STRING>, conditions ARRAY<{CONDITION}>"
#: Up to so many conditions or rules, which are counted here, their table goes to every task.
HINTED_RULES = 50_000


def hinted(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= HINTED_RULES else table


def rule_index(spark: SparkSession, rules: list[Rule]) -> tuple[DataFrame, int, bool]:
    """The conditions of all rules by event id: one row per rule and id that it names, with all conditions
    an event of that id may meet, and one with a null id for those that events of other ids may meet.

    A condition is a count (``c``), a sequence step (``s``) or the trigger (``t``) of its rule; a rule
    without a trigger is decided at every event. Also gives the number of conditions in the table, and
    whether there are any for other ids.
    """
    def moment(text: str | None) -> datetime | None:
        return datetime.fromisoformat(text) if text else None

    rows, held = [], 0
    for rule in rules:
        specs = [("t", 0, rule.trigger or EventSpec(None))]
        specs += [("c", i, s) for i, s in enumerate(rule.counts)] + [("s", i, s) for i, s in enumerate(rule.sequence)]
        named = sorted({s.event_id for _, _, s in specs if s.event_id is not None})
        always = any(s.event_id is None for _, _, s in specs)
        for event in [*named, *([None] if always else [])]:
            listed = [
                (role, i, moment(s.window_start), moment(s.window_end), [(a.name, a.compare, a.value) for a in s.attributes])
                for role, i, s in specs if s.event_id is None or s.event_id == event]
            rows.append((rule.rule_id, event, len(rule.counts), len(rule.sequence), named if event is None else None, listed))
            held += len(listed)
    return spark.createDataFrame(rows, RULE_INDEX), held, any(r[1] is None for r in rows)


def fan_out(events: DataFrame, rules: list[Rule], audience: DataFrame, columns: EventColumns, order: list[str]) -> DataFrame:
    """One row per event and rule it matters to, for users in the rule's audience ``(rule_id, guid)``.

    ``hits`` has one flag per count condition, ``steps`` one per sequence step, and
    ``is_trigger`` tells whether the rule is to be decided at this event.

    The audience comes first: it meets the rules' event ids, and events meet what their user is in by
    user and event id at once. So an event becomes as many rows as its user's rules look at its id,
    however many rules there are, and tests the conditions of these alone. Rules are rows of a table, so
    the plan has one size. There is no aggregate, so streams take this path as well.
    """
    specs = [s for r in rules for s in (r.trigger or EventSpec(None), *r.counts, *r.sequence)]
    names = sorted({a.name for s in specs for a in s.attributes})
    values = [c for name in names for c in (F.lit(name), columns.attribute(name))]
    properties = F.create_map(*values) if values else F.lit(None).cast("map<string,string>")
    unique = [c for c in order if c != "match_time"]
    rows = events.where(event_ids(specs, columns)).select(
        "guid", F.col(columns.time).alias("match_time"), *unique, F.col(columns.event_id).alias("_on"), properties.alias("_properties"))
    table, held, others = rule_index(events.sparkSession, rules)
    index = hinted(table, held)
    # The id itself; but that of a single rule is a constant, and would be taken out of the joins' keys as one.
    people = audience.select(F.explode(F.array("rule_id")).alias("rule_id"), "guid").distinct()

    wanted = people.join(hinted(table.where(F.col("on_event").isNotNull()).select("rule_id", F.col("on_event").alias("_on")), held), "rule_id")
    met = rows.join(wanted, ["guid", "_on"]).join(index.withColumn("_on", F.col("on_event")), ["rule_id", "_on"])
    if others:
        rest = index.where(F.col("on_event").isNull())
        unnamed = ~F.coalesce(F.array_contains("named", F.col("_on")), F.lit(False))
        met = met.unionByName(rows.join(people.join(hinted(table.where(F.col("on_event").isNull()).select("rule_id"), held), "rule_id"), "guid").join(
            rest, "rule_id").where(unnamed))

    time = F.col("match_time").cast("timestamp_ntz")

    def holds(c: Column) -> Column:
        inside = (c["since"].isNull() | (time >= c["since"])) & (c["until"].isNull() | (time <= c["until"]))
        return F.coalesce(inside, F.lit(False)) & attributes_hold(c["attributes"], F.col("_properties"))

    mine = met.select(
        "guid", "match_time", *unique, "rule_id", "counts", "steps", F.filter("conditions", holds).alias("_mine")).where(F.size("_mine") > 0)

    def flags(role: str, size: str) -> Column:
        places = F.transform(F.filter("_mine", lambda c: c["role"] == role), lambda c: c["i"])
        tests = F.transform(F.sequence(F.lit(1), F.col(size)), lambda n: F.array_contains(places, n - 1))
        return F.when(F.col(size) > 0, tests).otherwise(F.array().cast("array<boolean>"))

    return mine.select(
        "guid", "match_time", *unique, "rule_id", flags("c", "counts").alias("hits"), flags("s", "steps").alias("steps"),
        F.exists("_mine", lambda c: c["role"] == "t").alias("is_trigger"))


# Counters and matches -----------------------------------------------------------------


def baselines(
    history: DataFrame, rules: list[Rule], audience: DataFrame, columns: EventColumns, order: list[str],
) -> DataFrame:
    """Counts and sequence state per (rule, user) over history, for live matching to go on from.

    ``audience`` holds (rule_id, guid).
    """
    rows = fan_out(history, rules, audience, columns, order)
    order = in_time(order)
    size = max((len(r.counts) for r in rules), default=0)
    counted = rows.groupBy(*RULE_KEY).agg(F.array(*[
        F.sum(_flag("hits", i)) for i in range(size)
    ]).cast("array<bigint>").alias("base_counts"))
    longest = max((len(r.sequence) for r in rules), default=0)
    if not longest:
        return counted.withColumns({"base_step": F.lit(0), "base_sequences": F.lit(0).cast("bigint")})
    stepping = rows.where(F.exists("steps", lambda s: s)).select(*RULE_KEY, *order, F.col("steps").alias("hits"))
    state = sequence_state(stepping, RULE_KEY, order, longest).withColumnsRenamed(
        {"step": "base_step", "n": "base_sequences"}
    )
    return counted.join(state, RULE_KEY, "left").select(
        *RULE_KEY, "base_counts", F.coalesce("base_step", F.lit(0)).alias("base_step"),
        F.coalesce("base_sequences", F.lit(0)).cast("bigint").alias("base_sequences"),
    )


def _flag(array: str, index: int) -> Column:
    return F.coalesce(F.get(array, F.lit(index)), F.lit(False)).cast("bigint")


def rule_progress(
    rows: DataFrame, rules: list[Rule], order: list[str], start: DataFrame | None = None,
    splits: Splits | None = None,
) -> DataFrame:
    """Fan-out rows with ``count_i`` per condition, ``step`` and ``sequences``, after each
    event, in place of the flags.

    ``start`` is a table of baselines to count on from.
    """
    order = in_time(order)
    splits = splits or find_splits(rows, RULE_KEY, order)
    size = max((len(r.counts) for r in rules), default=0)
    longest = max((len(r.sequence) for r in rules), default=0)
    counters = {f"count_{i}": running_sum(_flag("hits", i)) for i in range(size)}
    out = running(rows, RULE_KEY, order, counters, splits=splits) if size else rows
    if start is not None:
        out = out.join(start, RULE_KEY, "left").withColumns({
            f"count_{i}": F.col(f"count_{i}") + F.coalesce(F.get("base_counts", F.lit(i)), F.lit(0))
            for i in range(size)
        })
    out = out.drop("hits", "base_counts")
    if longest:
        state = ("base_step", "base_sequences") if start is not None else None
        walked = sequence_progress(out.withColumnRenamed("steps", "hits"), RULE_KEY, order, longest, state, splits)
        out = walked.withColumnRenamed("n", "sequences")
    else:
        out = out.drop("steps").withColumns({"step": F.lit(0), "sequences": F.lit(0).cast("bigint")})
    return out.drop("base_step", "base_sequences")


def last_state(progress: DataFrame, order: list[str]) -> DataFrame:
    """The state of each (rule, user) after its last event, in the form of a baseline."""
    counters = sorted((c for c in progress.columns if c.startswith("count_")), key=lambda c: int(c[6:]))
    state = F.struct(
        F.array(*counters).cast("array<bigint>").alias("base_counts"), F.col("step").alias("base_step"),
        F.col("sequences").alias("base_sequences"))
    last = F.max_by(state, F.struct(*in_time(order))).alias("_state")
    return progress.groupBy(*RULE_KEY).agg(last).select(*RULE_KEY, "_state.*")


def _shape(rule: Rule) -> tuple[str, str]:
    """The rule's expressions with its count conditions named by place: alike in many rules."""
    places = {f"res_{c.condition_id}": f"_r{i}" for i, c in enumerate(rule.counts)}
    return re.sub(r"\w+", lambda w: places.get(w[0], w[0]), rule.count_expression), rule.expression


def verdicts(progress: DataFrame, rules: list[Rule]) -> DataFrame:
    """Trigger rows that meet their rule, with the rule's cap per user as ``_cap``.

    Thresholds and caps come from a table of the rules; an expression is evaluated once for all
    rules that combine their conditions in the same way.
    """
    shapes = sorted({_shape(rule) for rule in rules})
    size = max((len(r.counts) for r in rules), default=0)
    facts = progress.sparkSession.createDataFrame(
        [(r.rule_id, shapes.index(_shape(r)), [s.event_count for s in r.counts], r.sequence_count, r.max_matches) for r in rules],
        "rule_id STRING, _shape INT, _least ARRAY<BIGINT>, _sequences BIGINT, _cap BIGINT")
    rows = progress.where("is_trigger").join(hinted(facts, len(rules)), "rule_id")
    rows = rows.withColumns({f"_r{i}": F.coalesce(F.col(f"count_{i}") >= F.get("_least", F.lit(i)), F.lit(False)) for i in range(size)})
    results = {f"_r{i}": f"_r{i}" for i in range(size)}
    counted, verdict = None, None
    for number, (count_expression, _) in enumerate(shapes):
        test = combine_results(count_expression, results) if count_expression else F.lit(True)
        mine = F.col("_shape") == number
        counted = F.when(mine, test) if counted is None else counted.when(mine, test)
    rows = rows.withColumns({"_res_0": counted, "_res_1": F.col("sequences") >= F.col("_sequences")})
    for number, (_, expression) in enumerate(shapes):
        test, mine = combine_results(expression, {"res_0": "_res_0", "res_1": "_res_1"}), F.col("_shape") == number
        verdict = F.when(mine, test) if verdict is None else verdict.when(mine, test)
    working = {"hits", "steps", "is_trigger", "step", "sequences", "base_counts", "base_step", "base_sequences"}
    kept = [c for c in progress.columns if c not in working and not c.startswith("count_")]
    return rows.where(verdict).select(*kept, "_cap")


def decide(
    progress: DataFrame, rules: list[Rule], order: list[str], splits: Splits | None = None
) -> DataFrame:
    """Matches ``(rule_id, guid, match_time)``, up to each rule's cap per user."""
    matched = verdicts(progress, rules)
    if all(rule.max_matches is None for rule in rules):
        return matched.drop("_cap")
    numbered = running(matched, RULE_KEY, in_time(order), {"_match": running_count()}, splits=splits)
    return numbered.where(F.col("_cap").isNull() | (F.col("_match") <= F.col("_cap"))).drop("_cap", "_match")


def match_rules(
    events: DataFrame, rules: list[Rule], audience: DataFrame, columns: EventColumns, order: list[str],
    start: DataFrame | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """All rule matches of an event table: audience, counters, sequences, trigger, cap.

    Large keys are looked for once, in the fan-out rows; counters, sequences and cap share
    the cut points, as they share keys and order.
    """
    rows = fan_out(events, rules, audience, columns, order)
    order = in_time(order)
    splits = find_splits(rows, RULE_KEY, order, block_rows)
    return decide(rule_progress(rows, rules, order, start, splits), rules, order, splits)


def live_rules(changes: DataFrame, order: list[str]) -> DataFrame:
    """Rules in force: before-images ignored, updates replace, deletes remove."""
    images = changes.where(F.col("operation") != "UPDATE_BEFORE")
    return current_state(images, ["rule_id"], order)
