"""Rule matching by audience and event id first, against a plain reading of every rule."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brooklet.functions.predicates import Attribute, EventColumns, EventSpec
from brooklet.operators.rules import Rule, fan_out, match_rules, rule_index

BASE = datetime(2024, 1, 1)
COLUMNS = EventColumns("kind", "at", lambda name: F.col(name))
SCHEMA = "guid long, at timestamp, pk long, kind string, color string, size string"
COMPARE = {"=": lambda a, b: a == b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b}


def spec(draw, count=0, condition=0):
    attributes = tuple(Attribute(*draw.choice([("color", "=", "red"), ("size", ">=", "5"), ("size", "<", "7"), ("missing_color", "=", "x")][:3]))
                       for _ in range(draw.choice([0, 0, 1, 2])))
    window = ("2024-01-01 00:10:00", "2024-01-01 02:00:00") if draw.random() < 0.3 else (None, None)
    return EventSpec(draw.choice(["a", "b", "c", None]), attributes, *window, count, condition)


def rule(draw, i):
    counts = tuple(spec(draw, draw.randrange(3), n) for n in range(draw.choice([0, 1, 2])))
    trigger = None if draw.random() < 0.2 else spec(draw)
    return Rule(f"r{i}", "1", trigger, (), counts, " && ".join(f"res_{c.condition_id}" for c in counts))


def events(draw, users, n):
    return [(draw.choice([*range(users), None]), BASE + timedelta(minutes=i), i, draw.choice(["a", "b", "c", "d", None]),
             draw.choice(["red", "blue", None]), draw.choice(["1", "5", "9", None])) for i in range(n)]


def met(s, row):
    _, at, _, kind, color, size = row
    values = {"color": color, "size": size}
    if s.event_id is not None and kind != s.event_id:
        return False
    if s.window_start and not datetime.fromisoformat(s.window_start) <= at <= datetime.fromisoformat(s.window_end):
        return False
    return all(values[a.name] is not None and COMPARE[a.compare](values[a.name], a.value) for a in s.attributes)


def brute(rows, rules, audience):
    out = []
    for r in rules:
        for guid in {g for i, g in audience if i == r.rule_id}:
            counted = [0] * len(r.counts)
            for row in sorted((e for e in rows if e[0] == guid), key=lambda e: e[2]):
                counted = [c + met(s, row) for c, s in zip(counted, r.counts)]
                if (r.trigger is None or met(r.trigger, row)) and all(c >= s.event_count for c, s in zip(counted, r.counts)):
                    out.append((r.rule_id, guid, row[2]))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_rule(spark, seed):
    draw = random.Random(seed)
    rows, rules = events(draw, 5, 120), [rule(draw, i) for i in range(25)]
    audience = [(r.rule_id, g) for r in rules for g in range(5) if draw.random() < 0.5] + [("nobody's", 1), ("r1", 2), ("r1", 2)]
    found = match_rules(spark.createDataFrame(rows, SCHEMA), rules, spark.createDataFrame(audience, "rule_id string, guid long"), COLUMNS, ["pk"])
    assert sorted((r["rule_id"], r["guid"], r["pk"]) for r in found.collect()) == brute(rows, rules, audience)


def test_ten_thousand_rules_cost_what_their_audience_does(spark):
    """Each user is in one rule of 10,000, so events fan out to one row at most."""
    n = 10_000
    rules = [Rule(f"r{i}", "1", EventSpec("a"), (), (EventSpec("b", (Attribute("size", ">=", str(i % 10)),), None, None, 1, 1),), "res_1") for i in range(n)]
    audience = spark.range(n).select(F.concat(F.lit("r"), "id").alias("rule_id"), F.col("id").alias("guid"))
    rows = spark.range(40_000).select(
        (F.col("id") % n).alias("guid"), (F.lit(BASE) + F.make_interval(secs=F.col("id").cast("int"))).cast("timestamp").alias("at"), F.col("id").alias("pk"),
        F.when(F.col("id") < 2 * n, "b").otherwise("a").alias("kind"), F.lit(None).cast("string").alias("color"),
        (F.floor(F.col("id") / n) * 4 + 1).cast("string").alias("size"))
    assert fan_out(rows, rules, audience, COLUMNS, ["pk"]).count() <= 40_000
    found = match_rules(rows, rules, audience, COLUMNS, ["pk"])
    # Sizes are 1 and 5: rules that want at most 5 count, and each is decided at two events.
    assert found.count() == 2 * sum(str(i % 10) <= "5" for i in range(n))


def test_conditions_of_no_event_id_are_kept_apart(spark):
    rules = [Rule("r", "1", None, (), (EventSpec("a"), EventSpec(None)), "res_0"), Rule("s", "1", EventSpec("b"), (), (EventSpec("b"),), "res_0")]
    table, held, others = rule_index(spark, rules)
    listed = {(r["rule_id"], r["on_event"]): len(r["conditions"]) for r in table.collect()}
    assert listed == {("r", "a"): 3, ("r", None): 2, ("s", "b"): 2} and held == 7 and others
