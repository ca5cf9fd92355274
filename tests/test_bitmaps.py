"""Compressed sets of ids against Python's sets."""

import random

import pytest
from pyspark.sql import functions as F

from brooklet.operators import bitmaps

DRAW = random.Random(6)
SETS = {
    "few": {DRAW.randrange(-100_000, 100_000) for _ in range(300)},
    "runs": set(range(-5, 9_000)) | set(range(20_000, 70_000)),
    "half": {DRAW.randrange(60_000) for _ in range(50_000)},
    "ends": {1, 32_768, 32_769, 0, -1, -32_767, -32_768, 65_536},
    "none": set(),
}


@pytest.fixture(scope="module")
def stored(spark):
    def make(name):
        ids = [(i,) for i in SETS[name]] * (2 if name == "few" else 1) + [(None,)]
        return bitmaps.to_containers(spark.createDataFrame(ids, "guid long").repartition(3))

    return make


@pytest.mark.parametrize("name", list(SETS))
def test_members_come_back(spark, stored, name):
    containers = stored(name).cache()
    assert {r["guid"] for r in bitmaps.members_of(containers).collect()} == SETS[name]
    assert sum(r["members"] for r in containers.collect()) == len(SETS[name])
    asked = spark.createDataFrame([(i,) for i in [*range(-40_000, 70_000, 7), *SETS["ends"], None]], "guid long")
    found = {r["guid"] for r in bitmaps.only_members(asked, containers).collect()}
    assert found == {r["guid"] for r in asked.collect()} & SETS[name]


def test_every_kind_is_used(stored):
    kinds = {name: {r["kind"] for r in stored(name).collect()} for name in SETS}
    assert kinds["few"] == {"array"} and "runs" in kinds["runs"] and "bitmap" in kinds["half"]


@pytest.mark.parametrize("how", ["and", "or", "and not"])
def test_algebra(stored, how):
    for a, b in (("few", "runs"), ("half", "runs"), ("none", "few"), ("runs", "none")):
        want = {"and": SETS[a] & SETS[b], "or": SETS[a] | SETS[b], "and not": SETS[a] - SETS[b]}[how]
        assert {r["guid"] for r in bitmaps.members_of(bitmaps.combine(stored(a), stored(b), how)).collect()} == want


def test_sets_by_name(spark):
    members = spark.createDataFrame([("x", 1), ("x", 2), ("y", 2)], "rule_id string, guid long")
    containers = bitmaps.to_containers(members, of=["rule_id"])
    rows = spark.createDataFrame([("x", 2), ("y", 1), ("y", 2), (None, 1)], "rule_id string, guid long")
    assert sorted(tuple(r) for r in bitmaps.only_members(rows, containers, of=["rule_id"]).collect()) == [("x", 2), ("y", 2)]
    with pytest.raises(ValueError, match="unknown"):
        bitmaps.combine(containers, containers, "xor")
