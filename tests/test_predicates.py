"""Rule conditions and rule expressions.

Fixed values: the keys of rule conditions. Attribute and page names are of these tests.
"""

import pytest
from pyspark.sql import functions as F

from brooklet.functions.predicates import (
    Attribute, EventColumns, EventSpec, combine_results, event_predicate, json_attribute, map_attribute,
    profile_predicate,
)


def events(spark):
    return spark.createDataFrame(
        [(1, "e1", "2023-07-01 12:00:00", {"shelf": "s-10"}), (2, "e1", "2023-07-30 12:00:01", {"shelf": "s-10"}),
         (3, "e1", "2023-07-15 00:00:00", {"shelf": "s-20"}), (4, "e1", "2023-07-15 00:00:00", {}),
         (5, "e2", "2023-07-15 00:00:00", {"shelf": "s-10"}), (6, "e1", "2023-07-30 12:00:00", {"shelf": "s-10"})],
        "id INT, event_id STRING, t STRING, properties MAP<STRING, STRING>",
    ).withColumn("event_time", F.to_timestamp_ntz("t"))


def hit(spark, spec, columns=None):
    rows = events(spark).withColumn("props", F.to_json("properties"))
    return [r.id for r in rows.where(event_predicate(spec, columns or EventColumns())).orderBy("id").collect()]


def test_event_window_is_inclusive_and_missing_attributes_fail(spark):
    spec = EventSpec.parse({
        "eventId": "e1", "windowStart": "2023-07-01 12:00:00", "windowEnd": "2023-07-30 12:00:00",
        "attributeParams": [{"attributeName": "shelf", "compareType": "=", "compareValue": "s-10"}]})
    assert hit(spark, spec) == [1, 6]
    assert hit(spark, spec, EventColumns(attribute=json_attribute("props"))) == [1, 6]


@pytest.mark.parametrize("compare, ids", [(">", [3]), ("<=", [1, 2, 5, 6]), (">=", [1, 2, 3, 5, 6]), ("<", [])])
def test_attributes_compare_as_text(spark, compare, ids):
    spec = EventSpec(None, (Attribute("shelf", compare, "s-10"),))
    assert hit(spark, spec, EventColumns(attribute=map_attribute("properties"))) == ids


def test_unknown_comparison_is_refused():
    with pytest.raises(ValueError):
        Attribute("shelf", "like", "x")


def profiles(spark):
    return spark.createDataFrame(
        [(1, 3, 87, "Big City", ["sports", "news"]), (2, 9, 12, "small city", ["sports"]), (3, 10, None, None, None)],
        "guid INT, tag01 INT, tag02 INT, tag03 STRING, tag04 ARRAY<STRING>")


@pytest.mark.parametrize("tag, compare, value, ids", [
    ("tag01", "lt", "10", [1, 2]), ("tag01", "gt", "9", [3]), ("tag01", "ge", "9", [2, 3]), ("tag01", "le", "9", [1, 2]),
    ("tag01", "between", "9,10", [2, 3]), ("tag01", "eq", "3", [1]), ("tag04", "match", "news", [1]),
    ("tag03", "match", "city", [1, 2]), ("tag02", "lt", "50", [2]),
])
def test_profile_conditions(spark, tag, compare, value, ids):
    rows = profiles(spark)
    condition = [{"tagId": tag, "compareType": compare, "compareValue": value}]
    assert [r.guid for r in rows.where(profile_predicate(condition, rows.schema)).orderBy("guid").collect()] == ids


def test_unknown_tag_is_refused(spark):
    with pytest.raises(ValueError):
        profile_predicate([{"tagId": "tg01", "compareType": "eq", "compareValue": "3"}], profiles(spark).schema)


def test_rule_expressions(spark):
    rows = spark.createDataFrame([(True, False, True)], "a BOOLEAN, b BOOLEAN, c BOOLEAN")
    names = {"res_1": "a", "res_2": "b", "res_3": "c"}
    for text, result in {
        "res_1 && (res_2 || res_3)": True, "res_1 && (res_2 && res_3)": False, "!res_2": True,
        "res_2 || res_1 && res_3": True, "!(res_1 || res_2)": False,
    }.items():
        assert rows.select(combine_results(text, names)).first()[0] is result, text


@pytest.mark.parametrize("text", ["res_9", "res_1 && 1=1", "res_1; drop", "sleep(1)", "", "res_1 & res_2", "a"])
def test_other_expressions_are_refused(text):
    with pytest.raises(ValueError):
        combine_results(text, {"res_1": "a", "res_2": "b"})
