"""Change capture: what is a row image, and what it costs."""

import json

from brooklet.plans import change_capture


def test_images_that_are_objects(spark):
    objects = ['{"a":1}', ' \t\r\n{"a": {"b": [1, null]}} ', "{}"]
    others = ['[{"a":1}]', '"{}"', "1", "null", "", "  ", "{", '{"a":}', '{"a":1', "{a}", "x{}", None]
    raw = spark.createDataFrame([("s.d.t", "CREATE", None, text) for text in objects + others], change_capture.RAW)
    values = [json.loads(r["value"]) for r in change_capture.records(raw).collect()]
    assert [v["after"] for v in values] == [json.loads(o) for o in objects] + [{}] * len(others)
    assert all((v["database"], v["table"], v["operation"], v["before"]) == ("d", "t", "CREATE", {}) for v in values)


def test_the_head_is_written_once(spark):
    """the head of an envelope was written three times, and the schema of every image was told."""
    raw = spark.createDataFrame([(None, None, None, "{}")], change_capture.RAW)
    out = change_capture.records(raw)
    assert [r["value"] for r in out.collect()] == ['{"before":{},"after":{}}']
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("structstojson") + plan.count("to_json") == 1
    assert "schemaofvariant" not in plan.replace("_", "")
