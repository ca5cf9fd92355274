"""Inputs that the given tables do not have: folders of part files, nulls, old rows, shuffled ids, replays."""

import json

import pytest
from pyspark.sql import functions as F

from brooklet.catalog import jobs, rules as rule_queries
from brooklet.functions import user
from brooklet.operators import joins, rules as rule_ops, sequences, visits, windows
from brooklet.operators.changestate import KeyedTable, create_table_if_absent
from brooklet.plans import change_capture, change_routing, log_cleaning, order_wide
from brooklet.sources import topics
from brooklet.streaming import runner, stateful
from brooklet.tables import EVENTS_SCHEMA, load, stream


@pytest.mark.parametrize("files", [1, 4])
def test_streams_read_files_and_folders(spark, sf, tmp_path, files):
    events = load(spark, sf, "events")
    events.repartition(files).write.parquet(str(tmp_path / "events.parquet"))
    for folder in (sf, str(tmp_path)):
        rows = stream(spark, folder, "events", EVENTS_SCHEMA, files_per_trigger=1)
        assert runner.run_to_table(spark, rows, "folder").exceptAll(events).isEmpty()
        assert runner.run_to_table(spark, rows, "folder").count() == events.count()


def test_sliding_windows_larger_than_a_stretch(spark):
    rows = spark.range(1, 26).select(F.lit(1).alias("k"), "id")
    for stretch in (3, 10, 1000):
        fired = windows.sliding_count_windows(rows, ["k"], ["id"], 10, 5, {"n": F.count("id")}, stretch_rows=stretch)
        assert [r["n"] for r in fired.orderBy("window_no").collect()] == [5, 10, 10, 10, 10]


@pytest.mark.parametrize("small_rows", [0, 10_000])
def test_null_keys_and_times_match_no_version(spark, small_rows):
    left = spark.createDataFrame([(1, 5, 1), (None, 5, 2), (1, None, 3), (2, 9, 4), (1, 2, 5)], "k int, at int, id int")
    versions = spark.createDataFrame([(1, 3, 10, "a"), (None, 1, 11, "b"), (1, None, 12, "c"), (2, 9, 13, "d")], "k int, since int, vid int, name string")
    found = joins.asof_join(left, versions, ["k"], left_order=("at", "id"), version_order=("since", "vid"), small_rows=small_rows)
    assert {r["id"]: r["name"] for r in found.collect()} == {1: "a", 2: None, 3: None, 4: "d", 5: None}


def test_new_user_flags_of_null_devices_and_times(spark):
    rows = [(None, 1, 1, "1"), (None, 2, 2, "1"), (7, None, 3, "1"), (7, 5, 4, "1"), (7, 6, 5, "0"), (8, 1, 6, None)]
    df = spark.createDataFrame(rows, "mid int, ts int, offset int, is_new string")
    flags = {r["offset"]: r["is_new"] for r in visits.correct_new_flag(df, "mid", ["ts", "offset"]).collect()}
    assert flags == {1: "1", 2: "0", 3: "1", 4: "0", 5: "0", 6: None}


def test_user_aggregates_have_one_null_key(spark):
    count = user.Aggregate(
        create=lambda: (0,), add=lambda s, v: (s[0] + (v is None),), merge=lambda a, b: (a[0] + b[0],),
        result=lambda s: s, state="n BIGINT", output="n BIGINT")
    rows = [(None, float("nan"), None)] * 6 + [(2**60 + 1, 1.0, None), (2**60, 1.0, 3), (None, None, None)]
    df = spark.createDataFrame(rows, "k long, x double, v int").repartition(4)
    found = {(r["k"], str(r["x"])): r["n"] for r in user.aggregate(df, ["k", "x"], ["v"], count).collect()}
    assert found == {(None, "nan"): 6, (2**60 + 1, "1.0"): 1, (2**60, "1.0"): 0, (None, "None"): 1}


def test_null_is_greater_than_any_minimum(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, None), (1, 2, 5.0), (1, 3, None), (1, 4, 4.0), (2, 5, None)], "k int, id long, v double")
    rolled = {r["id"]: r["least"]["id"] for r in windows.running_argmin(rows, ["k"], ["id"], "v").collect()}
    assert rolled == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5}
    assert {r["k"]: r["id"] for r in windows.argmin(rows, ["k"], ["id"], "v").collect()} == {1: 4, 2: 5}
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    live = runner.run_to_table(spark, stateful.running_argmin(arriving, ["k"], ["id"], "v"), "argmin")
    assert {r["id"]: r["least_id"] for r in live.collect()} == rolled


@pytest.mark.parametrize("files", [1, 2])
def test_a_null_between_values_is_no_new_minimum(spark, tmp_path, files):
    rows = [(1, 1, 1.0), (1, 2, None), (1, 3, 5.0), (1, 4, 7.0), (2, 5, None), (2, 6, None), (2, 7, 3.0), (2, 8, 4.0)]
    parts = [rows] if files == 1 else [[r for r in rows if r[1] in (1, 2, 5)], [r for r in rows if r[1] not in (1, 2, 5)]]
    for n, part in enumerate(parts):
        spark.createDataFrame(part, "k int, id long, v double").coalesce(1).write.parquet(str(tmp_path / "in" / f"p{n}"))
    arriving = spark.readStream.schema("k int, id long, v double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    live = runner.run_to_table(spark, stateful.running_argmin(arriving, ["k"], ["id"], "v"), "argmin-nulls")
    assert {r["id"]: r["least_id"] for r in live.collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5, 7: 7, 8: 7}


def test_first_visits_of_old_days_are_kept(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "2024-03-08 10:00:00"), (2, "2024-03-08 11:00:00"), (3, "2024-03-01 09:00:00"), (1, "2024-03-08 09:00:00"), (1, "2024-03-07 01:00:00")],
        "mid int, at string").select("mid", F.col("at").cast("timestamp").alias("at"), F.lit(None).cast("string").alias("last"))
    for n, part in enumerate(rows.collect()):
        spark.createDataFrame([part], rows.schema).write.parquet(str(tmp_path / "in" / f"p{n}"))
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in/*"))
    first = runner.run_to_table(spark, stateful.first_visits(arriving, "mid", "at", visits.is_entry(F.col("last"))), "first")
    assert sorted((r["mid"], str(r["visit_date"])) for r in first.collect()) == [
        (1, "2024-03-07"), (1, "2024-03-08"), (2, "2024-03-08"), (3, "2024-03-01")]


def test_first_visits_out_of_time_order_count_once(spark, tmp_path):
    days = ["2024-03-20", "2024-03-01", "2024-03-21", "2024-03-01", "2024-01-05", "2024-03-01", "2024-01-05"]
    rows = spark.createDataFrame([(1, d) for d in days], "mid int, at string").select(
        "mid", F.col("at").cast("timestamp").alias("at"), F.lit(None).cast("string").alias("last"))
    for n, part in enumerate(rows.collect()):
        spark.createDataFrame([part], rows.schema).write.parquet(str(tmp_path / "in" / f"p{n}"))
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    first = runner.run_to_table(spark, stateful.first_visits(arriving, "mid", "at", visits.is_entry(F.col("last"))), "first-late")
    assert sorted(str(r["visit_date"]) for r in first.collect()) == sorted(set(days))


def test_sequences_of_more_than_64_steps(spark):
    hits = [[i == j for j in range(70)] for i in [64, 0, 1, 66]]
    rows = spark.createDataFrame([(1, n, h) for n, h in enumerate(hits)], "k int, id int, hits array<boolean>")
    for block_rows in (1, 10_000):
        walked = sequences.sequence_progress(rows, ["k"], ["id"], 70, block_rows=block_rows)
        assert [r["step"] for r in walked.orderBy("id").collect()] == [0, 1, 2, 2]
        assert sequences.sequence_state(rows, ["k"], ["id"], 70, block_rows).first()["step"] == 2


def test_rules_follow_time_and_not_ids(spark, sf):
    which = rule_queries.rules()
    events = rule_queries.history(spark, sf)
    audience = rule_queries.rule_audience(spark, sf, which)

    def found(df):
        matched = rule_ops.match_rules(df, which, audience, rule_queries.COLUMNS, ["event_pk"])
        return sorted((r["rule_id"], r["guid"], str(r["match_time"])) for r in matched.collect())

    shuffled = events.withColumn("event_pk", F.xxhash64("event_id"))
    assert found(events) == found(shuffled) and found(events)


def test_state_survives_rules_with_fewer_and_more_conditions(spark, tmp_path):
    schema = "rule_id string, guid long, match_time long, hits array<boolean>, steps array<boolean>"
    batches = [[("r", 1, 1, [True, True], [False, True, False])], [("r", 1, 2, [True, True, True], [True, False])], [("r", 1, 3, [True], [])]]
    path, out = str(tmp_path / "in"), []
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        arriving = spark.readStream.schema(schema).parquet(path)
        progress = stateful.rule_progress(arriving, ["rule_id", "guid"], ["match_time"], len(rows[0][3]))
        runner.start(progress, runner.parquet_batches(str(tmp_path / f"out{n}")), str(tmp_path / "cp")).awaitTermination()
        out.append(spark.read.parquet(str(tmp_path / f"out{n}" / "*")).orderBy("match_time").collect()[-1])
    assert [r["count_0"] for r in out] == [1, 2, 3]
    assert (out[1]["count_1"], out[1]["count_2"]) == (2, 1)


def test_replay_of_a_compacting_batch(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["at"], compact_every=2)
    for batch in (0, 1, 1, 2, 3, 3, 4, 5, 5):
        rows = spark.createDataFrame([(k, batch, f"v{batch}") for k in (batch, 0)], "k int, at int, v string")
        table.upsert(rows, batch)
        current = {r["k"]: r["v"] for r in table.read().collect()}
        assert current[0] == f"v{batch}" and len(current) == batch + 1
    assert table._complete("base") == [3, 5] and table._complete("delta") == [4, 5]
    assert table.read(before=5).count() == 5


def test_a_base_that_was_not_finished_is_not_read(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["at"], compact_every=2)
    rows = spark.createDataFrame([(1, 1)], "k int, at int")
    table.upsert(rows, 0)
    table.upsert(rows, 1)
    (tmp_path / "t/kind=base/upto=1/_SUCCESS").unlink()
    assert table.read().count() == 1
    table.upsert(rows, 1)
    assert table._complete("base") == [1] and table.read().count() == 1


def test_typed_ids_go_through_three_jobs(spark):
    raw = spark.createDataFrame([
        ("m.shop.order_info", "CREATE", None, '{"id":7,"user_id":3,"create_time":"2022-08-01 12:00:00","x":{"y":[1]}}'),
        ("m.shop.order_detail", "CREATE", None, '{"id":70,"order_id":7,"sku_id":5,"order_price":12.50,"create_time":"2022-08-01 12:00:01"}'),
    ], change_capture.RAW)
    envelopes = jobs.as_topic(change_capture.records(raw), F.monotonically_increasing_id(), F.col("value"))
    config = spark.createDataFrame(jobs.CONFIG, jobs.CONFIG_SCHEMA)
    facts = change_routing.route_changes(change_routing.parse_envelopes(envelopes), config).select("sink_table", F.to_json("after").alias("value"))
    orders = order_wide.parse_orders(facts.where("sink_table = 'dwd_order_info'")).first()
    details = order_wide.parse_details(facts.where("sink_table = 'dwd_order_detail'")).first()
    assert (orders["order_id"], orders["order"]["user_id"]) == (7, 3)
    assert (details["order_id"], details["detail"]["order_price"]) == (7, 12.5)


@pytest.mark.parametrize("limit", [0, 10_000])
def test_routing_with_few_and_many_configs(spark, monkeypatch, limit):
    monkeypatch.setattr(change_routing, "is_small", lambda df: limit > 0)
    changes = change_routing.parse_envelopes(spark.createDataFrame(
        [(n, json.dumps({"table": "t" if n % 2 else "u", "operation": "CREATE", "after": {"id": n, "b": 1}})) for n in range(100)], "offset long, value string"))
    config = spark.createDataFrame([("t", "CREATE", "kafka", "out", "id", None, None)], jobs.CONFIG_SCHEMA)
    routed = change_routing.route_changes(changes, config).select("offset", "sink_columns", F.to_json("after").alias("after")).collect()
    assert len(routed) == 100
    assert all((r["after"], r["sink_columns"]) == ((f'{{"id":{r["offset"]}}}', "id") if r["offset"] % 2 else (f'{{"b":1,"id":{r["offset"]}}}', None))
               or json.loads(r["after"]) == {"id": r["offset"], "b": 1} for r in routed)


def test_logs_keep_what_nobody_declared(spark):
    line = {"common": {"mid": "m", "is_new": "1", "extra": {"a": [1, None]}}, "page": {"page_id": "p", "during_time": "12"},
            "displays": [{"item": 5, "new": True}], "actions": [{"id": 1}], "ts": 5}
    lines = [json.dumps(line), json.dumps({**line, "ts": 6}), "[1]", "nope", '{"ts": 7}', '{"start": {"entry": "icon"}, "err": 1}']
    records = spark.createDataFrame(list(enumerate(lines)), "offset long, value string")
    out = {topic: sorted(r["value"] for r in rows.collect()) for topic, rows in log_cleaning.clean(records).items()}
    pages = [json.loads(v) for v in out["dwd_page_log"]]
    assert sorted(pages, key=lambda p: p["ts"]) == [line, {**line, "ts": 6, "common": {**line["common"], "is_new": "0"}}, {"ts": 7}]
    assert [json.loads(v) for v in out["dwd_display_log"]] == [{"item": 5, "new": True, "page_id": "p"}] * 2
    assert [json.loads(v) for v in out["dwd_start_log"]] == [{"start": {"entry": "icon"}, "err": 1}]
    assert out["dirty_log"] == ["[1]", "nope"]


def test_file_topics_from_the_latest_record(spark, tmp_path):
    folder = str(tmp_path / "topic")

    def send(values, batch_id):
        rows = spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)
        topics.write_batch_once(topics.to_records(rows, "t", F.col("value")), folder, batch_id)

    send(["old", "older"], 0)
    assert topics.read_topic(spark, "t", folder=folder, starting="latest", streaming=False).count() == 0
    later = topics.read_topic(spark, "t", folder=folder, starting="latest")
    send(["new"], 1)
    assert [r["value"] for r in runner.run_to_table(spark, later, "latest").collect()] == ["new"]


def test_table_extension_text(spark, tmp_path):
    create_table_if_absent(spark, "extended_t", "a,b", str(tmp_path / "x"), "id", "COMMENT 'routed' TBLPROPERTIES ('k'='v')")
    assert spark.catalog.getTable("extended_t").description == "routed"
    with pytest.raises(ValueError):
        create_table_if_absent(spark, "extended_u", "a", str(tmp_path / "y"), "id", "; DROP TABLE extended_t")
    spark.sql("DROP TABLE extended_t")


def test_null_keys_of_sequences(spark):
    """A null key goes on from row to row, next to keys that doubles cannot hold; whole and in blocks."""
    big = 2**53
    rows = [(k, i, [i % 2 == 0, i % 2 == 1]) for k in (None, 1, big, big + 1) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, at long, hits array<boolean>").repartition(3)
    for block_rows in (10**6, 10):
        walked = sequences.sequence_progress(df, ["k"], ["at"], 2, block_rows=block_rows).collect()
        assert {(r["k"], r["at"]): r["n"] for r in walked} == {(k, i): (i + 1) // 2 for k, i, _ in rows}
        final = sequences.sequence_state(df, ["k"], ["at"], 2, block_rows=block_rows).collect()
        assert {r["k"]: (r["step"], r["n"]) for r in final} == {k: (0, 20) for k in (None, 1, big, big + 1)}


def test_walks_in_one_go_equal_single_steps():
    """Counters and sequences of a stream's batch, against one row after the other."""
    import random

    import numpy as np
    import pandas as pd

    from brooklet.streaming.stateful import _flags, _walked

    draw = random.Random(3)
    for _ in range(200):
        length, rows = draw.randrange(4), draw.randrange(1, 12)
        lists = pd.Series([[draw.random() < 0.4 for _ in range(length)] for _ in range(rows)], dtype=object)
        step, n = draw.randrange(3), draw.randrange(5)
        done, last = _walked(lists, step, n)
        step = step if step < length else 0
        want = []
        for hits in lists:
            if length and hits[step]:
                step, n = (0, n + 1) if step == length - 1 else (step + 1, n)
            want.append((step, n))
        assert done == want and last == want[-1]
        assert _flags(lists, 2).tolist() == [[int(h[i]) if i < len(h) else 0 for i in range(2)] for h in lists]
    assert _flags(pd.Series([None, [True], np.array([False, True, True])]), 2).tolist() == [[0, 0], [1, 0], [0, 1]]
