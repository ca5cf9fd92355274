"""The jobs, on tables and on streams, from topic to topic."""

import json

import pytest
from pyspark.sql import functions as F

from brooklet.catalog import rules as rule_queries
from brooklet.operators.changestate import KeyedTable
from brooklet.operators.rules import Rule, match_rules
from brooklet.plans import (
    change_capture, change_routing, log_cleaning, order_wide, page_visits, payment_wide, rule_matching,
    rule_publication,
)
from brooklet.plans.topic_sink import Broker
from brooklet.sources import changelog, files, topics
from brooklet.streaming import runner
from brooklet.tables import load
from tests.test_golden import LOGS


@pytest.fixture
def broker(tmp_path):
    return Broker(folder=str(tmp_path / "topics"))


def publish(spark, broker, topic, values, batch_id=0):
    rows = spark.createDataFrame([(v,) for v in values], "value STRING").coalesce(1)
    broker.write(topics.to_records(rows, topic, F.col("value")), topic, batch_id)


def values(spark, broker, topic, within=None):
    return sorted(r.value for r in broker.read(spark, topic, within, streaming=False).collect())


def test_log_cleaning_on_tables_and_streams(spark, broker, tmp_path):
    publish(spark, broker, "ods_base_log", LOGS[:1])
    publish(spark, broker, "ods_base_log", LOGS[1:], 1)
    table = log_cleaning.clean(broker.read(spark, "ods_base_log", streaming=False))
    counts = {topic: rows.count() for topic, rows in table.items()}
    assert counts == {"dwd_start_log": 1, "dwd_page_log": 2, "dwd_display_log": 2, "dirty_log": 1}

    for _ in range(2):  # A second run finds nothing new.
        records = broker.read(spark, "ods_base_log", files_per_trigger=1)
        log_cleaning.start(records, broker, str(tmp_path / "cp")).awaitTermination()
    for topic, rows in table.items():
        assert values(spark, broker, topic) == sorted(r.value for r in rows.collect())
    # The device claimed to be new twice; the later claim, in another micro-batch, was corrected.
    pages = [json.loads(v) for v in values(spark, broker, "dwd_page_log")]
    assert {(p["common"]["mid"], p["common"]["is_new"]) for p in pages} == {("mid_1", "0"), ("mid_2", "0")}
    starts = [json.loads(v) for v in values(spark, broker, "dwd_start_log")]
    assert starts[0]["common"]["is_new"] == "1"


CHANGES = [
    ("mysql.shop.order_info", "CREATE", None, '{"id":"1","user_id":"7","note":"x"}'),
    ("mysql.shop.user_info", "READ", None, '{"id":"7","name":"ann","secret":"s"}'),
    ("mysql.shop.user_info", "UPDATE", '{"id":"7","name":"ann"}', '{"id":"7","name":"bob","secret":"t"}'),
    ("mysql.shop.user_info", "DELETE", '{"id":"8","name":"old"}', None),
    ("mysql.shop.other", "CREATE", None, '{"id":"5"}'),
]
CONFIG = [
    ("order_info", "CREATE", "kafka", "dwd_order_info", "id,user_id", None, None),
    ("user_info", "READ", "hbase", "dim_user", "id,name", "id", None),
    ("user_info", "UPDATE", "hbase", "dim_user", "id,name", "id", None),
]


def test_changes_are_captured_and_routed(spark, broker, tmp_path):
    from brooklet.catalog.changes import CONFIG_SCHEMA

    raw = spark.createDataFrame(CHANGES, change_capture.RAW).coalesce(1)
    source = str(tmp_path / "raw")
    raw.write.json(source)
    stream = spark.readStream.schema(change_capture.RAW).json(source)
    change_capture.start(stream, broker, str(tmp_path / "cp1")).awaitTermination()
    flat = change_routing.parse_envelopes(broker.read(spark, "ods_base_db", streaming=False))
    rows = {(r.table, r.operation, len(r.before), len(r.after)) for r in flat.collect()}
    assert rows == {("order_info", "CREATE", 0, 3), ("user_info", "READ", 0, 3), ("user_info", "UPDATE", 2, 3),
                    ("user_info", "DELETE", 2, 0), ("other", "CREATE", 0, 1)}

    dims = str(tmp_path / "dims")
    change_routing.start(broker.read(spark, "ods_base_db"), lambda s: s.createDataFrame(CONFIG, CONFIG_SCHEMA),
                         broker, dims, str(tmp_path / "cp2")).awaitTermination()
    assert values(spark, broker, "dwd_order_info", "facts") == ['{"id":"1","user_id":"7"}']
    assert values(spark, broker, "other", "unrouted") == ['{"id":"5"}']
    users = change_routing.dimension_table(spark, f"{dims}/dim_user", "id").read().drop("offset").collect()
    assert [(r.id, r.name) for r in users] == [("7", "bob")]


def dimension(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} STRING" for c in columns))


def dimensions(spark):
    return {
        "user": dimension(spark, ["ID", "GENDER", "BIRTHDAY"], [("7", "F", "2000-01-01")]),
        "province": dimension(spark, ["ID", "NAME", "AREA_CODE", "ISO_CODE", "ISO_3166_2"], [("1", "BJ", "110000", "CN-11", "CN-BJ")]),
        "sku": dimension(spark, ["ID", "SKU_NAME", "CATEGORY3_ID", "SPU_ID", "TM_ID"], [("5", "phone", "61", "3", "2")]),
        "spu": dimension(spark, ["ID", "SPU_NAME"], [("3", "phones")]),
        "trademark": dimension(spark, ["ID", "TM_NAME"], [("2", "brand")]),
        "category": dimension(spark, ["ID", "NAME"], [("61", "mobile")]),
    }


ORDERS = [
    {"id": 1, "province_id": 1, "order_status": "1001", "user_id": 7, "total_amount": 30.5,
     "create_time": "2022-08-01 12:00:00"},
    {"id": 2, "province_id": 9, "user_id": 8, "total_amount": 1, "create_time": "2022-08-01 12:00:00"},
]
DETAILS = [
    {"id": 11, "order_id": 1, "sku_id": 5, "order_price": 30.5, "sku_num": 1, "create_time": "2022-08-01 12:00:05"},
    {"id": 12, "order_id": 1, "sku_id": 5, "order_price": 1, "sku_num": 1, "create_time": "2022-08-01 12:00:06"},
    {"id": 21, "order_id": 2, "sku_id": 99, "order_price": 1, "sku_num": 1, "create_time": "2022-08-01 11:59:55"},
]
PAYMENTS = [
    {"id": 100, "order_id": 1, "user_id": 7, "total_amount": 31, "subject": "s", "payment_type": "p",
     "create_time": "2022-08-01 12:15:00", "callback_time": "2022-08-01 12:15:20"},
    {"id": 200, "order_id": 2, "user_id": 8, "total_amount": 1, "create_time": "2022-08-01 12:15:01"},
]


def test_order_and_payment_wide(spark, broker, tmp_path):
    for topic, rows in (("dwd_order_info", ORDERS), ("dwd_order_detail", DETAILS), ("dwd_payment_info", PAYMENTS)):
        publish(spark, broker, topic, [json.dumps(r) for r in rows])

    def table(topic):
        return broker.read(spark, topic, streaming=False)

    wide = order_wide.build(table("dwd_order_info"), table("dwd_order_detail"), dimensions(spark),
                            F.lit("2022-08-01").cast("date"))
    rows = {r.detail_id: r for r in wide.collect()}
    assert sorted(rows) == [11, 21]
    one, two = rows[11], rows[21]
    assert (one.user_age, one.user_gender, one.province_name, one.tm_name, one.spu_name, one.category3_name) == (
        22, "F", "BJ", "brand", "phones", "mobile")
    assert (one.create_date, one.create_hour, one.total_amount, one.split_feight_fee) == ("2022-08-01", "12", 30.5, None)
    assert (two.user_age, two.province_name, two.tm_name) == (None, None, None)
    assert len(wide.columns) == 35

    order_wide.start(broker.read(spark, "dwd_order_info"), broker.read(spark, "dwd_order_detail"), dimensions, broker,
                     str(tmp_path / "cp1")).awaitTermination()
    assert {json.loads(v)["detail_id"] for v in values(spark, broker, "dwm_order_wide")} == {11, 21}

    paid = payment_wide.build(table("dwd_payment_info"), table("dwm_order_wide")).collect()
    # The second payment is one second too late for its order.
    assert [(r.payment_id, r.order_id, r.total_amount, r.user_id) for r in paid] == [(100, 1, 31, 7)]
    assert (paid[0].payment_create_time, paid[0].order_create_time) == ("2022-08-01 12:15:00", "2022-08-01 12:00:00")
    assert len(paid[0]) == 36
    payment_wide.start(broker.read(spark, "dwd_payment_info"), broker.read(spark, "dwm_order_wide"), broker,
                       str(tmp_path / "cp2")).awaitTermination()
    assert [json.loads(v)["payment_id"] for v in values(spark, broker, "dwm_payment_wide")] == [100]


def page(mid, seconds, last=None):
    body = {"common": {"mid": mid}, "page": {"page_id": "home"}, "ts": 1_660_000_000_000 + seconds * 1000}
    if last is not None:
        body["page"]["last_page_id"] = last
    return json.dumps(body)


# Device a: entry then another entry at once, then a followed one. b: entry left alone. c: a pair 10 s apart.
# d: a single entry that is still undecided when the stream ends. z: moves the clock.
PAGES = [
    [page("a", 0), page("b", 0), page("c", 0), page("a", 5, "")],
    [page("c", 10, "home"), page("a", 7, "home"), page("z", 60, "x")],
    [page("d", 95), page("z", 100, "x")],
]


def test_visits_and_jumps(spark, broker, tmp_path):
    for batch, rows in enumerate(PAGES):
        publish(spark, broker, "dwd_page_log", rows, batch)
    records = broker.read(spark, "dwd_page_log", streaming=False)
    assert sorted(r.mid for r in page_visits.unique_visits(records).collect()) == ["a", "b", "c", "d"]
    table = sorted((r.mid, r.reason) for r in page_visits.jumps(records).collect())
    assert table == [("a", "reentry"), ("b", "timeout"), ("c", "timeout"), ("d", "timeout")]

    for job, name in ((page_visits.start_unique_visits, "v"), (page_visits.start_jumps, "j")):
        stream = broker.read(spark, "dwd_page_log", files_per_trigger=1)
        job(stream, broker, str(tmp_path / name)).awaitTermination()
    seen = [json.loads(v)["common"]["mid"] for v in values(spark, broker, "dwm_unique_visit")]
    assert sorted(seen) == ["a", "b", "c", "d"]
    jumped = [json.loads(v) for v in values(spark, broker, "dwm_user_jump_detail")]
    assert sorted(j["common"]["mid"] for j in jumped) == ["a", "b", "c"]


def test_published_rules_go_on_live(spark, sf, tmp_path):
    """History up to a cutoff as baselines, then three live micro-batches, as one whole run."""
    events = load(spark, sf, "events").withColumnRenamed("user_id", "guid").withColumn("event_pk", F.col("event_id"))
    cutoff = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    store = rule_publication.RuleStore(spark, str(tmp_path / "rules"))
    definitions = [rule_queries.RULE_1, rule_queries.RULE_2]
    profiles = rule_queries.profiles(spark, sf)
    which = rule_publication.publish(store, definitions, profiles, events, rule_queries.COLUMNS, ["event_pk"], cutoff)
    audience = rule_publication.audience_of(which, profiles)

    live = events.where(F.col("ts") >= cutoff).withColumn("ts", F.col("ts").cast("timestamp"))
    source = str(tmp_path / "events")
    for low, high in ((10, 15), (15, 22), (22, 32)):
        day = F.dayofmonth("ts")
        live.where((day >= low) & (day < high)).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(live.schema).option("maxFilesPerTrigger", 1).parquet(source)
    path = str(tmp_path / "live")
    for _ in range(2):
        rule_matching.start(stream, which, audience, rule_queries.COLUMNS, ["event_pk"], path,
                            store.baselines()).awaitTermination()
    found = sorted((r.rule_id, r.event_pk) for r in rule_matching.read_matches(spark, path).collect())

    uncapped = [Rule(**{**r.__dict__, "max_matches": None}) for r in which]
    whole = match_rules(events, uncapped, audience, rule_queries.COLUMNS, ["event_pk"]).where(F.col("match_time") >= cutoff)
    by_user = {}
    for r in sorted(whole.collect(), key=lambda r: r.event_pk):
        by_user.setdefault((r.rule_id, r.guid), []).append((r.rule_id, r.event_pk))
    expected = [m for (rule, _), ms in by_user.items() for m in (ms if rule == "M1-R1" else ms[:2])]
    assert found == sorted(expected) and len(found) > 20


def test_rules_may_change_while_matching(spark, sf, tmp_path):
    """One rule runs throughout, the other only while its changelog has it."""
    events = load(spark, sf, "events").withColumnRenamed("user_id", "guid").withColumn("event_pk", F.col("event_id"))
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    source, changes, path = (str(tmp_path / n) for n in ("events", "changes", "live"))
    order = ["event_pk"]
    everyone = events.select("guid").distinct()

    def change(operation, text, at):
        rule_id = json.loads(text)["ruleId"]
        spark.createDataFrame([(operation, rule_id, text, at)], "operation STRING, rule_id STRING,"
                              " rule_define_json STRING, at INT").write.mode("append").parquet(changes)

    def current(session):
        live = rule_matching.rules_in_force(session.read.parquet(changes), ["at"])
        return live, everyone.select("guid", F.explode(F.array(*[F.lit(r.rule_id) for r in live])).alias("rule_id"))

    def run(low, high):
        day = F.dayofmonth("ts")
        events.where((day >= low) & (day < high)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        rule_matching.start_following(stream, current, rule_queries.COLUMNS, order, path).awaitTermination()

    change("INSERT", rule_queries.RULE_2, 1)
    run(1, 12)
    change("INSERT", rule_queries.RULE_1, 2)
    run(12, 22)
    change("DELETE", rule_queries.RULE_1, 3)
    run(22, 32)
    found = sorted((r.rule_id, r.event_pk) for r in rule_matching.read_matches(spark, path).collect())

    one, two = rule_queries.rules()

    def expected(rule, rows):
        audience = everyone.select(F.lit(rule.rule_id).alias("rule_id"), "guid")
        got = match_rules(rows, [rule], audience, rule_queries.COLUMNS, order)
        return [(r.rule_id, r.event_pk) for r in got.collect()]

    middle = events.where(F.dayofmonth("ts").between(12, 21))
    assert found == sorted(expected(two, events) + expected(one, middle))
    assert {r for r, _ in found} == {"M1-R1", "M2-R1"}


def test_keyed_table_replay_and_compaction(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["at"])

    def rows(*items):
        return spark.createDataFrame(items, "k STRING, at INT, v STRING")

    def state():
        return sorted(map(tuple, table.read().select("k", "at", "v").collect()))

    table.upsert(rows(("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")), 0)
    table.upsert(rows(("a", 2, "later batch")), 1)
    assert state() == [("a", 2, "later batch"), ("b", 1, "z")]
    table.upsert(rows(("a", 2, "later batch")), 1)
    table.compact()
    assert state() == [("a", 2, "later batch"), ("b", 1, "z")]
    table.upsert(rows(("b", 0, "too old"), ("c", 1, "new")), 2)
    assert state() == [("a", 2, "later batch"), ("b", 1, "z"), ("c", 1, "new")]


def test_changelog_startup_modes(spark):
    changes = spark.createDataFrame(
        [(1, "a", 1, "CREATE"), (2, "a", 2, "UPDATE"), (3, "b", 3, "CREATE"), (4, "b", 4, "DELETE"), (5, "a", 5, "UPDATE")],
        "at INT, k STRING, v INT, operation STRING")
    modes = {
        mode: sorted((r["at"], r.operation) for r in changelog.read_changelog(changes, mode, ["k"], ["at"], F.lit(4)).collect())
        for mode in ("initial", "latest")
    }
    assert modes == {"initial": [(2, "READ"), (5, "UPDATE")], "latest": [(5, "UPDATE")]}


def test_streaming_bucket_sink(spark, sf, tmp_path):
    source = spark.readStream.schema(load(spark, sf, "events").schema).option(
        "pathGlobFilter", "events.parquet").parquet(sf)
    rows = files.bucketed(source.select("event_id", "ts"), F.col("ts"), files.HOUR_BUCKET)
    out = str(tmp_path / "out")
    for _ in range(2):
        files.stream_buckets(rows, out, str(tmp_path / "cp"), trigger={"availableNow": True}).awaitTermination()
    back = spark.read.parquet(out)
    assert back.count() == 1000
    wrong = back.where(F.col("bucket") != F.date_format("ts", files.HOUR_BUCKET)).count()
    assert wrong == 0


def test_text_and_csv_overwrite(spark, tmp_path):
    lines = spark.createDataFrame([("a,1",), ("b,2",)], "value STRING")
    path = str(tmp_path / "lines")
    for _ in range(2):
        files.overwrite_text(lines, path)
    assert sorted(r.value for r in files.read_lines(spark, path).collect()) == ["a,1", "b,2"]
    files.overwrite_csv(spark.createDataFrame([("a", 1)], "k STRING, v INT"), str(tmp_path / "csv"))
    assert spark.read.schema("k STRING, v INT").csv(str(tmp_path / "csv")).first() == ("a", 1)


def test_late_rows_across_micro_batches(spark, sf, tmp_path):
    from datetime import timedelta

    from brooklet.operators.lateness import classify_lateness, watermark_progress
    from brooklet.streaming.lateness import late_row_batches

    events = load(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 3).alias("source"),
        (F.col("event_id") + F.col("event_id") * 37 % 50).alias("arrival"))
    source = str(tmp_path / "in")
    for part in range(4):
        events.where(F.floor(F.col("arrival") / 300) == part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    args = (["source"], ["arrival", "event_id"], "ts", timedelta(seconds=3))
    sink = late_row_batches(str(tmp_path / "late"), *args, "1 hour", timedelta(hours=2))
    runner.start(stream, sink, str(tmp_path / "cp")).awaitTermination()
    names = ["event_id", "is_late", "is_refire"]
    streamed = sorted(map(tuple, spark.read.parquet(str(tmp_path / "late" / "rows")).select(*names).collect()))
    whole = classify_lateness(watermark_progress(events, *args), "ts", "1 hour", timedelta(hours=2))
    assert streamed == sorted(map(tuple, whole.select(*names).collect()))
    assert sum(r[1] for r in streamed) > 10
