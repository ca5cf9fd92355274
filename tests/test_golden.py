"""Worked examples with documented results.

Fixed values: the rows of the examples and their results.
"""

from datetime import timedelta

from pyspark.sql import functions as F

from brooklet.operators import joins, lateness, routing, windows


def pairs(spark):
    at = F.timestamp_millis(F.lit(1000))
    left = spark.createDataFrame(
        [(1, "zs"), (1, "zz"), (2, "ls"), (3, "ww"), (4, "zl")], "id INT, name STRING").withColumn("lt", at)
    right = spark.createDataFrame(
        [(1, 18), (2, 28), (3, 38), (3, 48), (5, 18)], "id INT, age INT").withColumn("rt", at)
    return left, right


INNER = [(1, "zs", 18), (1, "zz", 18), (2, "ls", 28), (3, "ww", 38), (3, "ww", 48)]


def test_window_join(spark):
    joined = joins.window_join(*pairs(spark), ["id"], "20 seconds", "lt", "rt")
    assert sorted(map(tuple, joined.select("id", "name", "age").collect())) == INNER


def test_window_cogroup_keeps_left_rows(spark):
    joined = joins.window_join(*pairs(spark), ["id"], "30 seconds", "lt", "rt", "left")
    rows = joined.select("id", "name", F.coalesce("age", F.lit(0)).alias("age")).collect()
    assert sorted(map(tuple, rows)) == [*INNER, (4, "zl", 0)]


# (arrival, guid, event id, time in ms)
LATE = [(0, 1, "e01", 1000), (1, 2, "e02", 2000), (2, 1, "e01", 9000), (3, 2, "e01", 3000), (4, 1, "e01", 10000),
        (5, 1, "e01", 11000), (6, 1, "e01", 9000), (7, 1, "e01", 15000), (8, 1, "e01", 6000), (9, 2, "e01", 18000),
        (10, 1, "e01", 20000)]


def late_rows(spark):
    rows = spark.createDataFrame(LATE, "seq INT, guid BIGINT, event_id STRING, ms BIGINT")
    rows = rows.withColumns({"ts": F.timestamp_millis("ms"), "source": F.lit(0)})
    progress = lateness.watermark_progress(rows, ["source"], ["seq"], "ts", timedelta(0))
    return lateness.classify_lateness(progress, "ts", "10 seconds", timedelta(seconds=2))


def test_late_rows_go_aside(spark):
    late = late_rows(spark).where("is_late").collect()
    assert [(r.seq, r.ms) for r in late] == [(8, 6000)]
    again = late_rows(spark).where("is_refire").collect()
    assert [(r.seq, r.ms) for r in again] == [(6, 9000)]


def test_windows_fire_again_for_accepted_late_rows(spark):
    fired = lateness.emissions(late_rows(spark), ["guid"], ["seq"])
    rows = fired.select("guid", F.unix_seconds("window_start").alias("s"), "is_refire", "n").collect()
    assert sorted(map(tuple, rows)) == [
        (1, 0, False, 2), (1, 0, True, 3), (1, 10, False, 3), (1, 20, False, 1), (2, 0, False, 2), (2, 10, False, 1)]


def test_watermark_trails_by_one_millisecond(spark):
    rows = late_rows(spark).select("seq", F.unix_millis("watermark").alias("w"),
                                   F.unix_millis("prior_watermark").alias("p")).orderBy("seq").collect()
    assert [r.w for r in rows[:4]] == [999, 1999, 8999, 8999]
    assert [r.p for r in rows[:4]] == [None, 999, 1999, 8999]


def test_rolling_argmin(spark):
    rows = spark.createDataFrame([
        (1, "s1", "e1", 1000), (2, "s1", "e2", 2000), (3, "s2", "e1", 3000), (4, "s1", "e1", 4000),
        (5, "s1", "e2", 5000), (6, "s2", "e1", 6000)], "guid BIGINT, session STRING, event STRING, ts BIGINT")
    rolled = windows.running_argmin(rows, ["session", "event"], ["ts"], "guid").orderBy("ts").collect()
    assert [r.least.guid for r in rolled] == [1, 2, 3, 1, 2, 3]


def test_argmin_ties_keep_the_first_row(spark):
    rows = spark.createDataFrame([("k", 5, 1), ("k", 5, 2), ("k", 4, 3), ("k", 4, 4)], "k STRING, v INT, at INT")
    rolled = windows.running_argmin(rows, ["k"], ["at"], "v").orderBy("at").collect()
    assert [r.least["at"] for r in rolled] == [1, 1, 3, 3]
    assert windows.argmin(rows, ["k"], ["at"], "v").first()["at"] == 3


def test_interval_bounds_are_inclusive(spark):
    left = spark.createDataFrame([(1, 100)], "k INT, l BIGINT").withColumn("lt", F.timestamp_seconds("l"))
    right = spark.createDataFrame([(1, s) for s in (94, 95, 100, 105, 106)], "k INT, r BIGINT")
    right = right.withColumn("rt", F.timestamp_seconds("r"))
    joined = joins.interval_join(left, right, ["k"], "lt", "rt", timedelta(seconds=-5), timedelta(seconds=5))
    assert sorted(r.r for r in joined.collect()) == [95, 100, 105]


def test_session_gap_is_inclusive_and_may_vary(spark):
    rows = spark.createDataFrame([("a", 0, 30), ("a", 30, 5), ("a", 36, 30), ("b", 0, 30)], "k STRING, s BIGINT, gap INT")
    rows = rows.withColumn("ts", F.timestamp_seconds("s"))
    gap = F.make_dt_interval(secs=F.col("gap"))
    out = windows.session_windows(rows, ["k"], "ts", ["ts"], gap, {"n": F.count(F.lit(1))})
    found = out.select("k", F.unix_seconds("session_start").alias("a"), F.unix_seconds("session_end").alias("b"), "n")
    assert sorted(map(tuple, found.collect())) == [("a", 0, 35, 2), ("a", 36, 66, 1), ("b", 0, 30, 1)]


def test_count_windows_fire_only_when_full(spark):
    rows = spark.range(25).select(F.lit("k").alias("k"), F.col("id").alias("at"))
    full = windows.count_windows(rows, ["k"], ["at"], 10, {"total": F.sum("at")})
    assert sorted((r.window_no, r.total) for r in full.collect()) == [(0, 45), (1, 145)]


def test_sliding_count_windows_across_stretches(spark):
    rows = spark.range(25).select(F.lit("k").alias("k"), F.col("id").alias("at"))
    expected = [(n, sum(range(max(0, n - 10), n))) for n in range(2, 26, 2)]
    for stretch in (12, 1000):
        fired = windows.sliding_count_windows(rows, ["k"], ["at"], 10, 2, {"s": F.sum("at")}, stretch_rows=stretch)
        assert sorted((r.window_no, r.s) for r in fired.collect()) == expected


LOGS = [
    '{"common":{"ar":"110000","ba":"iPhone","ch":"Appstore","is_new":"1","md":"iPhone 8","mid":"mid_1","os":"iOS",'
    '"uid":"1","vc":"v2"},"start":{"entry":"icon","loading_time":100,"open_ad_id":1,"open_ad_ms":2,'
    '"open_ad_skip_ms":0},"ts":1000}',
    '{"common":{"mid":"mid_1","is_new":"1"},"displays":[{"display_type":"query","item":"3","item_type":"sku_id",'
    '"order":1,"pos_id":2},{"display_type":"promotion","item":"6","item_type":"sku_id","order":2,"pos_id":1}],'
    '"page":{"during_time":10,"page_id":"home"},"ts":2000}',
    '{"common":{"mid":"mid_2","is_new":"0"},"page":{"during_time":10,"last_page_id":"home","page_id":"mine"},"ts":3000}',
    '{"common":{"mid":"mid_3","is',
]


def test_logs_split_three_ways_and_aside(spark):
    lines = spark.createDataFrame([(i, line) for i, line in enumerate(LOGS)], "offset BIGINT, value STRING")
    good, bad = routing.split_malformed(lines, "value", routing.LOG_SCHEMA, "log")
    assert [r.offset for r in bad.collect()] == [3]
    routed = routing.route_logs(good.select("log.*"))
    assert {k: v.count() for k, v in routed.items()} == {"start": 1, "page": 2, "display": 2}
    assert {r.display.page_id for r in routed["display"].collect()} == {"home"}


def test_side_outputs_partition_the_rows(spark):
    rows = spark.createDataFrame([("putBack",), ("appLaunch",), ("putBack",)], "event_id STRING")
    out = routing.side_outputs(rows, {"putBack": F.col("event_id") == "putBack"}, "main")
    assert {k: v.count() for k, v in out.items()} == {"putBack": 2, "main": 1}
