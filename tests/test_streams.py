"""Keyed state across micro-batches gives the rows of one batch run."""

import pytest
from pyspark.sql import functions as F

from brooklet.catalog import rules as rule_queries
from brooklet.catalog import streams, visits as visit_queries
from brooklet.functions.predicates import event_flag
from brooklet.operators import sequences, visits, windows
from brooklet.streaming import runner, stateful
from brooklet.tables import load

ORDER = ["ts", "event_id"]


@pytest.fixture(scope="module")
def events(spark, sf):
    return load(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.fixture(scope="module")
def arriving(spark, events, tmp_path_factory):
    """The same events in four files, one per micro-batch."""
    path = str(tmp_path_factory.mktemp("stream") / "events")
    for low, high in ((1, 9), (9, 17), (17, 25), (25, 32)):
        day = F.dayofmonth("ts")
        events.where((day >= low) & (day < high)).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


def same(spark, streaming, batch, *columns):
    got = runner.run_to_table(spark, streaming.select(*columns), "test").collect()
    assert sorted(map(str, got)) == sorted(map(str, batch.select(*columns).collect()))
    return len(got)


def test_new_user_flag(spark, events, arriving):
    streaming = stateful.correct_new_flag(visit_queries.claims(arriving), "user_id", ORDER)
    assert same(spark, streaming, visits.correct_new_flag(visit_queries.claims(events), "user_id", ORDER),
                "event_id", "is_new") == 1000


def test_sequence_progress(spark, events, arriving):
    def rows(df):
        hits = sequences.step_hits([event_flag(s, rule_queries.COLUMNS) for s in rule_queries.STEPS])
        return df.select("user_id", *ORDER, hits.alias("hits"))

    same(spark, stateful.sequence_progress(rows(arriving), ["user_id"], ORDER),
         sequences.sequence_progress(rows(events), ["user_id"], ORDER, 3), "event_id", "step", "n")


def test_rolling_argmin(spark, events, arriving):
    rolled = windows.running_argmin(streams.timed(events), ["user_id"], ORDER, "value")
    same(spark, stateful.running_argmin(streams.timed(arriving), ["user_id"], ORDER, "value"),
         rolled.withColumn("least_event_id", F.col("least.event_id")), "event_id", "least_event_id")


@pytest.mark.parametrize("slide", [None, 4])
def test_count_windows(spark, events, arriving, slide):
    fired = stateful.count_windows(streams.timed(arriving), ["user_id"], ORDER, ["event_id", "value"], 10,
                                   streams.TOTALS, slide)
    totals = {"n": F.count(F.lit(1)), "first_event_id": F.min("event_id")}
    whole = windows.sliding_count_windows(events, ["user_id"], ORDER, 10, slide or 10, totals)
    assert same(spark, fired.withColumnRenamed("rows_seen", "window_no"), whole, "user_id", "window_no", "n",
                "first_event_id") > 50


def test_first_visits_keep_one_row_per_day(spark, events, arriving):
    entry = F.col("event_type") == "view"
    first = stateful.first_visits(arriving, "user_id", "ts", entry)
    whole = visits.first_visits(events, "user_id", "ts", ORDER, entry)
    same(spark, first, whole, "user_id", "visit_date")


def test_windows_fire_again_across_micro_batches(spark, events, tmp_path):
    from datetime import timedelta

    from brooklet.catalog.windows import ARRIVAL, disturbed
    from brooklet.operators.lateness import ONE_MILLI, late_window_counts
    from brooklet.functions.times import span
    from brooklet.streaming.lateness import window_count_batches

    # Every third row arrives much later than its time.
    delay = F.when(F.col("event_id") % 3 == 0, 40).otherwise(0)
    rows = disturbed(events).withColumns({"arrival": F.col("event_id") + delay, "user_id": F.col("source")})
    source = str(tmp_path / "in")
    for part in range(4):
        rows.where(F.floor(F.col("arrival") / 270) == part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    bound, late = timedelta(seconds=3), timedelta(hours=20)
    args = (["source"], ["user_id"], ARRIVAL, "ts", bound, "12 hours", late)
    path = str(tmp_path / "out")
    for _ in range(2):
        runner.start(stream, window_count_batches(path, *args), str(tmp_path / "cp")).awaitTermination()
    names = ["user_id", "window_start", "is_refire", "n"]
    got = sorted(map(str, spark.read.parquet(f"{path}/fired").select(*names).collect()))

    clock = rows.groupBy("user_id").agg((F.max("ts") - span(bound + ONE_MILLI)).alias("clock"))
    whole = late_window_counts(rows, *args).join(clock, "user_id")
    closed = F.col("window_end") - span(ONE_MILLI) <= F.col("clock")
    assert got == sorted(map(str, whole.where(F.col("is_refire") | closed).select(*names).collect()))
    assert sum("is_refire=True" in g for g in got) > 20 and sum("is_refire=False" in g for g in got) > 100


def test_processing_time_windows(spark, arriving, tmp_path):
    counted = windows.time_windows(windows.with_arrival(arriving), "arrived", "1 hour", {"n": F.count(F.lit(1))})
    table = runner.run_to_keyed(spark, counted, "arrival", ["window_start"], ["n"])
    assert table.agg(F.sum("n")).first()[0] == 1000
