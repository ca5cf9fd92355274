"""Time, count and session windows, rolling values and lateness."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.catalog.registry import query
from brooklet.functions.times import text
from brooklet.functions.user import Aggregate, aggregate, map_batches
from brooklet.operators import lateness, windows
from brooklet.tables import load

ORDER = ["ts", "event_id"]


def counts() -> dict:
    return {"n": F.count(F.lit(1)), "cents": F.sum(F.round(F.col("value") * 100).cast("bigint"))}


CENTS = "CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents"


@query("""
    SELECT event_id, user_id, event_type, least.event_id AS least_event_id, least.value AS least_value FROM (
        SELECT *, min({'value': value, 'event_id': event_id}) OVER (PARTITION BY user_id, event_type
            ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS least FROM events)""")
def rolling_min_by(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").drop("props")
    rolled = windows.running_argmin(events, ["user_id", "event_type"], ORDER, "value")
    return rolled.select("event_id", "user_id", "event_type",
                         F.col("least.event_id").alias("least_event_id"), F.col("least.value").alias("least_value"))


@query("""
    SELECT user_id, event_type, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value, ts, event_id) AS rn
        FROM events) WHERE rn = 1""")
def final_min_by(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select("user_id", "event_type", *ORDER, "value")
    least = windows.argmin(events, ["user_id", "event_type"], ORDER, "value")
    return least.select("user_id", "event_type", "event_id", "value")


def started(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, text(F.col("window_start")).alias("window_start"), "n", "cents")


TUMBLING_KEYED = f"""
    SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n, {CENTS}
    FROM events GROUP BY 1, 2"""


@query(TUMBLING_KEYED)
def tumbling_count_keyed(spark: SparkSession, sf: str) -> DataFrame:
    return started(windows.time_windows(load(spark, sf, "events"), "ts", "1 day", counts(), ["user_id"]), "user_id")


@query(f"""
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n, {CENTS}
    FROM events GROUP BY 1""")
def tumbling_count_global(spark: SparkSession, sf: str) -> DataFrame:
    return started(windows.time_windows(load(spark, sf, "events"), "ts", "1 hour", counts()))


# Rows, least and greatest value in cents.
NOTHING = (0, 2**62, -(2**62))
SPREAD = Aggregate(
    create=lambda: NOTHING,
    add=lambda state, value: (state[0] + 1, min(state[1], round(value * 100)), max(state[2], round(value * 100))),
    merge=lambda a, b: (a[0] + b[0], min(a[1], b[1]), max(a[2], b[2])),
    result=lambda state: (state[0], state[2] - state[1]),
    state="n BIGINT, low BIGINT, high BIGINT", output="n BIGINT, spread_cents BIGINT")


@query("""
    SELECT user_id, event_type, count(*) AS n,
           max(CAST(round(value * 100) AS BIGINT)) - min(CAST(round(value * 100) AS BIGINT)) AS spread_cents
    FROM events GROUP BY 1, 2""")
def user_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    """A user-defined aggregate with create, add, merge and result."""
    return aggregate(load(spark, sf, "events"), ["user_id", "event_type"], ["value"], SPREAD)


@query("""
    SELECT user_id, event_id, upper(event_type) || '#' || i AS label
    FROM events, (VALUES (1), (2)) AS copies(i) WHERE event_type <> 'signup' AND i <= event_id % 3""")
def user_flat_map(spark: SparkSession, sf: str) -> DataFrame:
    """Opaque code with none, one or two outputs per row."""

    def label(rows):
        kept = rows[rows["event_type"] != "signup"]
        kept = kept.loc[kept.index.repeat(kept["event_id"] % 3)]
        number = kept.groupby("event_id").cumcount() + 1
        kept = kept.assign(label=kept["event_type"].str.upper() + "#" + number.astype(str))
        return kept[["user_id", "event_id", "label"]]

    rows = load(spark, sf, "events").select("user_id", "event_id", "event_type")
    return map_batches(rows, label, "user_id BIGINT, event_id BIGINT, label STRING")


# The start of the latest 6 hour stretch, and the three before it that also cover the row.
SLIDES = """
    SELECT *, time_bucket(INTERVAL 6 HOUR, {time}) - s * INTERVAL 6 HOUR AS w
    FROM events, (VALUES (0), (1), (2), (3)) AS slides(s)"""

SLIDING_KEYED = f"""
    SELECT user_id, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n, {CENTS}
    FROM ({SLIDES.format(time='ts')}) GROUP BY 1, 2"""


@query(SLIDING_KEYED)
def sliding_count_keyed(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events")
    return started(windows.time_windows(events, "ts", "1 day", counts(), ["user_id"], "6 hours"), "user_id")


@query(f"""
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n, {CENTS}
    FROM ({SLIDES.format(time='ts')}) GROUP BY 1""")
def sliding_count_global(spark: SparkSession, sf: str) -> DataFrame:
    return started(windows.time_windows(load(spark, sf, "events"), "ts", "1 day", counts(), slide="6 hours"))


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    delay = F.make_dt_interval(mins=(F.col("event_id") * 37 % 50).cast("int"))
    return load(spark, sf, "events").withColumn("arrived", F.col("ts") + delay)


ARRIVED = "(ts + ((event_id * 37) % 50) * INTERVAL 1 MINUTE)"


@query(f"""
    SELECT strftime(time_bucket(INTERVAL 6 HOUR, {ARRIVED}), '%Y-%m-%d %H:%M:%S') AS window_start,
           count(*) AS n, {CENTS} FROM events GROUP BY 1""")
def arrival_window_count(spark: SparkSession, sf: str) -> DataFrame:
    return started(windows.time_windows(arrivals(spark, sf), "arrived", "6 hours", counts()))


@query(f"""
    SELECT user_id, strftime(time_bucket(INTERVAL 6 HOUR, {ARRIVED}), '%Y-%m-%d %H:%M:%S') AS window_start,
           count(*) AS n, {CENTS} FROM events GROUP BY 1, 2""")
def arrival_window_keyed(spark: SparkSession, sf: str) -> DataFrame:
    counted = windows.time_windows(arrivals(spark, sf), "arrived", "6 hours", counts(), ["user_id"])
    return started(counted, "user_id")


@query(f"""
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n, {CENTS}
    FROM ({SLIDES.format(time=ARRIVED)}) GROUP BY 1""")
def arrival_sliding_count(spark: SparkSession, sf: str) -> DataFrame:
    return started(windows.time_windows(arrivals(spark, sf), "arrived", "1 day", counts(), slide="6 hours"))


def _sessions(gap: str, key: str = "user_id") -> str:
    return f"""
    WITH reach AS (SELECT *, ts + {gap} AS e FROM events),
    furthest AS (SELECT *, max(e) OVER (PARTITION BY {key or 'true'} ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS f FROM reach),
    numbered AS (SELECT *, sum(CASE WHEN f IS NULL OR ts > f THEN 1 ELSE 0 END) OVER (
        PARTITION BY {key or 'true'} ORDER BY ts, event_id) AS s FROM furthest)
    SELECT {key + ',' if key else ''} strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start,
           strftime(max(e), '%Y-%m-%d %H:%M:%S') AS session_end, count(*) AS n, {CENTS}
    FROM numbered GROUP BY {key + ',' if key else ''} s"""


SESSION_KEYED = _sessions("INTERVAL 6 HOUR")


def session_rows(sessions: DataFrame, *keys: str) -> DataFrame:
    return sessions.select(*keys, text(F.col("session_start")).alias("session_start"),
                           text(F.col("session_end")).alias("session_end"), "n", "cents")


@query(_sessions("INTERVAL 5 MINUTE", ""))
def session_count_global(spark: SparkSession, sf: str) -> DataFrame:
    events, gap = load(spark, sf, "events"), F.lit(timedelta(minutes=5))
    return session_rows(windows.session_windows(events, [], "ts", ORDER, gap, counts()))


@query(SESSION_KEYED)
def session_count_keyed(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events")
    gap = F.lit(timedelta(hours=6))
    return session_rows(windows.session_windows(events, ["user_id"], "ts", ORDER, gap, counts()), "user_id")


@query(_sessions("(CASE event_type WHEN 'error' THEN 1 WHEN 'purchase' THEN 12 ELSE 6 END) * INTERVAL 1 HOUR"))
def session_dynamic_gap(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    gap = (F.when(kind == "error", F.lit(timedelta(hours=1)))
           .when(kind == "purchase", F.lit(timedelta(hours=12))).otherwise(F.lit(timedelta(hours=6))))
    events = load(spark, sf, "events")
    return session_rows(windows.session_windows(events, ["user_id"], "ts", ORDER, gap, counts()), "user_id")


COUNT_WINDOW = """
    SELECT {keys} window_no, count(*) AS n, {cents}, min(event_id) AS first_event_id
    FROM (SELECT *, CAST(floor((row_number() OVER ({part} ORDER BY ts, event_id) - 1) / 10) AS BIGINT) AS window_no
          FROM events) GROUP BY {keys} window_no HAVING count(*) = 10"""


@query(COUNT_WINDOW.format(keys="user_id,", part="PARTITION BY user_id", cents=CENTS))
def count_window_keyed(spark: SparkSession, sf: str) -> DataFrame:
    aggregates = {**counts(), "first_event_id": F.min("event_id")}
    return windows.count_windows(load(spark, sf, "events"), ["user_id"], ORDER, 10, aggregates)


@query(COUNT_WINDOW.format(keys="", part="", cents=CENTS))
def count_window_global(spark: SparkSession, sf: str) -> DataFrame:
    aggregates = {**counts(), "first_event_id": F.min("event_id")}
    return windows.count_windows(load(spark, sf, "events"), [], ORDER, 10, aggregates)


COUNT_SLIDE = """
    SELECT {keys} window_no, n, cents FROM (
        SELECT {keys} row_number() OVER ({part} ORDER BY ts, event_id) AS window_no,
               count(*) OVER ({part} ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS n,
               CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER ({part} ORDER BY ts, event_id
                    ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS BIGINT) AS cents
        FROM events) WHERE window_no % 2 = 0"""


@query(COUNT_SLIDE.format(keys="user_id,", part="PARTITION BY user_id"))
def count_slide_keyed(spark: SparkSession, sf: str) -> DataFrame:
    fired = windows.sliding_count_windows(load(spark, sf, "events"), ["user_id"], ORDER, 10, 2, counts())
    return fired.select("user_id", "window_no", "n", "cents")


@query(COUNT_SLIDE.format(keys="", part=""))
def count_slide_global(spark: SparkSession, sf: str) -> DataFrame:
    fired = windows.sliding_count_windows(load(spark, sf, "events"), [], ORDER, 10, 2, counts())
    return fired.select("window_no", "n", "cents")


# Lateness -----------------------------------------------------------------------------

BOUND = timedelta(seconds=3)
LATENESS = timedelta(hours=2)


def disturbed(events: DataFrame) -> DataFrame:
    """Events in a disturbed arrival order, from eight source partitions."""
    return events.select(
        "event_id", "user_id", "ts", (F.col("user_id") % 8).alias("source"),
        (F.col("event_id") + F.col("event_id") * 37 % 50).alias("arrival"))


ARRIVAL = ["arrival", "event_id"]


def progressed(spark: SparkSession, sf: str) -> DataFrame:
    return lateness.watermark_progress(disturbed(load(spark, sf, "events")), ["source"], ARRIVAL, "ts", BOUND)


PROGRESS = """
    progress AS (
        SELECT *, max(ts) OVER (PARTITION BY source ORDER BY arrival, event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - INTERVAL 3001 MILLISECOND AS watermark,
               max(ts) OVER (PARTITION BY source ORDER BY arrival, event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 3001 MILLISECOND AS prior
        FROM (SELECT *, user_id % 8 AS source, event_id + (event_id * 37) % 50 AS arrival FROM events)),
    classified AS (
        SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS w,
               coalesce(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 3599999 MILLISECOND <= prior, false) AS passed,
               coalesce(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 10799999 MILLISECOND <= prior, false) AS is_late
        FROM progress)"""


@query(f"""
    WITH {PROGRESS} SELECT event_id, source, strftime(watermark, '%Y-%m-%d %H:%M:%S') AS watermark,
        strftime(prior, '%Y-%m-%d %H:%M:%S') AS prior_watermark FROM progress""")
def watermark_progress(spark: SparkSession, sf: str) -> DataFrame:
    return progressed(spark, sf).select("event_id", "source", text(F.col("watermark")).alias("watermark"),
                                        text(F.col("prior_watermark")).alias("prior_watermark"))


@query(f"WITH {PROGRESS} SELECT event_id, user_id, is_late, passed AND NOT is_late AS is_refire FROM classified")
def late_side_output(spark: SparkSession, sf: str) -> DataFrame:
    classified = lateness.classify_lateness(progressed(spark, sf), "ts", "1 hour", LATENESS)
    return classified.select("event_id", "user_id", "is_late", "is_refire")


@query(f"""
    WITH {PROGRESS}, accepted AS (
        SELECT user_id, w, passed, row_number() OVER (PARTITION BY user_id, w ORDER BY arrival, event_id) AS n
        FROM classified WHERE NOT is_late)
    SELECT user_id, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, false AS is_refire, count(*) AS n
    FROM accepted WHERE NOT passed GROUP BY user_id, w
    UNION ALL SELECT user_id, strftime(w, '%Y-%m-%d %H:%M:%S'), true, n FROM accepted WHERE passed""")
def late_refire_log(spark: SparkSession, sf: str) -> DataFrame:
    fired = lateness.late_window_counts(disturbed(load(spark, sf, "events")), ["source"], ["user_id"], ARRIVAL,
                                        "ts", BOUND, "1 hour", LATENESS)
    return fired.select("user_id", text(F.col("window_start")).alias("window_start"), "is_refire", "n")
