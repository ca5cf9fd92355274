"""Stateful processors: as-of joins of streams, event patterns, and first visits.

State is kept in the RocksDB state store; rows wait there until the watermark has passed them, so they are taken
in order of time across micro-batches, and timers wake what waits without new rows. A row that comes behind the
watermark is left out, as by every operator with a watermark.

As-of joins and patterns keep one state per bucket of keys: what a call costs is paid once for many keys. A
micro-batch reads and writes the buckets it touches whole, so these hold no more than the rows of the allowed
disorder, one version per key or the runs that wait; more ``buckets`` make each smaller.
"""

from __future__ import annotations

from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from brooklet.functions.times import micros, span_micros
from brooklet.operators.patterns import MATCH, TIMEOUT, Pattern
from brooklet.streaming.stateful import BUCKETS, ROW, Batches, bucket, packed, unpacked

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BOUNDED, BOUND = (f"spark.sql.streaming.stateStore.rocksdb.{x}" for x in ("boundedMemoryUsage", "maxMemoryUsageMB"))
#: Settings of the state store, for the session that uses it. All stores of an executor share one bound of memory,
#: beside its heap; without it, each of its partitions has its own.
STORE = {PROVIDER: ROCKS, BOUNDED: "true", BOUND: "200"}


def _keyed(keys: list[str]) -> Column:
    """The key of a row as text, as null keys are keys."""
    return F.to_json(F.struct(*keys), ROW).alias("key")


def use_state_lists(spark: SparkSession) -> None:
    """Maps need this state store, and it holds more than memory; streams that have a checkpoint keep their own.
    Bounds of memory that the session has set are kept."""
    for key, value in STORE.items():
        if key == PROVIDER or spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


#: What stands for a null tie or id: it goes ahead of all others, as in the order of tables.
NO_NUMBER = -(2**63)


def _number(name: str) -> Column:
    return F.coalesce(F.col(name).cast("bigint"), F.lit(NO_NUMBER))


def _in_order(batches: Batches, waiting: pd.DataFrame | None, columns: list[str], clock: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Rows of a bucket that the watermark has passed, and those that wait for it."""
    frames = [] if waiting is None else [waiting]
    frames += [b[columns] for b in batches if len(b)]
    rows = pd.concat(frames, ignore_index=True) if frames else pd.DataFrame({c: pd.Series(dtype="int64") for c in columns})
    passed = rows["at"] <= clock
    return rows[passed], rows[~passed]


def _wake(state: GroupState, times: list[int], clock: int) -> None:
    """Wakes the bucket once the watermark has reached the least of some times, which it has not so far."""
    if times:
        state.setTimeoutTimestamp(max(-(-min(times) // 1000) - 1, clock // 1000, 1))


def _keep(state: GroupState, *tables: pd.DataFrame) -> None:
    """Tables of a bucket; none is kept without rows, and nothing where all are empty."""
    if any(len(t) for t in tables):
        state.update(tuple(packed(t) if len(t) else None for t in tables))
    elif state.exists:
        state.remove()


def _kept(state: GroupState, tables: int) -> list[pd.DataFrame | None]:
    return [None if t is None else unpacked(t) for t in state.get] if state.exists else [None] * tables


def _versions_known(key: tuple, batches: Batches, state: GroupState) -> Batches:
    """As-of join of one bucket; its state is the rows that wait, and of each key the version in force where the
    watermark is. Versions after it are among the waiting rows."""
    clock = state.getCurrentWatermarkMs() * 1000
    waiting, known = _kept(state, 2)
    passed, later = _in_order(batches, waiting, ["key", "at", "side", "tie", "payload"], clock)
    if known is None:
        known = pd.DataFrame({"key": pd.Series(dtype=object), "payload": pd.Series(dtype=object)})
    if len(passed):
        ahead = known.assign(at=NO_NUMBER, side=-1, tie=NO_NUMBER)
        rows = pd.concat([ahead, passed], ignore_index=True) if len(known) else passed
        keys = pd.factorize(rows["key"])[0]
        order = np.lexsort([rows["tie"], rows["side"], rows["at"], keys])
        keys, names, payload = keys[order], rows["key"].to_numpy()[order], rows["payload"].to_numpy(dtype=object)[order]
        is_row = rows["side"].to_numpy()[order] == 1
        # The place of the last version at or before each row, if it is of the same key.
        place = np.maximum.accumulate(np.where(is_row, -1, np.arange(len(order))))
        found = (place >= 0) & (keys[place] == keys)
        version = np.where(found, payload[place], None)
        last = np.append(keys[1:] != keys[:-1], True) & found
        known = pd.DataFrame({"key": names[last], "payload": version[last]})
        if is_row.any():
            yield pd.DataFrame({"row": payload[is_row], "version": version[is_row]})
    _keep(state, later, known)
    _wake(state, [int(later["at"].min())] if len(later) else [], clock)


def asof_join(
    left: DataFrame, versions: DataFrame, keys: list[str], *, left_order: tuple[str, str], version_order: tuple[str, str], disorder: str,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Each row of a stream with the version of its key known at that moment, versions being a stream too.

    As ``operators.joins.asof_join``: both orders are (time, unique whole number), a version of the same time is
    already known, null keys and times match nothing, version columns repeat no names of the left side. Rows and
    versions may come ``disorder`` out of time order. A row is given once the watermark of both streams has passed it,
    so whatever micro-batch a version comes in, it counts. Of the versions that the watermark has passed, a key
    keeps one. Keys are dealt to ``buckets``; a checkpoint keeps their number.
    """
    spark = left.sparkSession
    use_state_lists(spark)
    payload = [c for c in versions.columns if c not in keys]
    kinds = {"row": T.StructType([left.schema[c] for c in left.columns]), "version": T.StructType([versions.schema[c] for c in payload])}

    def side(df: DataFrame, order: tuple[str, str], number: int, columns: list[str]) -> DataFrame:
        at = F.col(order[0]).cast("timestamp")
        return df.select(
            _keyed(keys), at.alias("time"), micros(at).alias("at"), F.lit(number).alias("side"), _number(order[1]).alias("tie"),
            F.to_json(F.struct(*columns), ROW).alias("payload")).withWatermark("time", disorder)

    matchable = F.lit(True)
    for c in [*keys, left_order[0]]:
        matchable &= F.col(c).isNotNull()
    placed = F.lit(True)
    for c in [*keys, version_order[0]]:
        placed &= F.col(c).isNotNull()
    both = side(left.where(matchable), left_order, 1, left.columns).unionByName(side(versions.where(placed), version_order, 0, payload))
    joined = both.withColumn("bucket", bucket("key", buckets)).groupBy("bucket").applyInPandasWithState(
        _versions_known, "row STRING, version STRING", "waiting BINARY, known BINARY", "append", GroupStateTimeout.EventTimeTimeout)
    found = joined.select(F.from_json("row", kinds["row"], ROW).alias("r"), F.from_json("version", kinds["version"], ROW).alias("v")).select("r.*", "v.*")
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in kinds["version"].fields]
    return found.unionByName(left.where(~matchable).select("*", *missing))


def _runs_ended(strict: list[bool], limit: int | None):
    """The pattern's runs in one bucket; its state is the rows that wait, and the runs."""
    last = len(strict)

    def timed_out(key: str, runs: list, at: int, found: list) -> list:
        if limit is None or not runs:
            return runs
        found.extend((key, met[0], TIMEOUT, met) for _, begin, met in runs if at - begin >= limit)
        return [r for r in runs if at - r[1] < limit]

    def go_on(key: str, runs: list, at: int, row: int, stages: int, found: list) -> list:
        left = []
        for stage, begin, met in timed_out(key, runs, at, found):
            if stages >> stage & 1:
                met = [*met, row]
                if stage + 1 == last:
                    found.append((key, met[0], MATCH, met))
                else:
                    left.append((stage + 1, begin, met))
            elif not strict[stage]:
                left.append((stage, begin, met))
        if stages & 1:
            if last == 1:
                found.append((key, row, MATCH, [row]))
            else:
                left.append((1, at, [row]))
        return left

    def watch(key: tuple, batches: Batches, state: GroupState) -> Batches:
        clock = state.getCurrentWatermarkMs() * 1000
        waiting, kept = _kept(state, 2)
        passed, later = _in_order(batches, waiting, ["key", "at", "id", "stages"], clock)
        runs: dict[str, list] = {}
        if kept is not None:
            for name, *run in zip(*[kept[c].tolist() for c in ("key", "stage", "begin", "met")]):
                runs.setdefault(name, []).append((*run[:2], list(run[2])))
        found: list = []
        order = np.lexsort([passed["id"], passed["at"]])
        for name, *row in zip(*[passed[c].to_numpy()[order].tolist() for c in ("key", "at", "id", "stages")]):
            runs[name] = go_on(name, runs.get(name, []), *row, found)
        open_runs = [(name, *r) for name, of in runs.items() for r in timed_out(name, of, clock, found)]
        _keep(state, later, pd.DataFrame(open_runs, columns=["key", "stage", "begin", "met"]))
        wake = [int(later["at"].min())] if len(later) else []
        if limit is not None and open_runs:
            wake.append(min(r[2] for r in open_runs) + limit)
        _wake(state, wake, clock)
        if found:
            numbers = [[None if n == NO_NUMBER else int(n) for n in met] for *_, met in found]
            yield pd.DataFrame({
                "key": [f[0] for f in found], "id": pd.array([n[0] for n in numbers], dtype="Int64"),
                "reason": [f[2] for f in found], "met": numbers})

    return watch


def match_pattern(df: DataFrame, keys: list[str], time: str, row_id: str, pattern: Pattern, disorder: str, buckets: int = BUCKETS) -> DataFrame:
    """How the runs of a pattern end in a stream: keys, ``row_id`` of the first row, ``reason`` and ``met``.

    As ``operators.patterns.match_pattern``, rows being ordered by time and ``row_id``, a unique whole number. Rows wait
    until the watermark has passed them; runs time out by the watermark too, so the end of the stream alone ends
    none. State holds rows of the allowed disorder, and runs that wait; without a limit they may wait for good.
    Keys are dealt to ``buckets``; a checkpoint keeps their number.
    """
    use_state_lists(df.sparkSession)
    stages = F.lit(0).cast("bigint")
    for i in range(len(pattern.stages)):
        stages = stages.bitwiseOR(F.when(pattern.met(i), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    rows = df.where(F.col(time).isNotNull()).select(
        _keyed(keys), F.col(time).cast("timestamp").alias("time"), micros(F.col(time)).alias("at"), _number(row_id).alias("id"),
        stages.alias("stages")).withWatermark("time", disorder)
    limit = None if pattern.limit is None else span_micros(pattern.limit)
    ends = rows.withColumn("bucket", bucket("key", buckets)).groupBy("bucket").applyInPandasWithState(
        _runs_ended([s.strict for s in pattern.stages], limit), "key STRING, id BIGINT, reason STRING, met ARRAY<BIGINT>",
        "waiting BINARY, runs BINARY", "append", GroupStateTimeout.EventTimeTimeout)
    key = F.from_json("key", T.StructType([df.schema[k] for k in keys]), ROW)
    return ends.select(key.alias("k"), F.col("id").alias(row_id), "reason", "met").select("k.*", row_id, "reason", "met")


class _FirstVisits(StatefulProcessor):
    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle) -> None:
        self.newest = handle.getValueState("newest", "day INT")
        self.days = handle.getMapState("days", "day INT", "seen BOOLEAN")

    def handleInputRows(self, key, rows, timerValues):
        batches = [b.sort_values(["at", "id"]).drop_duplicates("day") for b in rows if len(b)]
        first = pd.concat(batches, ignore_index=True).sort_values(["at", "id"]).drop_duplicates("day")
        before = self.newest.get()[0] if self.newest.exists() else None
        oldest = None if before is None else before - self.keep
        late = first["day"] < oldest if before is not None else pd.Series(False, index=first.index)
        known = {day for (day,) in self.days.keys()} if before is not None else set()
        new = ~late & ~first["day"].isin(known)
        newest = int(first["day"].max()) if before is None else max(before, int(first["day"].max()))
        for day in first["day"][new].tolist():
            if day >= newest - self.keep:
                self.days.updateValue((int(day),), (True,))
        if newest != before:
            self.newest.update((newest,))
            for day in known:
                if day < newest - self.keep:
                    self.days.removeKey((day,))
        given = first[late | new]
        if len(given):
            yield given[["payload"]].assign(is_late=late[given.index].astype(bool))

    def close(self) -> None:
        pass


def first_visits(df: DataFrame, device: str, time: str, row_id: str, entry: Column, keep_days: int) -> DataFrame:
    """First arriving entry page per device and day, the earliest of its micro-batch, with state that is bounded:
    ``df``'s rows, ``visit_date`` and ``is_late``.

    A device keeps its newest day, and in a map the days of its visits from ``keep_days`` before that day on. A
    row of an earlier day has ``is_late`` set (the earliest of its micro-batch, device and day): whether its day
    was seen is not known any more, and it is to be matched with the visits written before. No day is
    given twice without it. No row is left out but those without a time; a null device is a device.
    """
    use_state_lists(df.sparkSession)
    visits = df.where(entry).where(F.col(time).isNotNull()).withColumn("visit_date", F.to_date(time))
    rows = visits.select(
        _keyed([device]), F.unix_date("visit_date").alias("day"), micros(F.col(time)).alias("at"), F.col(row_id).cast("bigint").alias("id"),
        F.to_json(F.struct(*visits.columns), ROW).alias("payload"))
    given = rows.groupBy("key").transformWithStateInPandas(_FirstVisits(keep_days), "payload STRING, is_late BOOLEAN", "append", "None")
    return given.select(F.from_json("payload", visits.schema, ROW).alias("r"), "is_late").select("r.*", "is_late")
