"""Keyed state over streams.

A key's rows of one micro-batch are ordered in memory, so the source's per-trigger limits
(files, bytes or offsets) bound them; state lives in the state store. Rows that cannot
change state should be filtered out first.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from brooklet.functions.times import micros, span_micros
from brooklet.functions.user import Aggregate

Batches = Iterator[pd.DataFrame]


def _ordered(batches: Batches, order: list[str]) -> pd.DataFrame | None:
    frames = [b for b in batches if len(b)]
    if not frames:
        return None
    rows = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    return rows.sort_values(order)


#: Fixed value: what is kept for many keys at once is dealt to so many buckets.
BUCKETS = 1024


#: JSON of rows: times to the microsecond, nulls kept.
ROW = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def packed(rows: pd.DataFrame) -> bytes:
    """A table as state, compressed: texts of many rows are much alike, and the store and its copies hold it as it is."""
    table, sink = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(state: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(pa.py_buffer(bytes(state))).read_pandas()


def correct_new_flag(df: DataFrame, device: str, order: list[str], flag: str = "is_new") -> DataFrame:
    """First claim of a device keeps ``"1"``. ``order`` must be numbers, unique per device.

    Only claims pass through state; other rows go straight on.
    """

    def correct(key: tuple, batches: Batches, state: GroupState) -> Batches:
        if not state.exists:
            rows = _ordered(batches, order)
            if rows is None:
                return
            state.update((True,))
            rows[flag] = ["1"] + ["0"] * (len(rows) - 1)
            yield rows
            return
        for rows in batches:
            yield rows.assign(**{flag: "0"})

    claims = df.where(F.col(flag) == "1")
    others = df.where(F.coalesce(F.col(flag) != "1", F.lit(True)))
    decided = claims.groupBy(device).applyInPandasWithState(
        correct, df.schema, "claimed BOOLEAN", "append", GroupStateTimeout.NoTimeout)
    return decided.unionByName(others)


def first_visits(df: DataFrame, device: str, time: str, entry: Column) -> DataFrame:
    """First arriving entry page per device and day, the earliest of its micro-batch.

    A device's state is all days it has been seen on, one number each, so that a day counts once
    however late and in however many micro-batches it comes. Of a device's rows only the first of
    each day are held.
    """
    visits = df.where(entry).withColumn("visit_date", F.to_date(time))

    def first(key: tuple, batches: Batches, state: GroupState) -> Batches:
        frames = [b.sort_values(time).drop_duplicates("visit_date") for b in batches if len(b)]
        if not frames:
            return
        rows = pd.concat(frames, ignore_index=True).sort_values(time).drop_duplicates("visit_date")
        seen = set(state.get[0]) if state.exists else set()
        numbers = [-1 if d is None or d != d else d.toordinal() for d in rows["visit_date"]]
        new = [n not in seen for n in numbers]
        seen.update(numbers)
        state.update((sorted(seen),))
        if any(new):
            yield rows[new]

    return visits.groupBy(device).applyInPandasWithState(
        first, visits.schema, "days ARRAY<INT>", "append", GroupStateTimeout.NoTimeout)


BOUNCE_STATE = (
    "pending_at BIGINT, pending_id BIGINT, pending_payload STRING, buffer_at ARRAY<BIGINT>,"
    " buffer_id ARRAY<BIGINT>, buffer_entry ARRAY<BOOLEAN>, buffer_payload ARRAY<STRING>"
)


def bounces(
    df: DataFrame, device: str, time: str, row_id: str, entry: Column, limit: timedelta, disorder: str,
    payload: Column | None = None,
) -> DataFrame:
    """Bounced entries ``(device, row_id, reason, payload)`` of a stream.

    Rows wait in state until the watermark has passed them, so they are taken in event-time
    order across micro-batches. The entry waited on is decided by the next row, or by the
    watermark passing its limit. State holds rows of at most the allowed disorder.
    """
    width = span_micros(limit)
    payload = F.lit(None).cast("string") if payload is None else payload
    rows = df.withWatermark(time, disorder).select(
        device, F.col(time).alias("_time"), micros(F.col(time)).alias("_at"), F.col(row_id).alias("_id"),
        entry.alias("_entry"), payload.alias("_payload"))
    out = T.StructType([
        T.StructField(device, rows.schema[device].dataType), T.StructField(row_id, T.LongType()),
        T.StructField("reason", T.StringType()), T.StructField("payload", T.StringType())])

    def watch(key: tuple, batches: Batches, state: GroupState) -> Batches:
        pending, buffer = None, []
        if state.exists:
            at, row, text, *buffered = state.get
            pending = None if at is None else (at, row, True, text)
            buffer = list(zip(*buffered))
        for batch in batches:
            buffer.extend(zip(*[batch[c].tolist() for c in ("_at", "_id", "_entry", "_payload")]))
        clock = state.getCurrentWatermarkMs()
        passed = sorted((r for r in buffer if r[0] <= clock * 1000), key=lambda r: r[:2])
        buffer = [r for r in buffer if r[0] > clock * 1000]
        found = []
        for row in passed:
            if pending and row[0] - pending[0] >= width:
                found.append((*pending, "timeout"))
            elif pending and row[2]:
                found.append((*pending, "reentry"))
            pending = row if row[2] else None
        if pending and pending[0] + width <= clock * 1000:
            found.append((*pending, "timeout"))
            pending = None
        if pending or buffer:
            at, row, _, text = pending or (None, None, None, None)
            columns = [list(c) for c in zip(*buffer)] or [[], [], [], []]
            state.update((at, row, text, *columns))
            wake = min([r[0] for r in buffer] + ([at + width] if pending else []))
            state.setTimeoutTimestamp(max(wake // 1000, clock + 1))
        elif state.exists:
            state.remove()
        if found:
            yield pd.DataFrame({
                device: key[0], row_id: [f[1] for f in found], "reason": [f[4] for f in found],
                "payload": [f[3] for f in found]})

    return rows.groupBy(device).applyInPandasWithState(
        watch, out, BOUNCE_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def _flags(lists: pd.Series, size: int) -> np.ndarray:
    """Lists of flags as a table of ones and zeros with ``size`` columns; lists may be shorter, longer or null."""
    out = np.zeros((len(lists), size), dtype="int64")
    lengths = np.array([0 if x is None else min(len(x), size) for x in lists])
    if lengths.sum():
        row = np.repeat(np.arange(len(lists)), lengths)
        column = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[row, column] = np.concatenate([np.asarray(x[:n], dtype=object) for x, n in zip(lists, lengths) if n]) == True  # noqa: E712
    return out


def _walked(lists: pd.Series, step: int, n: int) -> tuple[list[tuple[int, int]], tuple[int, int]]:
    """The state of a sequence after each row, and after the last: only rows that meet the step waited for are
    gone to, by the next such row of each step."""
    length = max((len(x) for x in lists if x is not None), default=0)
    flags, rows = _flags(lists, length), len(lists)
    step = step if step < length else 0
    following = np.full((rows + 1, length), rows)
    for i in range(length):
        places = np.where(flags[:, i] > 0, np.arange(rows), rows)
        following[:rows, i] = np.minimum.accumulate(places[::-1])[::-1]
    at, states = [0], [(step, n)]
    row = int(following[0, step]) if length and rows else rows
    while row < rows:
        step, n = (0, n + 1) if step == length - 1 else (step + 1, n)
        at.append(row)
        states.append((step, n))
        row = int(following[row + 1, step])
    # Each row has the state of the last change at or before it.
    last = np.searchsorted(np.array(at[1:], dtype="int64"), np.arange(rows), side="right")
    return [states[i] for i in last], states[-1]


RULE_STATE = "counts ARRAY<BIGINT>, step INT, sequences BIGINT"


def rule_progress(
    rows: DataFrame, keys: list[str], order: list[str], conditions: int,
    start: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Fan-out rows with running ``count_i`` and ``sequences``, from state per key.

    ``start`` names columns holding the baseline (counts, step, sequences), which are used
    when a key is first seen.
    """
    counters = [f"count_{i}" for i in range(conditions)]
    out = T.StructType([*rows.schema.fields, *[T.StructField(c, T.LongType()) for c in counters],
                        T.StructField("sequences", T.LongType())])

    def advance(key: tuple, batches: Batches, state: GroupState) -> Batches:
        batch = _ordered(batches, order)
        if batch is None:
            return
        if state.exists:
            # Rules may have other conditions and steps than when the state was kept.
            counts, step, sequences = state.get
            counts = [*counts, *[0] * conditions][:conditions]
        else:
            counts, step, sequences = [0] * conditions, 0, 0
            if start:
                first = batch.iloc[0]
                base = first[start[0]]
                if base is not None:
                    counts = [*[int(c) for c in base], *[0] * conditions][:conditions]
                    step, sequences = int(first[start[1]]), int(first[start[2]])
        counted = np.asarray(counts, dtype="int64") + np.cumsum(_flags(batch["hits"], conditions), axis=0)
        done, (step, sequences) = _walked(batch["steps"], step, sequences)
        state.update(([int(c) for c in counted[-1]], step, sequences))
        yield batch.assign(**{c: counted[:, i] for i, c in enumerate(counters)}, sequences=[n for _, n in done])

    return rows.groupBy(*keys).applyInPandasWithState(
        advance, out, RULE_STATE, "append", GroupStateTimeout.NoTimeout)


def sequence_progress(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` plus ``step`` and ``n`` after each row; ``hits`` flags the steps a row satisfies."""
    out = T.StructType([*df.schema.fields, T.StructField("step", T.IntegerType()), T.StructField("n", T.LongType())])

    def advance(key: tuple, batches: Batches, state: GroupState) -> Batches:
        batch = _ordered(batches, order)
        if batch is None:
            return
        done, (step, n) = _walked(batch["hits"], *(state.get if state.exists else (0, 0)))
        state.update((step, n))
        yield batch.assign(step=[s for s, _ in done], n=[n for _, n in done])

    return df.groupBy(*keys).applyInPandasWithState(
        advance, out, "step INT, n BIGINT", "append", GroupStateTimeout.NoTimeout)


def _comparable(name: str, into: str, kind: T.DataType) -> list[Column]:
    """A column without nulls, and whether it is null: nulls would make doubles of whole numbers."""
    value = F.coalesce(F.col(name), F.lit("0").try_cast(kind))
    return [F.col(name).isNull().alias(f"{into}_null"), value.alias(into)]


def running_argmin(df: DataFrame, keys: list[str], order: list[str], by: str, buckets: int = BUCKETS) -> DataFrame:
    """``df`` with the row of its key with the least ``by`` so far in ``least_`` columns; ties
    keep the first row, and a null ``by`` is greater than any value.

    Keys are dealt to ``buckets``, whose rows are taken all at once; the state of a bucket is the least row of
    each of its keys. A checkpoint keeps the number of buckets.
    """
    tracked = [c for c in df.columns if c not in keys]
    fields = [df.schema[c] for c in tracked]
    names = [f"_at{i}" for i in range(len(order))]
    ranked = [c for n in reversed(names) for c in (n, f"{n}_null")]
    kept = ["_key", "_by_null", "_by", "_row"]
    rows = df.select(
        F.to_json(F.struct(*keys), ROW).alias("_key"), *_comparable(by, "_by", df.schema[by].dataType),
        *[c for n, o in zip(names, order) for c in _comparable(o, n, df.schema[o].dataType)],
        F.to_json(F.struct(*df.columns), ROW).alias("_row"))

    def advance(key: tuple, batches: Batches, state: GroupState) -> Batches:
        frames = [b for b in batches if len(b)]
        if not frames:
            return
        before = unpacked(state.get[0]) if state.exists else None
        # The least rows so far go ahead of the new ones.
        held = 0 if before is None else len(before)
        new = pd.concat(frames, ignore_index=True)
        batch = new[kept] if before is None else pd.concat([before, new[kept]], ignore_index=True)
        number, is_new = pd.factorize(batch["_key"])[0], np.arange(len(batch)) >= held
        ties = [np.append(np.zeros(held, dtype="int64"), pd.factorize(new[c], sort=True)[0]) for c in ranked]
        place = np.lexsort([*ties, is_new, number])
        number, is_new = number[place], is_new[place]
        rank, values = pd.factorize(batch["_by"], sort=True)
        rank = np.where(batch["_by_null"].to_numpy(dtype=bool) | (rank < 0), len(values), rank)[place]
        # Ranks of a later key are less than those of all keys before, so one running minimum serves all.
        least = np.minimum.accumulate(rank - _turns(number) * (len(values) + 1))
        takes_over = np.append(True, least[1:] < least[:-1])
        least = np.maximum.accumulate(np.where(takes_over, np.arange(len(place)), 0))
        row = batch["_row"].to_numpy(dtype=object)[place]
        last = np.append(number[1:] != number[:-1], True)
        state.update((packed(batch[kept].iloc[place[least[last]]]),))
        yield pd.DataFrame({"_row": row[is_new], "_least": row[least[is_new]]})

    found = rows.withColumn("_bucket", bucket("_key", buckets)).groupBy("_bucket").applyInPandasWithState(
        advance, "_row STRING, _least STRING", "least BINARY", "append", GroupStateTimeout.NoTimeout)
    whole, part = (F.from_json(c, T.StructType(of), ROW).alias(c) for c, of in (("_row", df.schema.fields), ("_least", fields)))
    return found.select(whole, part).select("_row.*", *[F.col(f"_least.{c}").alias(f"least_{c}") for c in tracked])


def _turns(number: np.ndarray) -> np.ndarray:
    """Numbers of stretches of equal values, from 0."""
    return np.append(0, np.cumsum(number[1:] != number[:-1]))


def count_windows(
    df: DataFrame, keys: list[str], order: list[str], values: list[str], size: int, user: Aggregate,
    slide: int | None = None,
) -> DataFrame:
    """After every ``slide`` rows of a key, a user aggregate over its last ``size`` rows or fewer.

    Without ``slide`` windows do not overlap and fire only when full. ``rows_seen`` is the
    number of the last row. State holds fewer than ``size`` rows per key.
    """
    slide = slide or size
    key_fields = [df.schema[k] for k in keys]
    outputs = T.StructType.fromDDL(user.output).fields
    out = T.StructType([*key_fields, T.StructField("rows_seen", T.LongType()), *outputs])
    state_schema = T.StructType([
        T.StructField("seen", T.LongType()), *[T.StructField(v, T.ArrayType(df.schema[v].dataType)) for v in values]])

    def advance(key: tuple, batches: Batches, state: GroupState) -> Batches:
        batch = _ordered(batches, order)
        if batch is None:
            return
        seen, held = 0, []
        if state.exists:
            seen, *columns = state.get
            held = list(zip(*columns))
        fired = []
        for row in zip(*[batch[v].tolist() for v in values]):
            held.append(row)
            held, seen = held[-size:], seen + 1
            if seen % slide == 0:
                total = user.create()
                for kept in held:
                    total = user.add(total, *kept)
                fired.append((*key, seen, *user.result(total)))
        kept = held[1 - size:] if size > 1 else []
        state.update((seen, *([list(c) for c in zip(*kept)] or [[] for _ in values])))
        if fired:
            yield pd.DataFrame(fired, columns=out.fieldNames())

    rows = df.select(*dict.fromkeys([*keys, *order, *values]))
    return rows.groupBy(*keys).applyInPandasWithState(
        advance, out, state_schema, "append", GroupStateTimeout.NoTimeout)
