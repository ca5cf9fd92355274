"""Ordered behaviour sequences: a step counter that restarts after the last step.

The input has one boolean array per row, ``hits``: which steps the row satisfies. State is
(step, n): the step waited for, and how often the sequence was completed.

Rows are shuffled by key, sorted within partitions, and walked batch by batch, so memory
holds one Arrow batch however many rows a key has. Going through a run of rows maps each
starting step to (final step, completions), and such maps chain: a key with too many rows
for one task is cut into blocks along its order, each block is walked alone from every
step, and the block maps are chained.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from brooklet.operators.ordered import (
    BLOCK, BLOCK_ROWS, Splits, find_splits, join_small, running, running_count, with_blocks,
)

Batches = Iterator[pa.RecordBatch]
NAN = float("nan")


def step_hits(steps: list[Column]) -> Column:
    return F.array(*steps)


def _satisfied() -> Column:
    """The numbers of the steps that ``hits`` flags; any number of steps."""
    return F.array_compact(F.transform("hits", lambda hit, i: F.when(hit, i)))


def _runs(batch: pa.RecordBatch, group: list[str]) -> Iterator[tuple[tuple, int, int]]:
    """Stretches of equal group columns in a sorted batch: group, first row, row after the last.

    Nulls are equal to one another, and so are NaNs.
    """
    changed = np.ones(batch.num_rows, dtype=bool)
    changed[1:] = False
    columns = [batch.column(c) for c in group]
    for column in columns:
        here, before = column.slice(1), column.slice(0, batch.num_rows - 1)
        same = pc.or_(pc.fill_null(pc.equal(here, before), False), pc.and_(here.is_null(), before.is_null()))
        if pa.types.is_floating(column.type):
            same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(here), pc.is_nan(before)), False))
        changed[1:] |= ~same.to_numpy(zero_copy_only=False)
    begins = np.flatnonzero(changed).tolist()
    for begin, end in zip(begins, [*begins[1:], batch.num_rows]):
        key = (c[begin].as_py() for c in columns)
        yield tuple(NAN if v != v else v for v in key), begin, end


def _next_hits(batch: pa.RecordBatch) -> list[list[int]]:
    """Per step and row, the first row from there on that satisfies the step."""
    n, satisfied = batch.num_rows, batch.column("_steps")
    rows = np.repeat(np.arange(n), pc.list_value_length(satisfied).to_numpy(zero_copy_only=False))
    which = satisfied.flatten().to_numpy(zero_copy_only=False)
    out = []
    for step in range(pc.max(batch.column("_last")).as_py() + 1):
        hits = np.full(n, n)
        mine = rows[which == step]
        hits[mine] = mine
        out.append(np.minimum.accumulate(hits[::-1])[::-1].tolist())
    return out


def _advance(next_hits, begin: int, end: int, last: int, state: tuple[int, int], log: list | None = None):
    """State after rows ``begin`` to ``end``; each change of state is logged with its row."""
    step, n = state
    while begin < end and step <= last:
        row = next_hits[step][begin]
        if row >= end:
            break
        step, n = (0, n + 1) if step == last else (step + 1, n)
        if log is not None:
            log.append((row, step, n))
        begin = row + 1
    return step, n


def _sorted_rows(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    return rows.repartition(*group).sortWithinPartitions(*group, *order)


def _block_maps(df: DataFrame, keys: list[str], order: list[str], steps: int, splits: Splits) -> DataFrame:
    """Per key and block, the state after it for each step it may be entered with."""
    rows = df.select(*keys, *order, _satisfied().alias("_steps"), (F.size("hits") - 1).alias("_last"))
    rows = with_blocks(rows.where(F.size("_steps") > 0), splits)
    group, entered = [*keys, BLOCK], range(steps if splits.rows else 1)
    out = T.StructType([
        *rows.select(*group).schema.fields, T.StructField("to_step", T.ArrayType(T.IntegerType())),
        T.StructField("to_n", T.ArrayType(T.LongType()))])

    def walk(batches: Batches) -> Batches:
        current, states = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            next_hits, lasts, done = _next_hits(batch), batch.column("_last").to_pylist(), []
            for key, begin, end in _runs(batch, group):
                if key != current:
                    if current is not None:
                        done.append((current, states))
                    current, states = key, [(step, 0) for step in entered]
                states = [_advance(next_hits, begin, end, lasts[begin], s) for s in states]
            if done:
                yield frame(done)
        if current is not None:
            yield frame([(current, states)])

    def frame(done: list) -> pa.RecordBatch:
        fields = to_arrow_schema(out)
        columns = [*zip(*[key for key, _ in done]), [[s[0] for s in states] for _, states in done], [[s[1] for s in states] for _, states in done]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)

    sorted_rows = _sorted_rows(rows, group if splits.rows else keys, order)
    return sorted_rows.mapInArrow(walk, out)


def sequence_state(
    df: DataFrame, keys: list[str], order: list[str], steps: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The final ``step`` and ``n`` of each key with rows that satisfy some step."""
    splits = find_splits(df, keys, order, block_rows)
    maps = _block_maps(df, keys, order, steps, splits)
    if not splits.rows:
        return maps.select(*keys, F.col("to_step")[0].alias("step"), F.col("to_n")[0].alias("n"))
    # One map per block.
    listed = F.sort_array(F.collect_list(F.struct(BLOCK, "to_step", "to_n")))
    chained = maps.groupBy(*keys).agg(listed.alias("_maps"))

    def chain(state: Column, block: Column) -> Column:
        step, n = F.get(block["to_step"], state["step"]), F.get(block["to_n"], state["step"])
        return F.struct(step.alias("step"), (state["n"] + n).alias("n"))

    start = F.struct(F.lit(0).alias("step"), F.lit(0).cast("bigint").alias("n"))
    return chained.select(*keys, F.aggregate("_maps", start, chain).alias("_final")).select(
        *keys, "_final.step", "_final.n")


def ordered_matches(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Matching rows numbered in order within their key: a key's history list, as rows."""
    return running(df.select(*keys, *order, *columns), keys, order, {"position": running_count()})


def sequence_progress(
    df: DataFrame, keys: list[str], order: list[str], steps: int,
    start: tuple[str, str] | None = None, splits: Splits | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``df`` with the ``step`` and ``n`` after each row in place of ``hits``. A null key is a key.
    Keep ``df`` narrow, as its columns pass through Python.

    ``start`` names columns with the state of the key before its first row.
    """
    start_step, start_n = (F.col(c) for c in start) if start else (F.lit(0), F.lit(0))
    rows = df.withColumns({
        "step": F.coalesce(start_step, F.lit(0)).cast("int"),
        "n": F.coalesce(start_n, F.lit(0)).cast("bigint"),
    })
    if splits is None:
        splits = find_splits(df, keys, order, block_rows)
    group = list(keys)
    if splits.rows:
        group.append(BLOCK)
        maps = _block_maps(splits.large_only(df), keys, order, steps, splits)
        entering = _entering_states(_of_all_blocks(maps, splits, steps), keys)
        # One row per block of a large key, bounded like the cut points.
        rows = join_small(with_blocks(rows, splits), splits.hinted(entering), group, "left").withColumns({
            "n": F.col("n") + F.coalesce(F.get("to_n", F.col("step")), F.lit(0)),
            "step": F.coalesce(F.get("to_step", F.col("step")), F.col("step")),
        })
    columns = [c for c in rows.columns if c in df.columns and c != "hits"] + ["step", "n"]
    rows = rows.select(*columns, *group[len(keys):],
                       _satisfied().alias("_steps"), (F.size("hits") - 1).alias("_last"))
    out = rows.select(*columns)

    def walk(batches: Batches) -> Batches:
        current, state = None, (0, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            next_hits, lasts = _next_hits(batch), batch.column("_last").to_pylist()
            first_step, first_n = batch.column("step").to_pylist(), batch.column("n").to_pylist()
            log: list[tuple[int, int, int]] = []
            for key, begin, end in _runs(batch, group):
                if key != current:
                    current, state = key, (first_step[begin], first_n[begin])
                log.append((begin, *state))
                state = _advance(next_hits, begin, end, lasts[begin], state, log)
            at, step, n = (np.array(c) for c in zip(*log))
            # Each row has the state of the last change at or before it.
            latest = np.searchsorted(at, np.arange(batch.num_rows), side="right") - 1
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in columns[:-2]], pa.array(step[latest].astype(np.int32)), pa.array(n[latest].astype(np.int64))], names=columns)

    return _sorted_rows(rows, group, order).mapInArrow(walk, out.schema)


def _of_all_blocks(maps: DataFrame, splits: Splits, steps: int) -> DataFrame:
    """The block maps, with one that changes nothing for each block without a satisfied step."""
    numbers = F.explode(F.sequence(F.lit(0), F.size("_cuts")))
    every = splits.table(maps).select(*splits.keys, numbers.alias(BLOCK))
    same = F.sequence(F.lit(0), F.lit(steps - 1))
    joined = join_small(every, maps, [*splits.keys, BLOCK], "left")
    return joined.select(
        *splits.keys, F.col(BLOCK).cast(maps.schema[BLOCK].dataType).alias(BLOCK), F.coalesce("to_step", same).alias("to_step"),
        F.coalesce("to_n", F.array_repeat(F.lit(0).cast("bigint"), steps)).alias("to_n"))


def _entering_states(maps: DataFrame, keys: list[str]) -> DataFrame:
    """The block maps chained: for each block the state on entering it, per first step of the key."""

    def chain(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values(BLOCK)
        steps, counts = [], []
        step = np.arange(len(blocks["to_step"].iloc[0]))
        n = np.zeros(len(step), dtype="int64")
        for to_step, to_n in zip(blocks["to_step"], blocks["to_n"]):
            steps.append(step)
            counts.append(n)
            step, n = np.asarray(to_step)[step], n + np.asarray(to_n)[step]
        return blocks.assign(to_step=steps, to_n=counts)

    return maps.groupBy(*keys).applyInPandas(chain, maps.schema)
