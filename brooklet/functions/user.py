"""User code over rows: mappers with any number of outputs, and aggregates with a merge step."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Partial results are handed on once a task holds this many keys.
HELD_KEYS = 50_000
NAN = float("nan")


def map_batches(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Opaque code over Arrow batches; it may return fewer or more rows than it was given."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(run, schema)


@dataclass(frozen=True)
class Aggregate:
    """An incremental aggregate. The accumulator is a tuple in the order of ``state``.

    ``add`` takes the accumulator and the values of one row, ``merge`` two accumulators;
    ``result`` turns one into output values.
    """

    create: Callable[[], tuple]
    add: Callable[..., tuple]
    merge: Callable[[tuple, tuple], tuple]
    result: Callable[[tuple], tuple]
    state: str
    output: str


def aggregate(df: DataFrame, keys: list[str], values: list[str], user: Aggregate) -> DataFrame:
    """One row per key. Each task reduces its own rows to one accumulator per key before the
    shuffle, so a busy key arrives as one row per task and not with all its rows. The
    accumulators are then merged in key order, batch by batch. Nulls come as ``None``, also in
    keys, where they are one key."""
    key_fields = df.select(*keys).schema.fields
    states = [T.StructField(f"_{f.name}", f.dataType) for f in T.StructType.fromDDL(user.state)]
    outputs = T.StructType.fromDDL(user.output).fields
    state_names = [f.name for f in states]

    partial_schema, result_schema = T.StructType([*key_fields, *states]), T.StructType([*key_fields, *outputs])

    def frame(found: list[tuple], schema: T.StructType) -> pa.RecordBatch:
        fields = to_arrow_schema(schema)
        columns = list(zip(*[(*key, *value) for key, value in found])) or [[] for _ in fields]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)

    def pairs(batch: pa.RecordBatch, columns: list[str]) -> Iterator[tuple[tuple, tuple]]:
        def rows(names: list[str]):
            return zip(*[batch.column(c).to_pylist() for c in names])

        # A NaN differs from itself, so one stands for all.
        known = (tuple(NAN if v != v else v for v in key) for key in rows(keys))
        return zip(known, rows(columns))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            for key, row in pairs(batch, values):
                held[key] = user.add(held[key] if key in held else user.create(), *row)
            if len(held) > HELD_KEYS:
                yield frame(list(held.items()), partial_schema)
                held = {}
        if held:
            yield frame(list(held.items()), partial_schema)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total = None, None
        for batch in batches:
            done = []
            for key, state in pairs(batch, state_names):
                if key == current:
                    total = user.merge(total, state)
                    continue
                if current is not None:
                    done.append((current, user.result(total)))
                current, total = key, state
            yield frame(done, result_schema)
        if current is not None:
            yield frame([(current, user.result(total))], result_schema)

    partials = df.select(*keys, *values).mapInArrow(reduce, partial_schema)
    placed = partials.repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(combine, result_schema)
