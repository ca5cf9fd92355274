"""Patterns of events within a key, in order: begin, next, followed by, times, within.

A pattern is a row of stages. A run begins at every row that meets the first stage; it goes on with the
first later row that meets the next stage, and ends without a match where a ``next`` stage finds another
row. So what becomes of a run at a row depends on the stage and on the rows after it only: one backward
running value per stage carries the outcome of the runs that wait for it, and the stages chain. Running
values split large keys, so do patterns.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.functions.times import span
from brooklet.operators.ordered import BLOCK_ROWS, find_splits, latest, running


@dataclass(frozen=True)
class Stage:
    condition: Column
    strict: bool  # Whether the very next row must meet it.


@dataclass(frozen=True)
class Pattern:
    """``Pattern.begin(view).next(view).within(limit)``, for instance."""

    stages: tuple[Stage, ...]
    limit: timedelta | None = None

    @classmethod
    def begin(cls, condition: Column) -> Pattern:
        return cls((Stage(condition, False),))

    def next(self, condition: Column) -> Pattern:
        """The next row of the key must meet this."""
        return replace(self, stages=(*self.stages, Stage(condition, True)))

    def followed_by(self, condition: Column) -> Pattern:
        """Some later row must meet this; rows in between do not matter."""
        return replace(self, stages=(*self.stages, Stage(condition, False)))

    def times(self, n: int, consecutive: bool = False) -> Pattern:
        """The last stage ``n`` times, one row after the other if ``consecutive``."""
        if n < 1:
            raise ValueError("a stage is there once at least")
        return replace(self, stages=(*self.stages, *[Stage(self.stages[-1].condition, consecutive)] * (n - 1)))

    def within(self, limit: timedelta) -> Pattern:
        """The last row must come less than ``limit`` after the first one."""
        return replace(self, limit=limit)

    def met(self, stage: int) -> Column:
        return F.coalesce(self.stages[stage].condition, F.lit(False))


MATCH, TIMEOUT, DEAD, OPEN = "match", "timeout", "dead", "open"


def match_pattern(
    df: DataFrame, keys: list[str], time: str, order: list[str], row_id: str, pattern: Pattern, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """How the runs of a pattern end: ``df``'s row that begins one, with ``reason`` and ``met``.

    ``reason`` is ``match`` or ``timeout``; runs that a ``next`` stage ends are not there, and neither are runs
    without a limit that still wait. A run times out when a row comes ``limit`` or more after its first one,
    or the input ends. ``met`` lists the ids of the rows that met the stages in time, the first one included.
    ``order`` begins with the time and is unique within a key; null keys are a key, conditions that are null
    are not met, and a null time neither times out nor is late.
    """
    splits = find_splits(df, keys, order, block_rows)
    point = F.array(F.struct(F.col(time).alias("at"), F.col(row_id).alias("id")))
    none = F.slice(point, 1, 0)

    def outcome(kind: Column | str, hits: Column) -> Column:
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.struct(kind.alias("kind"), F.col(time).alias("at"), hits.alias("hits"))

    rows, last = df, len(pattern.stages) - 1
    for stage in range(last, 0, -1):
        if stage == last:
            met = outcome(MATCH, point)
        else:
            after = F.col(f"_after_{stage + 1}")
            met = F.struct(
                F.coalesce(after["kind"], F.lit(OPEN)).alias("kind"), F.coalesce(after["at"], F.col(time)).alias("at"),
                F.concat(point, F.coalesce(after["hits"], none)).alias("hits"))
        value = F.when(pattern.met(stage), met)
        if pattern.stages[stage].strict:
            value = value.otherwise(outcome(DEAD, none))
        rows = running(
            rows, keys, order, {f"_after_{stage}": latest(value, inclusive=False)}, backwards=True, splits=splits, keep_block=True)
    begun = rows.where(pattern.met(0))
    if not last:
        return begun.select(*df.columns, F.lit(MATCH).alias("reason"), F.array(row_id).alias("met"))
    after = F.col("_after_1")
    kind = F.coalesce(after["kind"], F.lit(OPEN))
    reason, in_time = F.when(kind == MATCH, MATCH), F.coalesce(after["hits"], none)
    if pattern.limit is not None:
        length = span(pattern.limit)
        late = F.coalesce(after["at"] - F.col(time) >= length, F.lit(False)) & (kind != OPEN)
        reason = F.when((kind == OPEN) | late, TIMEOUT).when(kind == MATCH, MATCH)
        in_time = F.filter(in_time, lambda h: F.coalesce(h["at"] - F.col(time) < length, F.lit(True)))
    met = F.concat(F.array(row_id), F.transform(in_time, lambda h: h["id"]))
    return begun.select(*df.columns, reason.alias("reason"), met.alias("met")).where(F.col("reason").isNotNull())
