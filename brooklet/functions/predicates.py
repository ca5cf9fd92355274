"""Conditions of marketing rules as Spark columns.

Literals always enter as column values, never as SQL text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b,
    ">": lambda a, b: a > b,
    "<": lambda a, b: a < b,
    ">=": lambda a, b: a >= b,
    "<=": lambda a, b: a <= b,
}


@dataclass(frozen=True)
class Attribute:
    name: str
    compare: str
    value: str

    def __post_init__(self):
        if self.compare not in COMPARE:
            raise ValueError(f"unknown attribute comparison {self.compare!r}")


@dataclass(frozen=True)
class EventSpec:
    """An event condition: id, inclusive optional window, attributes that must all hold."""

    event_id: str | None
    attributes: tuple[Attribute, ...] = ()
    window_start: str | None = None
    window_end: str | None = None
    event_count: int = 0
    condition_id: int = 0

    @classmethod
    def parse(cls, spec: dict, window: dict | None = None) -> EventSpec:
        """From rule JSON; ``window`` supplies the window of an enclosing sequence."""
        window = window or {}
        return cls(
            event_id=spec.get("eventId") or None,
            attributes=tuple(
                Attribute(a["attributeName"], a["compareType"], str(a["compareValue"]))
                for a in spec.get("attributeParams") or []
            ),
            window_start=spec.get("windowStart") or window.get("windowStart") or None,
            window_end=spec.get("windowEnd") or window.get("windowEnd") or None,
            event_count=int(spec.get("eventCount") or 0),
            condition_id=int(spec.get("conditionId") or 0),
        )


@dataclass(frozen=True)
class EventColumns:
    """Where an event table keeps its parts. ``attribute`` looks an attribute up by name."""

    event_id: str = "event_id"
    time: str = "event_time"
    attribute: Callable[[str], Column] = field(default=lambda name: map_attribute("properties")(name))


def map_attribute(column: str) -> Callable[[str], Column]:
    return lambda name: F.try_element_at(F.col(column), F.lit(name))


def json_attribute(column: str) -> Callable[[str], Column]:
    def look_up(name: str) -> Column:
        if "'" in name:
            raise ValueError(f"attribute name {name!r} holds a quote")
        return F.get_json_object(F.col(column), f"$['{name}']")

    return look_up


def event_predicate(spec: EventSpec, columns: EventColumns) -> Column:
    """True where an event meets ``spec``, else false or null: the form for filters, whose id
    and time parts reach the scan. Attribute values compare as text, missing ones fail."""
    time = F.col(columns.time)
    tests = []
    if spec.event_id is not None:
        tests.append(F.col(columns.event_id) == F.lit(spec.event_id))
    if spec.window_start:
        tests.append(time >= F.lit(spec.window_start).cast("timestamp_ntz"))
    if spec.window_end:
        tests.append(time <= F.lit(spec.window_end).cast("timestamp_ntz"))
    for attribute in spec.attributes:
        actual = columns.attribute(attribute.name)
        tests.append(COMPARE[attribute.compare](actual, F.lit(attribute.value)))
    return all_of(tests)


def event_flag(spec: EventSpec, columns: EventColumns) -> Column:
    """The predicate as a value that is never null."""
    return F.coalesce(event_predicate(spec, columns), F.lit(False))


def event_ids(specs: list[EventSpec], columns: EventColumns) -> Column:
    """Events whose id some of the specs name: a coarse filter that reaches the scan."""
    ids = sorted({s.event_id for s in specs if s.event_id is not None})
    everything = any(s.event_id is None for s in specs)
    return F.lit(True) if everything else F.col(columns.event_id).isin(ids)


def all_of(tests: list[Column]) -> Column:
    result = F.lit(True)
    for index, test in enumerate(tests):
        result = test if index == 0 else result & test
    return result


def any_of(tests: list[Column]) -> Column:
    result = F.lit(False)
    for index, test in enumerate(tests):
        result = test if index == 0 else result | test
    return result


# Fixed value: what counts as a number in a profile condition.
NUMBER = re.compile(r"-?\d+(\.\d+)?")


def profile_predicate(conditions: list[dict], schema: T.StructType) -> Column:
    """All profile conditions together, over a table with one column per tag.

    ``lt gt le ge between`` compare as numbers when the literal is one, else as text. Any
    other comparison is a match: an element of an array tag, or a token of a text tag.
    """
    tests = []
    for condition in conditions:
        tag, compare, value = condition["tagId"], condition["compareType"], str(condition["compareValue"])
        if tag not in schema.fieldNames():
            raise ValueError(f"unknown profile tag {tag!r}")
        tests.append(_profile_test(F.col(tag), schema[tag].dataType, compare, value))
    return all_of(tests)


def _profile_test(tag: Column, kind: T.DataType, compare: str, value: str) -> Column:
    if compare == "between":
        low, high = (part.strip() for part in value.split(","))
        if NUMBER.fullmatch(low) and NUMBER.fullmatch(high):
            return _number(tag, kind).between(F.lit(float(low)), F.lit(float(high)))
        return tag.cast("string").between(F.lit(low), F.lit(high))
    ranges = {"lt": COMPARE["<"], "gt": COMPARE[">"], "le": COMPARE["<="], "ge": COMPARE[">="]}
    if compare in ranges:
        if NUMBER.fullmatch(value):
            return ranges[compare](_number(tag, kind), F.lit(float(value)))
        return ranges[compare](tag.cast("string"), F.lit(value))
    if isinstance(kind, T.ArrayType):
        return F.array_contains(tag, F.lit(value).cast(kind.elementType))
    if isinstance(kind, T.NumericType):
        return _number(tag, kind) == F.lit(value).try_cast("double")
    return F.array_contains(F.split(F.lower(tag), r"\s+"), F.lit(value.lower()))


def _number(tag: Column, kind: T.DataType) -> Column:
    return tag.cast("double") if isinstance(kind, T.NumericType) else tag.try_cast("double")


def combine_results(expression: str, results: dict[str, str]) -> Column:
    """``res_1 && (res_2 || !res_3)`` over boolean columns; ``results`` maps names to columns.

    Only the given names, ``&&``, ``||``, ``!`` and parentheses are let through, so nothing
    else of a rule's text reaches Spark's expression parser.
    """
    words = {"&&": "AND", "||": "OR", "!": "NOT", "(": "(", ")": ")"}
    words.update({name: f"`{column}`" for name, column in results.items()})
    tokens = re.findall(r"&&|\|\||!|\(|\)|\w+|\S", expression)
    unknown = [token for token in tokens if token not in words]
    if unknown or not tokens:
        raise ValueError(f"not allowed in rule expression {expression!r}: {unknown}")
    return F.expr(" ".join(words[token] for token in tokens))
