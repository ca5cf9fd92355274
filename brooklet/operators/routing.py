"""Parsing, cleaning and routing of single records; nothing here shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"


def parse_json(df: DataFrame, column: str, schema: str, into: str = "record") -> DataFrame:
    """JSON text to a typed struct column."""
    return df.withColumn(into, F.from_json(column, schema))


def to_json_text(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns))


def parse_lines(df: DataFrame, line: str, fields: dict[str, str], separator: str = ",") -> DataFrame:
    """Delimited text to typed columns; a field that does not fit its type is null."""
    parts = F.split(F.col(line), f"\\Q{separator}\\E")
    return df.select(*[
        F.trim(F.get(parts, F.lit(i))).try_cast(kind).alias(name)
        for i, (name, kind) in enumerate(fields.items())
    ])


def mark_malformed(
    df: DataFrame, column: str, schema: str, into: str = "record", flag: str = "is_dirty"
) -> DataFrame:
    """Parse JSON text and flag the rows whose text does not parse."""
    parsed = F.from_json(column, f"{schema}, {CORRUPT} STRING", {"columnNameOfCorruptRecord": CORRUPT})
    return (
        df.withColumn(into, parsed)
        .withColumn(flag, F.col(into).isNull() | F.col(f"{into}.{CORRUPT}").isNotNull())
        .withColumn(into, F.col(into).dropFields(CORRUPT))
    )


def split_malformed(
    df: DataFrame, column: str, schema: str, into: str = "record"
) -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and the raw rows that do not parse."""
    marked = mark_malformed(df, column, schema, into)
    return marked.where(~F.col("is_dirty")).drop("is_dirty"), marked.where("is_dirty").select(df.columns)


def with_route(df: DataFrame, routes: dict[str, Column], default: str, into: str = "route") -> DataFrame:
    """Name of the first route whose condition holds."""
    choice = None
    for name, condition in routes.items():
        choice = F.when(condition, name) if choice is None else choice.when(condition, name)
    return df.withColumn(into, F.lit(default) if choice is None else choice.otherwise(F.lit(default)))


def side_outputs(df: DataFrame, routes: dict[str, Column], default: str) -> dict[str, DataFrame]:
    """One DataFrame per route; every row is in exactly one."""
    routed = with_route(df, routes, default, "_route")
    return {
        name: routed.where(F.col("_route") == name).drop("_route") for name in [*routes, default]
    }


# Application logs ---------------------------------------------------------------------

# Fields of application logs.
LOG_SCHEMA = (
    "common STRUCT<ar STRING, ba STRING, ch STRING, is_new STRING, md STRING, mid STRING, os STRING,"
    " uid STRING, vc STRING>,"
    " start STRUCT<entry STRING, loading_time BIGINT, open_ad_id BIGINT, open_ad_ms BIGINT,"
    " open_ad_skip_ms BIGINT>,"
    " displays ARRAY<STRUCT<display_type STRING, item STRING, item_type STRING, `order` INT, pos_id INT>>,"
    " page STRUCT<during_time BIGINT, page_id STRING, last_page_id STRING>,"
    " ts BIGINT"
)


def log_route(start: Column) -> Column:
    """A log with a start part is a start log, any other a page log."""
    return F.when(start.isNotNull(), "start").otherwise("page")


def explode_nested(df: DataFrame, array: str, parent: dict[str, Column], into: str = "item") -> DataFrame:
    """One row per array element, with fields of the parent row added to the element."""
    out = df.select("*", F.explode(array).alias(into))
    element = F.col(into)
    for name, value in parent.items():
        element = element.withField(name, value)
    return out.withColumn(into, element)


def route_logs(logs: DataFrame) -> dict[str, DataFrame]:
    """Start, page and display outputs of parsed logs; displays carry their ``page_id``."""
    routed = logs.withColumn("_route", log_route(F.col("start")))
    pages = routed.where(F.col("_route") == "page").drop("_route")
    displays = explode_nested(pages, "displays", {"page_id": F.col("page.page_id")}, "display")
    return {
        "start": routed.where(F.col("_route") == "start").drop("_route"),
        "page": pages,
        "display": displays.select("display"),
    }


# Sets ---------------------------------------------------------------------------------


def connect(*sides: tuple[DataFrame, dict[str, Column]]) -> DataFrame:
    """Differently typed inputs, each mapped to the common columns, as one bag of rows."""
    mapped = [df.select(*[value.alias(name) for name, value in columns.items()]) for df, columns in sides]
    result = mapped[0]
    for other in mapped[1:]:
        result = result.unionByName(other)
    return result


def prune_map(image: Column, allowed: Column) -> Column:
    """Only the map entries with the allowed names."""
    return F.map_filter(image, lambda key, value: F.array_contains(allowed, key))


# JSON objects of unknown fields --------------------------------------------------------

OBJECT = "map<string,variant>"


def is_object(text: Column) -> Column:
    """Whether text is a JSON object, whatever its fields."""
    # Of JSON, what begins with a brace is an object, so its schema need not be told.
    opened = F.ltrim(text, F.lit(" \t\n\r")).startswith("{")
    return F.coalesce(opened & F.try_parse_json(text).isNotNull(), F.lit(False))


def json_object(text: Column) -> Column:
    """A JSON object as a map, which keeps every field with its type."""
    return F.from_json(text, OBJECT)


def put(entries: Column, name: str, value: Column) -> Column:
    """A map of variants with one field set to the value of some JSON text."""
    others = F.map_filter(entries, lambda key, _: key != name)
    return F.map_concat(others, F.create_map(F.lit(name), F.parse_json(value)))
