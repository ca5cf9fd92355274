"""Order wide table: orders joined with their details, then with six dimensions."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brooklet.functions.times import age_years, from_text, order_time_columns
from brooklet.operators.joins import interval_join, lookup, stream_interval_join
from brooklet.operators.wide_rows import order_wide
from brooklet.plans.topic_sink import Broker, to_topics
from brooklet.sources.topics import to_records
from brooklet.streaming import runner

# Topics, and how far apart an order and its details may be.
TOPIC_ORDER, TOPIC_DETAIL, TOPIC_WIDE = "dwd_order_info", "dwd_order_detail", "dwm_order_wide"
SPAN = (timedelta(seconds=-5), timedelta(seconds=5))

# Fields of orders and their details.
MONEY = "DECIMAL(18,2)"
ORDER_SCHEMA = (
    f"id BIGINT, province_id BIGINT, order_status STRING, user_id BIGINT, total_amount {MONEY},"
    f" activity_reduce_amount {MONEY}, coupon_reduce_amount {MONEY}, original_total_amount {MONEY},"
    f" feight_fee {MONEY}, expire_time STRING, create_time STRING, operate_time STRING"
)
DETAIL_SCHEMA = (
    f"id BIGINT, order_id BIGINT, sku_id BIGINT, order_price {MONEY}, sku_num BIGINT, sku_name STRING,"
    f" create_time STRING, split_total_amount {MONEY}, split_activity_amount {MONEY},"
    f" split_coupon_amount {MONEY}"
)

# Columns of the all-text dimension tables, and the wide row's names for them.
DIMENSIONS = {
    "user": {"GENDER": "user_gender", "BIRTHDAY": "_birthday"},
    "province": {
        "NAME": "province_name", "AREA_CODE": "province_area_code", "ISO_CODE": "province_iso_code",
        "ISO_3166_2": "province_3166_2_code",
    },
    "sku": {"CATEGORY3_ID": "category3_id", "SPU_ID": "spu_id", "TM_ID": "tm_id"},
    "spu": {"SPU_NAME": "spu_name"},
    "trademark": {"TM_NAME": "tm_name"},
    "category": {"NAME": "category3_name"},
}


def parse_orders(records: DataFrame) -> DataFrame:
    rows = records.select(F.from_json("value", ORDER_SCHEMA).alias("order"))
    created = from_text(F.col("order.create_time"))
    order = F.col("order")
    for name, value in order_time_columns(created).items():
        order = order.withField(name, value)
    return rows.select(F.col("order.id").alias("order_id"), created.alias("order_ts"), order.alias("order"))


def parse_details(records: DataFrame) -> DataFrame:
    rows = records.select(F.from_json("value", DETAIL_SCHEMA).alias("detail"))
    return rows.select("detail.order_id", from_text(F.col("detail.create_time")).alias("detail_ts"), "detail")


def _look_up(rows: DataFrame, dimensions: dict[str, DataFrame], name: str, key: str) -> DataFrame:
    columns = [F.col(source).alias(target) for source, target in DIMENSIONS[name].items()]
    return lookup(rows, dimensions[name].select(F.col("ID").alias("_id"), *columns), key, "_id")


def widen(joined: DataFrame, dimensions: dict[str, DataFrame], as_of: Column) -> DataFrame:
    """Wide rows of joined orders and details. ``dimensions`` holds all-text tables with an ``ID``.

    What hangs on the sku is resolved on the sku table first, so that the fact rows meet
    three dimensions and not six. A missing dimension row leaves nulls.
    """
    sku = dimensions["sku"].select("ID", *[F.col(s).alias(t) for s, t in DIMENSIONS["sku"].items()])
    for name, key in (("spu", "spu_id"), ("trademark", "tm_id"), ("category", "category3_id")):
        sku = _look_up(sku, dimensions, name, key)
    sku = sku.withColumns({c: F.col(c).try_cast("bigint") for c in ("spu_id", "tm_id", "category3_id")})
    rows = joined.select(*order_wide("order", "detail")).withColumns(
        {f"_{c}": F.col(c).cast("string") for c in ("user_id", "province_id", "sku_id")})
    rows = _look_up(rows, dimensions, "user", "_user_id")
    rows = _look_up(rows, dimensions, "province", "_province_id")
    rows = lookup(rows, sku, "_sku_id", "ID")
    age = age_years(F.col("_birthday").try_cast("date"), as_of)
    return rows.withColumn("user_age", age).drop("_user_id", "_province_id", "_sku_id", "_birthday")


def build(orders: DataFrame, details: DataFrame, dimensions: dict[str, DataFrame], as_of: Column) -> DataFrame:
    """The whole job on tables of topic records."""
    joined = interval_join(
        parse_orders(orders), parse_details(details), ["order_id"], "order_ts", "detail_ts", *SPAN)
    return widen(joined, dimensions, as_of)


def start(
    orders: DataFrame, details: DataFrame, current_dimensions: Callable[[SparkSession], dict[str, DataFrame]],
    broker: Broker, checkpoint: str,
) -> StreamingQuery:
    """The job on streams. Dimensions are read anew for every micro-batch, so updates show."""
    joined = stream_interval_join(
        parse_orders(orders).withWatermark("order_ts", "0 seconds"),
        parse_details(details).withWatermark("detail_ts", "0 seconds"),
        ["order_id"], "order_ts", "detail_ts", *SPAN)

    def outputs(batch: DataFrame) -> dict[str, DataFrame]:
        wide = widen(batch, current_dimensions(batch.sparkSession), F.current_date())
        return {TOPIC_WIDE: to_records(wide, TOPIC_WIDE, F.to_json(F.struct(*wide.columns)))}

    return runner.start(joined, to_topics(broker, outputs), checkpoint)
