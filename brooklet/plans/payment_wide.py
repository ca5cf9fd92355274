"""Payment wide table: payments joined with the wide order rows they pay for."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brooklet.functions.times import from_text
from brooklet.operators.joins import interval_join, stream_interval_join
from brooklet.operators.wide_rows import payment_wide
from brooklet.plans.order_wide import MONEY
from brooklet.plans.topic_sink import Broker, to_topics
from brooklet.sources.topics import to_records
from brooklet.streaming import runner

# Topics, and how far the order may lie before or after its payment.
TOPIC_PAYMENT, TOPIC_ORDER_WIDE, TOPIC_WIDE = "dwd_payment_info", "dwm_order_wide", "dwm_payment_wide"
SPAN = (timedelta(minutes=-15), timedelta(seconds=30))

# Fields of payments and of wide order rows.
PAYMENT_SCHEMA = (
    f"id BIGINT, order_id BIGINT, user_id BIGINT, total_amount {MONEY}, subject STRING,"
    " payment_type STRING, create_time STRING, callback_time STRING"
)
ORDER_WIDE_SCHEMA = (
    f"detail_id BIGINT, order_id BIGINT, sku_id BIGINT, order_price {MONEY}, sku_num BIGINT, sku_name STRING,"
    f" province_id BIGINT, order_status STRING, user_id BIGINT, total_amount {MONEY},"
    f" activity_reduce_amount {MONEY}, coupon_reduce_amount {MONEY}, original_total_amount {MONEY},"
    f" feight_fee {MONEY}, split_feight_fee {MONEY}, split_activity_amount {MONEY}, split_coupon_amount {MONEY},"
    f" split_total_amount {MONEY}, expire_time STRING, create_time STRING, operate_time STRING,"
    " create_date STRING, create_hour STRING, province_name STRING, province_area_code STRING,"
    " province_iso_code STRING, province_3166_2_code STRING, user_age INT, user_gender STRING, spu_id BIGINT,"
    " tm_id BIGINT, category3_id BIGINT, spu_name STRING, tm_name STRING, category3_name STRING"
)


def parse(records: DataFrame, schema: str, side: str) -> DataFrame:
    rows = records.select(F.from_json("value", schema).alias(side))
    return rows.select(f"{side}.order_id", from_text(F.col(f"{side}.create_time")).alias(f"{side}_ts"), side)


def sides(payments: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    return parse(payments, PAYMENT_SCHEMA, "payment"), parse(orders, ORDER_WIDE_SCHEMA, "wide")


def merged(joined: DataFrame) -> DataFrame:
    fields = {side: joined.schema[side].dataType.fieldNames() for side in ("payment", "wide")}
    return joined.select(*payment_wide("payment", fields["payment"], "wide", fields["wide"]))


def build(payments: DataFrame, orders: DataFrame) -> DataFrame:
    left, right = sides(payments, orders)
    return merged(interval_join(left, right, ["order_id"], "payment_ts", "wide_ts", *SPAN))


def start(payments: DataFrame, orders: DataFrame, broker: Broker, checkpoint: str) -> StreamingQuery:
    left, right = sides(payments, orders)
    joined = merged(stream_interval_join(
        left.withWatermark("payment_ts", "0 seconds"), right.withWatermark("wide_ts", "0 seconds"),
        ["order_id"], "payment_ts", "wide_ts", *SPAN))
    records = to_records(joined, TOPIC_WIDE, F.to_json(F.struct(*joined.columns)))
    return runner.start(records, to_topics(broker, lambda batch: {TOPIC_WIDE: batch}), checkpoint)
