"""Wide order and payment rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output field -> field of the order row.
ORDER_FIELDS = {
    "order_id": "id", "order_status": "order_status", "create_time": "create_time",
    "create_date": "create_date", "create_hour": "create_hour",
    "activity_reduce_amount": "activity_reduce_amount", "coupon_reduce_amount": "coupon_reduce_amount",
    "original_total_amount": "original_total_amount", "feight_fee": "feight_fee",
    "total_amount": "total_amount", "province_id": "province_id", "user_id": "user_id",
}
# Output field -> field of the order detail row.
DETAIL_FIELDS = {
    "detail_id": "id", "sku_id": "sku_id", "sku_name": "sku_name", "order_price": "order_price",
    "sku_num": "sku_num", "split_activity_amount": "split_activity_amount",
    "split_coupon_amount": "split_coupon_amount", "split_total_amount": "split_total_amount",
}
# Declared in the wide row, filled by neither input.
EMPTY_FIELDS = {"split_feight_fee": "decimal(18,2)", "expire_time": "string", "operate_time": "string"}


def order_wide(order: str, detail: str) -> list[Column]:
    """Columns of the wide order row from two joined structs."""
    return [
        *[F.col(f"{order}.{source}").alias(name) for name, source in ORDER_FIELDS.items()],
        *[F.col(f"{detail}.{source}").alias(name) for name, source in DETAIL_FIELDS.items()],
        *[F.lit(None).cast(kind).alias(name) for name, kind in EMPTY_FIELDS.items()],
    ]


def payment_wide(
    payment: str, payment_fields: list[str], order: str, order_fields: list[str]
) -> list[Column]:
    """Payment and order-wide fields together; the payment wins where both have a field.

    ``id`` and ``create_time`` are renamed, so both creation times are kept.
    """
    renamed_payment = {"id": "payment_id", "create_time": "payment_create_time"}
    renamed_order = {"create_time": "order_create_time"}
    dropped = {"create_date", "create_hour", "expire_time", "operate_time"}
    out = {renamed_payment.get(f, f): F.col(f"{payment}.{f}") for f in payment_fields}
    for field in order_fields:
        name = renamed_order.get(field, field)
        if field not in dropped and name not in out:
            out[name] = F.col(f"{order}.{field}")
    return [value.alias(name) for name, value in out.items()]


def first_non_null(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` with gaps filled from the row of ``right`` with the same keys."""
    renamed = right.select(*keys, *[F.col(c).alias(f"_other_{c}") for c in right.columns if c not in keys])
    joined = left.join(renamed, keys, "left")
    return joined.select(*keys, *[
        F.coalesce(F.col(c), F.col(f"_other_{c}")).alias(c) if c in right.columns else F.col(c)
        for c in left.columns if c not in keys
    ])
