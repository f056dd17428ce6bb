"""Cleaned forms of the raw tables: chosen columns, short names, real times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.functions.timestamps import safe_timestamp
from tradeloom.operators.lookup import lookup_join


def pick(df: DataFrame, columns: Sequence[str | tuple[str, str]], times=()) -> DataFrame:
    """Keep ``columns`` and parse ``times``; a pair renames from old to new."""

    def named(column: str | tuple[str, str], form=lambda c: c) -> Column:
        old, new = (column, column) if isinstance(column, str) else column
        return form(F.col(old)).alias(new)

    return df.select(
        *[named(column) for column in columns],
        *[named(column, safe_timestamp) for column in times],
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    return pick(
        orders,
        ["order_id", "customer_id", "order_status"],
        times=[
            ("order_purchase_timestamp", "purchased_at"),
            ("order_approved_at", "approved_at"),
            ("order_delivered_carrier_date", "shipped_at"),
            ("order_delivered_customer_date", "delivered_at"),
            ("order_estimated_delivery_date", "estimated_delivery_at"),
        ],
    )


def stg_customers(customers: DataFrame) -> DataFrame:
    return pick(
        customers,
        [
            "customer_id",
            "customer_unique_id",
            ("customer_zip_code_prefix", "zip_code"),
            ("customer_city", "city"),
            ("customer_state", "state"),
        ],
    )


def stg_order_items(order_items: DataFrame) -> DataFrame:
    cleaned = pick(
        order_items,
        ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
        times=[("shipping_limit_date", "shipping_limit_at")],
    )
    return cleaned.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_at",
        "price",
        "freight_value",
    )


def stg_order_payments(order_payments: DataFrame) -> DataFrame:
    return pick(
        order_payments,
        [
            "order_id",
            "payment_sequential",
            "payment_type",
            "payment_installments",
            "payment_value",
        ],
    )


def stg_order_reviews(order_reviews: DataFrame) -> DataFrame:
    return pick(
        order_reviews,
        [
            "review_id",
            "order_id",
            "review_score",
            ("review_comment_title", "comment_title"),
            ("review_comment_message", "comment_message"),
        ],
        times=[
            ("review_creation_date", "review_created_at"),
            ("review_answer_timestamp", "review_answered_at"),
        ],
    )


def stg_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Categories in English where a translation exists."""
    english = translation.select("product_category_name", "product_category_name_english")
    named = lookup_join(products, english, "product_category_name")
    category = F.coalesce("product_category_name_english", "product_category_name")
    return pick(
        named.withColumn("category", category),
        [
            "product_id",
            "category",
            ("product_photos_qty", "photos_count"),
            ("product_weight_g", "weight_g"),
            ("product_length_cm", "length_cm"),
            ("product_height_cm", "height_cm"),
            ("product_width_cm", "width_cm"),
        ],
    )


def stg_sellers(sellers: DataFrame) -> DataFrame:
    return pick(
        sellers,
        [
            "seller_id",
            ("seller_zip_code_prefix", "zip_code"),
            ("seller_city", "city"),
            ("seller_state", "state"),
        ],
    )
