"""The tables reports read: order fact, order-item fact, person dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeloom.functions.measures import (
    HIGH_LIMIT,
    MID_LIMIT,
    is_true,
    round_column,
    value_segment,
)
from tradeloom.functions.timestamps import year_month
from tradeloom.operators.lookup import lookup_join


#: Columns the person history needs besides those of the order fact.
MARKS = ("has_customer", "order_repeats")


def fct_orders(located: DataFrame, marks: bool = False) -> DataFrame:
    """One row per order; with ``marks`` also the ``MARKS`` that ``located`` has."""
    bought = F.col("purchased_at")
    return located.select(
        "order_id",
        "customer_id",
        "customer_unique_id",
        "purchased_at",
        F.to_date(bought).alias("purchase_date"),
        F.year(bought).alias("purchase_year"),
        F.month(bought).alias("purchase_month"),
        year_month(bought).alias("year_month"),
        "order_status",
        "delivery_status",
        "customer_city",
        "customer_state",
        "total_revenue",
        "items_subtotal",
        "total_freight",
        "item_count",
        "payment_types",
        "max_installments",
        "actual_delivery_days",
        "days_vs_estimate",
        "review_score",
        "review_comment",
        *([name for name in MARKS if name in located.columns] if marks else []),
    )


def fct_order_items(
    items: DataFrame, orders: DataFrame, products: DataFrame, sellers: DataFrame
) -> DataFrame:
    """One row per item. The join with orders shuffles; products and sellers
    follow as lookups, on the executors' own copies while those are small."""
    bought = F.col("purchased_at")
    joined = items.join(orders.select("order_id", "purchased_at", "order_status"), "order_id", "left")
    joined = lookup_join(
        joined,
        products.select("product_id", F.col("category").alias("product_category"), "weight_g"),
        "product_id",
    )
    joined = lookup_join(
        joined,
        sellers.select(
            "seller_id", F.col("city").alias("seller_city"), F.col("state").alias("seller_state")
        ),
        "seller_id",
    )
    return joined.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "purchased_at",
        F.to_date(bought).alias("purchase_date"),
        year_month(bought).alias("year_month"),
        "order_status",
        "product_category",
        "weight_g",
        "seller_city",
        "seller_state",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_item_value"),
    )


def dim_customers(
    summary: DataFrame, high: float = HIGH_LIMIT, mid: float = MID_LIMIT
) -> DataFrame:
    """Segments go by the value before rounding."""
    return summary.select(
        "customer_unique_id",
        "city",
        "state",
        "total_orders",
        round_column(summary, "lifetime_value", 2).alias("lifetime_value"),
        round_column(summary, "avg_order_value", 2).alias("avg_order_value"),
        "first_order_at",
        "last_order_at",
        round_column(summary, "avg_review_score", 2).alias("avg_review_score"),
        "late_delivery_count",
        value_segment(F.col("lifetime_value"), high, mid).alias("customer_segment"),
        is_true(F.col("total_orders") > 1).alias("is_repeat_customer"),
    )
