"""Orders with everything known about them, and history per person."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeloom.functions.measures import LATE, delivery_status, distinct_list, is_true, ratio
from tradeloom.functions.timestamps import day_diff
from tradeloom.operators.latest import latest_by, newest
from tradeloom.operators.lookup import HotKeys, left_join_per_key, lookup_join


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("total_revenue"),
        F.max("payment_installments").alias("max_installments"),
        distinct_list(F.col("payment_type")).alias("payment_types"),
    )


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """Newest review per order; of equally new ones the larger id."""
    return latest_by(
        reviews,
        ["order_id"],
        order=["review_created_at", "review_id"],
        kept=["review_score", "comment_message"],
    )


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count("*").alias("item_count"),
        F.sum("price").alias("items_subtotal"),
        F.sum("freight_value").alias("total_freight"),
    )


def int_orders_enriched(
    orders: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    items: DataFrame,
    hot_order_ids: HotKeys | None = None,
    repeats: bool = False,
) -> DataFrame:
    """One row per order. Payments, reviews and items shrink to one row per
    order before they meet, all on the same key, so nothing multiplies and each
    table shuffles once. With ``repeats`` a column ``order_repeats`` says whether
    other rows may have the order's id."""
    joined = left_join_per_key(
        orders,
        [payments_per_order(payments), latest_reviews(reviews), items_per_order(items)],
        "order_id",
        hot_order_ids,
        "order_repeats" if repeats else None,
    )

    def or_zero(name: str):
        return F.coalesce(name, F.lit(0)).alias(name)

    return joined.select(
        "order_id",
        "customer_id",
        "order_status",
        "purchased_at",
        "approved_at",
        "shipped_at",
        "delivered_at",
        "estimated_delivery_at",
        day_diff(F.col("purchased_at"), F.col("delivered_at")).alias("actual_delivery_days"),
        day_diff(F.col("delivered_at"), F.col("estimated_delivery_at")).alias("days_vs_estimate"),
        delivery_status(F.col("delivered_at"), F.col("estimated_delivery_at")).alias(
            "delivery_status"
        ),
        or_zero("total_revenue"),
        "payment_types",
        or_zero("max_installments"),
        or_zero("item_count"),
        or_zero("items_subtotal"),
        or_zero("total_freight"),
        "review_score",
        F.col("comment_message").alias("review_comment"),
        *(["order_repeats"] if repeats else []),
    )


def orders_with_customer(
    enriched: DataFrame, customers: DataFrame, broadcast_bytes: int = 0
) -> DataFrame:
    """Enriched orders with person and address of their customer record.

    Feeds both the order fact and the person history, so that the one large
    join on ``customer_id`` is written, and runs, once. The orders shuffle for it
    unless the customers are a lookup within ``broadcast_bytes``.
    """
    known = customers.select(
        "customer_id",
        "customer_unique_id",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        F.lit(True).alias("has_customer"),
    )
    joined = lookup_join(enriched, known, "customer_id", broadcast_bytes)
    return joined.withColumn("has_customer", is_true(F.col("has_customer")))


def int_customer_summary(customers: DataFrame, located: DataFrame) -> DataFrame:
    """History per person, with the address of the newest order.

    Two kinds of rows meet: the orders, and every customer record, so that
    persons without orders appear. Rows of an order id of their own (see
    ``order_repeats``; without that column, none) count as an order each and
    go into the person's sums at once. The others, few if the order ids are
    what they should be, are summed by person and order first. Every sum
    combines before the shuffle, so a person with a third of all orders is no
    bigger than any other.
    """
    person = ["customer_unique_id"]
    address, order = ["city", "state"], ["purchased_at", "order_id", "customer_id"]
    repeats = F.col("order_repeats") if "order_repeats" in located.columns else F.lit(True)
    orders = located.filter("has_customer").select(
        *person,
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
        *order,
        "total_revenue",
        "review_score",
        "delivery_status",
        repeats.alias("repeats"),
    )
    records = customers.select(*person, *address, "customer_id")
    is_late = F.col("delivery_status") == LATE
    alone = orders.filter("NOT repeats").unionByName(records, allowMissingColumns=True).select(
        *person,
        F.when(F.col("order_id").isNotNull(), 1).otherwise(0).cast("bigint").alias("orders"),
        F.col("total_revenue").alias("revenue"),
        F.col("total_revenue").isNotNull().cast("bigint").alias("revenues"),
        F.col("purchased_at").alias("first_at"),
        F.col("purchased_at").alias("last_at"),
        F.col("review_score").cast("bigint").alias("score"),
        F.col("review_score").isNotNull().cast("bigint").alias("scores"),
        F.coalesce(is_late, F.lit(False)).cast("bigint").alias("late"),
        F.struct(*address, *order).alias("newest"),
    )
    repeated = (
        orders.filter("repeats")
        .groupBy(*person, "order_id")
        .agg(
            F.sum("total_revenue").alias("revenue"),
            F.count("total_revenue").alias("revenues"),
            F.min("purchased_at").alias("first_at"),
            F.max("purchased_at").alias("last_at"),
            F.sum("review_score").alias("score"),
            F.count("review_score").alias("scores"),
            F.count_if(is_late).alias("late"),
            newest([*address, *order], order).alias("newest"),
        )
        .withColumn("orders", F.col("order_id").isNotNull().cast("bigint"))
        .drop("order_id")
    )
    summed = alone.unionByName(repeated).groupBy(*person).agg(
        F.sum("orders").alias("total_orders"),
        F.sum("revenue").alias("lifetime_value"),
        ratio(F.sum("revenue"), F.sum("revenues")).alias("avg_order_value"),
        F.min("first_at").alias("first_order_at"),
        F.max("last_at").alias("last_order_at"),
        ratio(F.sum("score"), F.sum("scores")).alias("avg_review_score"),
        F.sum("late").alias("late_delivery_count"),
        newest([f"newest.{name}" for name in address], [f"newest.{name}" for name in order]).alias("_address"),
    )
    return summed.select(
        *person,
        "total_orders",
        "lifetime_value",
        "avg_order_value",
        "first_order_at",
        "last_order_at",
        "avg_review_score",
        "late_delivery_count",
        *[F.col("_address")[name].alias(name) for name in address],
    )
