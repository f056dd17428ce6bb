"""The eight raw tables, derived from star-schema Parquet tables.

The star tables hold no payments, reviews or persons, so those come from line
items, events and customers. Everything is derived row by row from the given
tables and grows with them. Some rows are made irregular on purpose, chosen by
key: unreadable times, unknown customers and products, missing categories and
payment types, a foreign status, a score outside the scale, negative payments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradeloom.lazy import Frames

#: The star tables hold two places.
MONEY = "decimal(18,2)"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_star(spark: SparkSession, folder: str) -> Frames:
    def reader(name: str):
        return lambda: spark.read.parquet(f"{folder}/{name}.parquet")

    return Frames({name: reader(name) for name in TABLES})


def every(key: str, step: int, rest: int = 0) -> Column:
    return F.col(key) % step == rest


def _hours(key: str, factor: int = 1) -> Column:
    hours = (F.col(key) * factor % 24).cast("int")
    return F.make_interval(hours=hours)


def raw_tables(spark: SparkSession, folder: str) -> Frames:
    star = read_star(spark, folder)
    return Frames(
        {
            "orders": lambda: _orders(star["orders"], star["lineitem"]),
            "customers": lambda: _customers(star["customer"], star["nation"], star["region"]),
            "order_items": lambda: _order_items(star["lineitem"]),
            "order_payments": lambda: _order_payments(star["lineitem"]),
            "order_reviews": lambda: _order_reviews(star["events"]),
            "products": lambda: _products(star["part"]),
            "sellers": lambda: _sellers(star["supplier"], star["nation"], star["region"]),
            "product_category_translation": lambda: _translation(star["part"]),
        }
    )


def _orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Status from the order, delivery dates from its line items."""
    shipping = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )
    bought = F.col("bought")
    delivered = F.when(
        F.col("o_orderstatus") == "F", F.col("last_ship") + _hours("o_orderkey", 5)
    )
    status = (
        F.when(every("o_orderkey", 1009, 5), "lost")
        .when(every("o_orderkey", 211), "canceled")
        .when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("processing")
    )
    # The text of the time is made behind the join, so that no shuffle carries it.
    timed = orders.join(shipping, "o_orderkey", "left").withColumn(
        "bought", (F.col("o_orderdate") + _hours("o_orderkey", 7)).cast("string")
    )
    return timed.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(every("o_custkey", 50, 7), -F.col("o_custkey"))
        .otherwise(F.col("o_custkey"))
        .alias("customer_id"),
        status.alias("order_status"),
        F.when(every("o_orderkey", 499, 3), "unknown")
        .otherwise(bought)
        .alias("order_purchase_timestamp"),
        F.when(every("o_orderkey", 13), "").otherwise(bought).alias("order_approved_at"),
        F.col("first_ship").cast("string").alias("order_delivered_carrier_date"),
        delivered.cast("string").alias("order_delivered_customer_date"),
        F.when(every("o_orderkey", 101, 1), F.year("o_orderdate").cast("string"))
        .otherwise((F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).cast("string"))
        .alias("order_estimated_delivery_date"),
    )


def _places(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        "n_nationkey", "n_name", "r_name"
    )


def _customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Three customer records per person; some persons order nothing."""
    places = _places(nation, region)
    return customer.join(places, customer["c_nationkey"] == places["n_nationkey"], "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.when(every("c_custkey", 50, 7), -F.col("c_custkey"))
        .otherwise(F.expr("c_custkey div 3"))
        .alias("customer_unique_id"),
        F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
        F.col("r_name").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def _order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.when(every("l_partkey", 301, 11), -F.col("l_partkey"))
        .otherwise(F.col("l_partkey"))
        .alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").cast("string").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.round(F.col("l_quantity") * F.col("l_tax"), 2).cast(MONEY).alias("freight_value"),
    )


def _order_payments(lineitem: DataFrame) -> DataFrame:
    kind = (
        F.when(every("l_orderkey", 53), F.lit(None))
        .when(F.col("l_returnflag") == "A", "credit_card")
        .when(F.col("l_returnflag") == "N", "boleto")
        .otherwise("voucher")
    )
    value = F.col("l_extendedprice").cast(MONEY)
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        kind.alias("payment_type"),
        F.col("l_quantity").cast("int").alias("payment_installments"),
        F.when(every("l_orderkey", 997, 11), -value).otherwise(value).alias("payment_value"),
    )


def _order_reviews(events: DataFrame) -> DataFrame:
    """Three reviews per order; some share their date, some quote and break lines."""
    ts = F.col("ts")
    comment = F.when(
        every("event_id", 6, 1), F.concat(F.lit('said "'), "event_type", F.lit('",\nthen more'))
    ).otherwise(F.nullif(F.col("event_type"), F.lit("error")))
    written = F.when(every("event_id", 4), F.to_date(ts).cast("string")).otherwise(
        ts.cast("string")
    )
    return events.select(
        F.col("event_id").alias("review_id"),
        F.expr("event_id div 3").alias("order_id"),
        F.when(every("event_id", 1013), 7)
        .otherwise((F.col("event_id") % 5 + 1).cast("int"))
        .alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        comment.alias("review_comment_message"),
        F.when(every("event_id", 307), "n/a").otherwise(written).alias("review_creation_date"),
        (ts + F.expr("INTERVAL 1 DAY")).cast("string").alias("review_answer_timestamp"),
    )


def _products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.when(every("p_partkey", 17), F.lit(None))
        .otherwise(F.col("p_brand"))
        .alias("product_category_name"),
        (F.col("p_size") % 6).alias("product_photos_qty"),
        F.col("p_size").cast("double").alias("product_weight_g"),
        (F.col("p_size") * 2).cast("double").alias("product_length_cm"),
        (F.col("p_size") + 1).cast("double").alias("product_height_cm"),
        F.col("p_retailprice").alias("product_width_cm"),
    )


def _sellers(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    places = _places(nation, region)
    return supplier.join(places, supplier["s_nationkey"] == places["n_nationkey"], "left").select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
        F.col("r_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def _translation(part: DataFrame) -> DataFrame:
    """English names for the brands with an even number; the others have none."""
    number = F.substring_index("p_brand", "#", -1)
    return (
        part.select("p_brand")
        .distinct()
        .filter(number.try_cast("int") % 2 == 0)
        .select(
            F.col("p_brand").alias("product_category_name"),
            F.concat(F.lit("line_"), number).alias("product_category_name_english"),
        )
    )
