"""One key with a third of all rows: results stay right, work stays spread."""

import re

import pytest
from pyspark.sql import functions as F

from tradeloom.operators.lookup import (
    BROADCAST_BYTES,
    HotKeys,
    hot_keys,
    hot_keys_of_large,
    left_join_per_key,
    lookup_join,
    planned_bytes,
)
from tradeloom.plans import intermediate, marts

ROWS = 120_000
TIMES = ("purchased_at", "approved_at", "shipped_at", "delivered_at", "estimated_delivery_at")


@pytest.fixture(scope="module")
def skewed(spark):
    """Session settings under which a small test counts as skewed."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def noise():
    """Text that does not compress: AQE judges partitions by their written size."""
    return F.sha1(F.col("id").cast("string"))


def hot(column: str, value):
    """A third of the rows get ``value``."""
    return F.when(F.col("id") % 3 == 0, F.lit(value)).otherwise(F.col(column))


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(skewed):
    day = F.timestamp_add("DAY", F.col("id") % 900, F.lit("2016-01-01").cast("timestamp_ntz"))
    return skewed.range(0, ROWS, 1, 4).select(
        F.col("id").alias("order_id"),
        hot("id", 7).alias("customer_id"),
        noise().alias("order_status"),
        day.alias("purchased_at"),
        day.alias("approved_at"),
        day.alias("shipped_at"),
        F.timestamp_add("DAY", F.lit(5), day).alias("delivered_at"),
        F.timestamp_add("DAY", F.lit(4), day).alias("estimated_delivery_at"),
    )


@pytest.fixture(scope="module")
def customers(skewed):
    return skewed.range(0, ROWS, 1, 4).select(
        F.col("id").alias("customer_id"),
        F.expr("id div 2").alias("customer_unique_id"),
        F.lit("1").alias("zip_code"),
        F.concat(F.lit("city"), F.col("id") % 9).alias("city"),
        F.concat(F.lit("state"), F.col("id") % 5).alias("state"),
    )


def amounts(skewed, value: int, **columns):
    """Payment or item rows, a third of them in order ``value``."""
    return skewed.range(0, ROWS, 1, 4).select(
        hot("id", value).alias("order_id"),
        *[column.alias(name) for name, column in columns.items()],
    )


@pytest.fixture(scope="module")
def enriched(skewed, orders):
    money = (F.col("id") % 2 + F.lit(0.75)).cast("decimal(18,2)")
    payments = amounts(
        skewed,
        5,
        payment_type=F.when(F.col("id") % 2 == 0, "a").otherwise("b"),
        payment_installments=(F.col("id") % 12).cast("int"),
        payment_value=money,
    )
    items = amounts(skewed, 5, price=money, freight_value=money)
    reviews = amounts(
        skewed,
        5,
        review_id=F.col("id"),
        review_score=(F.col("id") % 5 + 1).cast("int"),
        comment_message=F.col("id").cast("string"),
        review_created_at=F.lit("2018-01-01").cast("timestamp_ntz"),
    )
    return intermediate.int_orders_enriched(orders, payments, reviews, items)


def test_hot_order(enriched):
    row = enriched.filter("order_id = 5").first()
    share = ROWS // 3 + 1
    assert row.item_count == share and row.total_revenue == row.items_subtotal
    assert abs(float(row.total_revenue) - share * 1.25) < 1
    assert row.payment_types == "a, b" and row.max_installments == 9
    assert row.review_comment == str(ROWS - 3)


def test_hot_order_shrinks_before_the_shuffle(enriched):
    """Each shuffle below a per-order aggregate has a partial one under it."""
    text = enriched._jdf.queryExecution().executedPlan().toString()
    for partial in ("partial_sum(payment_value", "partial_max_by(", "partial_sum(price"):
        assert partial in text
    assert "collect_list" not in text and "Window" not in text


def test_hot_customer_is_split_in_the_join(enriched, customers):
    located = intermediate.orders_with_customer(enriched, customers)
    counts = located.groupBy("customer_state").agg(
        F.count("*").alias("n"), F.max("order_status").alias("last")
    )
    assert "skew=true" in final_plan(counts)
    assert sum(row.n for row in counts.collect()) == ROWS


def test_hot_person(enriched, customers):
    located = intermediate.orders_with_customer(enriched, customers)
    summary = intermediate.int_customer_summary(customers, located)
    text = summary._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(orders" in text and "Window" not in text
    assert text.count("Join [customer_id") == 1
    row = marts.dim_customers(summary).filter("customer_unique_id = 3").first()
    assert row.total_orders == ROWS // 3 + 1 and row.city == "city7"
    assert summary.count() == ROWS // 2


def test_hot_order_of_items_is_split_in_the_join(skewed, orders):
    money = F.lit("1.25").cast("decimal(18,2)")
    items = amounts(
        skewed,
        5,
        order_item_id=noise(),
        product_id=F.col("id") % 50,
        seller_id=F.col("id") % 20,
        price=money,
        freight_value=money,
    )
    products = skewed.range(50).selectExpr("id AS product_id", "'c' AS category", "1D AS weight_g")
    sellers = skewed.range(20).selectExpr("id AS seller_id", "'x' AS city", "'y' AS state")
    fact = marts.fct_order_items(items, orders, products, sellers)
    counts = fact.agg(F.count("order_status").alias("n"), F.max("order_item_id"))
    text = final_plan(counts)
    assert "skew=true" in text and "BroadcastHashJoin" in text
    assert counts.first().n == ROWS


def test_hot_product_is_split_where_the_lookup_is_large(skewed):
    items = skewed.range(0, ROWS, 1, 4).select(hot("id", 3).alias("product_id"), noise().alias("note"))
    products = skewed.range(0, ROWS, 1, 4).select(
        F.col("id").alias("product_id"), F.col("id").cast("string").alias("category")
    )
    joined = lookup_join(items, products, "product_id", broadcast_bytes=1000)
    counts = joined.agg(F.count("category").alias("n"), F.max("note"))
    assert "skew=true" in final_plan(counts)
    assert counts.first().n == ROWS


def test_hot_order_ids_leave_the_shuffle(skewed, orders, enriched):
    """Repeated order ids, a third of all, and another part without an id."""
    broken = orders.withColumn(
        "order_id",
        F.when(F.col("order_id") % 3 == 0, 5).when(F.col("order_id") % 10 > 1, F.col("order_id")),
    )
    found = hot_keys(broken, "order_id")
    assert [row.order_id for row in found.frame.collect()] == [5]
    paid = skewed.range(0, 1000).selectExpr(
        "id AS order_id",
        "'a' AS payment_type",
        "1 AS payment_installments",
        "CAST(2 AS DECIMAL(18,2)) AS payment_value",
    )
    reviews = skewed.sql(
        "SELECT 1L AS review_id, 5L AS order_id, 4 AS review_score, 'm' AS comment_message, "
        "TIMESTAMP_NTZ '2018-01-01' AS review_created_at"
    )
    items = paid.selectExpr("order_id", "payment_value AS price", "payment_value AS freight_value")
    sums = [
        F.count("*"),
        F.sum("total_revenue"),
        F.sum("review_score"),
        F.sum("item_count"),
        F.count("order_id"),
    ]
    plain = intermediate.int_orders_enriched(broken, paid, reviews, items).agg(*sums)
    split = intermediate.int_orders_enriched(broken, paid, reviews, items, found).agg(*sums)
    assert plain.first() == split.first()
    assert split.first()[0] == ROWS
    assert "_salt" in split._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_hot_key_are_dealt_out(skewed):
    """Each part of a hot key holds its share of the rows."""
    rows = skewed.range(0, ROWS, 1, 4).select(hot("id", 5).alias("k"), F.col("id").alias("n"))
    found = hot_keys(rows, "k", partitions=0.25)
    (row,) = found.frame.collect()
    assert row.k == 5 and row.salts >= 10
    right = skewed.range(0, 100).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    joined = left_join_per_key(rows, [right], "k", found)
    assert joined.count() == ROWS
    assert joined.filter("v = 'v'").count() == rows.filter("k < 100").count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" in plan and "_salt#" in plan


def test_plan_at_a_width_of_a_million(spark, orders):
    """The width of 100 TB: the sketch stays within its limit, the table of hot
    keys is no literal, and only a measured size is broadcast."""
    rows = orders.withColumn("order_id", F.when(F.col("order_id") % 3 == 0, 5).otherwise(F.col("order_id")))
    empty = spark.range(0)
    payments = empty.selectExpr("id AS order_id", "'a' AS payment_type", "1 AS payment_installments", "1.0BD AS payment_value")
    reviews = empty.selectExpr("id AS order_id", "id AS review_id", "1 AS review_score", "'' AS comment_message", "id AS review_created_at")
    items = empty.selectExpr("id AS order_id", "1.0BD AS price", "1.0BD AS freight_value")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1000000")
        found = hot_keys(rows, "order_id")
        plan = intermediate.int_orders_enriched(rows, payments, reviews, items, found)._jdf.queryExecution()
        text = plan.executedPlan().toString()
        unbounded = left_join_per_key(rows, [items.groupBy("order_id").count()], "order_id", HotKeys(found.frame, 2**40))
        assert "ResolvedHint (strategy=broadcast)" not in unbounded._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert 0 < found.bytes < BROADCAST_BYTES
    salts = {row.order_id: row.salts for row in found.frame.collect()}
    assert salts[5] > 50_000 and sum(salts.values()) < 1_000_000
    assert " IN (" not in text and "INSET" not in text and "_salt" in text


def test_small_frames_are_not_searched(spark):
    frame = spark.range(1000)
    assert hot_keys_of_large(frame, "id") is None
    assert planned_bytes(frame) == 8000
    assert hot_keys_of_large(frame, "id", least_bytes=8000).bytes == 0


def test_repeated_orders_count_once(spark):
    """Whatever says which orders repeat, and on every path of the join."""
    orders = spark.createDataFrame(
        [(1, 10), (1, 10), (1, 11), (2, 10), (3, 12), (None, 10), (None, 13), (4, 13), (4, 13)], "order_id bigint, customer_id bigint"
    ).selectExpr("*", "'x' AS order_status", *[f"TIMESTAMP_NTZ '2018-01-01' AS {t}" for t in TIMES])
    customers = spark.createDataFrame(
        [(10, 1), (11, 1), (12, 2), (13, 3), (14, 4)], "customer_id bigint, customer_unique_id bigint"
    ).selectExpr("*", "'c' AS city", "'s' AS state")
    payments = spark.sql("SELECT 1L AS order_id, 'a' AS payment_type, 1 AS payment_installments, 2.0BD AS payment_value")
    reviews = spark.sql("SELECT 1L AS order_id, 1 AS review_id, 4 AS review_score, '' AS comment_message, 1 AS review_created_at")
    items = spark.sql("SELECT 1L AS order_id, 1.0BD AS price, 1.0BD AS freight_value")
    hot_ids = HotKeys(spark.sql("SELECT 4L AS order_id, 2L AS salts"), 100)
    none = HotKeys(spark.sql("SELECT 4L AS order_id, 2L AS salts").limit(0), 0)
    found = []
    for options in ({}, {"repeats": True}, {"hot_order_ids": hot_ids, "repeats": True}, {"hot_order_ids": none, "repeats": True}):
        enriched = intermediate.int_orders_enriched(orders, payments, reviews, items, **options)
        located = intermediate.orders_with_customer(enriched, customers)
        found.append(sorted(map(tuple, intermediate.int_customer_summary(customers, located).collect())))
    assert found[0] == found[1] == found[2] == found[3]
    assert {row[0]: row[1] for row in found[0]} == {1: 2, 2: 1, 3: 1, 4: 0}
    assert {row[0]: row[6] for row in found[0]}[1] == 4.0


def test_orders_are_shuffled_once_above_the_join(skewed, orders, customers, enriched):
    amounts_of = skewed.range(0, 10).selectExpr("id AS order_id", "'a' AS payment_type", "1 AS payment_installments", "1.0BD AS payment_value")
    items = amounts_of.selectExpr("order_id", "payment_value AS price", "payment_value AS freight_value")
    reviews = amounts_of.selectExpr("order_id", "order_id AS review_id", "1 AS review_score", "'' AS comment_message", "1 AS review_created_at")
    marked = intermediate.int_orders_enriched(orders, amounts_of, reviews, items, repeats=True)
    summary = intermediate.int_customer_summary(customers, intermediate.orders_with_customer(marked, customers))
    plan = final_plan(summary).split("Initial Plan")[0]
    above = plan[: re.search(r"Join(\(skew=true\))? \[customer_id", plan).start()]
    assert above.count("Exchange hashpartitioning(customer_unique_id") == 1
    assert "order_id" not in "".join(line for line in above.splitlines() if "Exchange" in line)


def test_many_warm_keys_are_found_at_a_wide_shuffle(spark):
    keys = F.when(F.col("id") % 2 == 0, F.col("id") % 500).otherwise(F.col("id") + 1000)
    rows = spark.range(0, 400_000, 1, 4).select(keys.alias("k"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8000")
        found = hot_keys(rows, "k")
        assert {row.k for row in found.frame.collect()} == set(range(0, 500, 2))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
