"""Models on the small shop."""

import datetime as dt
from decimal import Decimal

import pytest

import shop
from tradeloom.operators.lookup import HotKeys
from tradeloom.plans import build, intermediate, marts


@pytest.fixture(scope="module")
def models(spark):
    return build.staging_models(shop.raw_frames(spark))


@pytest.fixture(scope="module")
def enriched(models):
    return {row.order_id: row for row in build.enriched_orders(models).collect()}


@pytest.fixture(scope="module")
def located(models):
    return build.located_orders(models, build.enriched_orders(models))


@pytest.fixture(scope="module")
def persons(models, located):
    dims = marts.dim_customers(build.customers(models, located))
    return {row.customer_unique_id: row for row in dims.collect()}


def test_unreadable_times_are_null(models):
    orders = {row.order_id: row for row in models["stg_orders"].collect()}
    assert orders["o1"].approved_at is None
    assert orders["o2"].approved_at is None and orders["o2"].shipped_at is None
    assert orders["o7"].purchased_at is None
    assert orders["o9"].purchased_at == dt.datetime(2018, 2, 1)


def test_category_translation(models):
    categories = {row.product_id: row.category for row in models["stg_products"].collect()}
    assert categories == {"x1": "beauty", "x2": "sem_traducao", "x3": None}


def test_payments_sum_once_per_order(enriched):
    first = enriched["o1"]
    assert first.total_revenue == Decimal("34.00")
    assert first.payment_types == "credit_card, voucher"
    assert first.max_installments == 3
    assert (first.item_count, first.items_subtotal) == (2, Decimal("30.00"))
    assert first.total_freight == Decimal("4.00")


def test_missing_parts(enriched):
    bare = enriched["o5"]
    assert (bare.total_revenue, bare.item_count, bare.max_installments) == (0, 0, 0)
    assert bare.payment_types is None and bare.review_score is None
    assert enriched["o3"].payment_types is None
    assert enriched["o2"].total_freight == 0


def test_latest_review(enriched):
    assert enriched["o1"].review_comment == 'second, "late"\nand more'
    assert enriched["o2"].review_score == 4
    assert enriched["o3"].review_score == 3


def test_delivery(enriched):
    assert enriched["o1"].actual_delivery_days == 1
    statuses = {key: row.delivery_status for key, row in enriched.items()}
    assert statuses["o2"] == "On Time"
    assert statuses["o3"] == "Late"
    assert statuses["o4"] == "Not Delivered"
    assert statuses["o5"] == "Late"
    assert statuses["o7"] == "Late"
    assert enriched["o3"].days_vs_estimate == -11
    assert enriched["o8"].days_vs_estimate == 2


def hot(spark, ids) -> HotKeys:
    frame = spark.createDataFrame([(i, n + 1) for n, i in enumerate(ids)], "order_id string, salts bigint")
    return HotKeys(frame, 100 * len(ids))


def test_hot_keys_do_not_change_rows(spark, models, enriched):
    for ids in (["o1", "o3"], [], ["o2"]):
        rows = build.enriched_orders(models, hot(spark, ids)).collect()
        assert {row.order_id: row for row in rows} == enriched


def test_rows_without_a_key_survive_the_hot_path(spark, models):
    orders = models["stg_orders"].limit(0).unionByName(
        models["stg_orders"].selectExpr("nullif(order_id, 'o2') AS order_id", "* EXCEPT (order_id)")
    )
    parts = [models[name] for name in ("stg_order_payments", "stg_order_reviews", "stg_order_items")]
    plain = intermediate.int_orders_enriched(orders, *parts).collect()
    split = intermediate.int_orders_enriched(orders, *parts, hot_order_ids=hot(spark, ["o1"])).collect()
    assert sorted(map(str, plain)) == sorted(map(str, split))
    assert len(split) == 9


def test_order_fact(located):
    rows = {row.order_id: row for row in marts.fct_orders(located).collect()}
    assert len(rows) == len(shop.ROWS["orders"])
    assert (rows["o1"].purchase_year, rows["o1"].year_month) == (2017, "2017-05")
    assert rows["o1"].customer_state == "SP" and rows["o8"].customer_state == "RJ"
    assert rows["o7"].customer_unique_id is None and rows["o7"].year_month is None


def test_item_fact(models):
    rows = build.order_items(models).collect()
    assert len(rows) == len(shop.ROWS["order_items"])
    by_order = {(row.order_id, row.order_item_id): row for row in rows}
    unknown = by_order["o4", 1]
    assert unknown.product_category is None and unknown.seller_city is None
    assert by_order["lost", 1].order_status is None
    assert by_order["o2", 1].total_item_value is None
    assert by_order["o1", 2].total_item_value == Decimal("22.50")


def test_persons(persons):
    assert len(persons) == 8
    moved = persons["p1"]
    assert (moved.city, moved.state, moved.total_orders) == ("Rio", "RJ", 2)
    assert moved.is_repeat_customer and moved.lifetime_value == Decimal("134.00")
    assert moved.avg_order_value == 67.0 and moved.avg_review_score == 5.0
    idle = persons["p8"]
    assert (idle.total_orders, idle.lifetime_value, idle.city) == (0, None, "Nowhere")
    assert not idle.is_repeat_customer and idle.customer_segment == "Low Value"
    assert persons["p5"].late_delivery_count == 1
    assert persons["p5"].avg_order_value == 0


def test_segments_go_by_unrounded_value(spark, persons):
    segments = {key: row.customer_segment for key, row in persons.items()}
    assert segments["p2"] == "Mid Value"
    assert segments["p3"] == "Mid Value"
    assert segments["p4"] == "High Value"
    assert segments["p7"] == "Low Value"
    summary = spark.sql(
        "SELECT id AS customer_unique_id, '' AS city, '' AS state, 2L AS total_orders, "
        "value AS lifetime_value, 1.005D AS avg_order_value, current_date() AS first_order_at, "
        "current_date() AS last_order_at, 1D AS avg_review_score, 0L AS late_delivery_count "
        "FROM VALUES (1, 499.996D), (2, 149.999D), (3, 150D) AS v(id, value)"
    )
    rows = {row.customer_unique_id: row for row in marts.dim_customers(summary).collect()}
    assert [rows[i].customer_segment for i in (1, 2, 3)] == ["Mid Value", "Low Value", "Mid Value"]
    assert rows[1].lifetime_value == 500.0 and rows[1].avg_order_value == 1.0


def test_repeated_orders_count_once_per_person(spark, models):
    """The same order twice, under two records of one person."""
    orders = shop.ROWS["orders"] + [("o1", "c1b", *shop.ROWS["orders"][0][2:])]
    frames = build.staging_models(shop.raw_frames(spark, {"orders": orders}))
    located = build.located_orders(frames, build.enriched_orders(frames))
    rows = build.customers(frames, located).collect()
    person = next(row for row in rows if row.customer_unique_id == "p1")
    assert person.total_orders == 2
    assert person.lifetime_value == Decimal("168.00")


def test_orders_of_unknown_persons_form_one_group(spark):
    customers = [*shop.ROWS["customers"][:-1], ("c9", None, "1", "Here", "SP")]
    orders = [*shop.ROWS["orders"], ("o10", "c9", *shop.ROWS["orders"][0][2:])]
    frames = build.staging_models(
        shop.raw_frames(spark, {"customers": customers, "orders": orders})
    )
    located = build.located_orders(frames, build.enriched_orders(frames))
    rows = {row.customer_unique_id: row for row in build.customers(frames, located).collect()}
    assert rows[None].total_orders == 1 and rows[None].city == "Here"


def test_invariants_at_scale(spark):
    from tradeloom.verification.queries import Models

    m = Models(spark, "/root/testdata/sf0.001")
    orders = m.staging["stg_orders"].count()
    assert m.enriched.count() == orders == m.fct_orders.count()
    assert m.fct_order_items.count() == m.staging["stg_order_items"].count()
    persons = m.staging["stg_customers"].select("customer_unique_id").distinct().count()
    assert m.dim_customers.count() == persons
    paid = m.staging["stg_order_payments"].join(
        m.staging["stg_orders"].select("order_id").distinct(), "order_id", "left_semi"
    )
    total = m.enriched.agg({"total_revenue": "sum"}).first()[0]
    assert total == paid.agg({"payment_value": "sum"}).first()[0]
