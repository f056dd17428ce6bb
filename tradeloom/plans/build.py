"""From raw tables to checked marts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tradeloom.lazy import Frames
from tradeloom.operators.lookup import HotKeys, hot_keys_of_large, lookup_bytes, source_bytes
from tradeloom.operators.stage import CLEANUP, setting
from tradeloom.plans import intermediate, marts, quality, staging
from tradeloom.session import SHUFFLE_BYTES
from tradeloom.sources.catalog import ANALYTICS, RAW, SOURCES
from tradeloom.sources.tables import (
    LoadResult,
    ensure_database,
    load_all,
    read_tables,
    replace_table,
    side_by_side,
    version_frame,
)

VIEWS = (
    "stg_orders",
    "stg_customers",
    "stg_order_items",
    "stg_order_payments",
    "stg_order_reviews",
    "stg_products",
    "stg_sellers",
    "int_orders_enriched",
    "int_customer_summary",
)
MARTS = ("fct_orders", "fct_order_items", "dim_customers")

#: Bytes of item files from which one side of a build fills the cluster.
LARGE_BYTES = 4 * SHUFFLE_BYTES


@dataclass
class Warehouse:
    models: dict[str, DataFrame]
    checks: DataFrame


def staging_models(raw: Mapping[str, DataFrame]) -> Frames:
    return Frames(
        {
            "stg_orders": lambda: staging.stg_orders(raw["orders"]),
            "stg_customers": lambda: staging.stg_customers(raw["customers"]),
            "stg_order_items": lambda: staging.stg_order_items(raw["order_items"]),
            "stg_order_payments": lambda: staging.stg_order_payments(raw["order_payments"]),
            "stg_order_reviews": lambda: staging.stg_order_reviews(raw["order_reviews"]),
            "stg_products": lambda: staging.stg_products(
                raw["products"], raw["product_category_translation"]
            ),
            "stg_sellers": lambda: staging.stg_sellers(raw["sellers"]),
        }
    )


def enriched_orders(
    models: Mapping[str, DataFrame], hot_order_ids: HotKeys | None = None, repeats: bool = False
) -> DataFrame:
    return intermediate.int_orders_enriched(
        models["stg_orders"],
        models["stg_order_payments"],
        models["stg_order_reviews"],
        models["stg_order_items"],
        hot_order_ids,
        repeats,
    )


def located_orders(models: Mapping[str, DataFrame], enriched: DataFrame) -> DataFrame:
    most = lookup_bytes(enriched.sparkSession)
    return intermediate.orders_with_customer(enriched, models["stg_customers"], most)


def order_items(models: Mapping[str, DataFrame]) -> DataFrame:
    return marts.fct_order_items(
        models["stg_order_items"],
        models["stg_orders"],
        models["stg_products"],
        models["stg_sellers"],
    )


def customers(models: Mapping[str, DataFrame], located: DataFrame) -> DataFrame:
    return intermediate.int_customer_summary(models["stg_customers"], located)


def build_warehouse(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str | None = None,
    parallel: int = 2,
) -> Warehouse:
    """Write the three marts and check all models.

    The orders with their customers are written once, as the order fact, and
    feed the person dimension from there. Marts are laid out for their reports
    without another shuffle: the order fact in year folders, each file of the
    item fact in order of months, so that year filters skip files and pages.

    The shuffle files of a write go when it ends, and large sides (orders, items)
    run one after the other, so the disks hold the shuffles of one write at a
    time. While it runs, that also holds for other jobs of the session: a frame
    of theirs that is run twice shuffles again.
    """
    models = dict(staging_models(raw))
    hot = hot_keys_of_large(models["stg_orders"], "order_id")
    models["int_orders_enriched"] = enriched_orders(models, hot)
    enriched = enriched_orders(models, hot, repeats=True)

    def order_side() -> None:
        orders = marts.fct_orders(located_orders(models, enriched), marks=True)
        shown = [name for name in orders.columns if name not in marts.MARKS]
        table = replace_table(
            orders,
            ANALYTICS,
            "fct_orders",
            root,
            partition_by="purchase_year",
            hidden=marts.MARKS,
        )
        models["fct_orders"] = table.select(*shown)
        written = version_frame(spark, ANALYTICS, "fct_orders")
        models["int_customer_summary"] = customers(models, written)
        models["dim_customers"] = replace_table(
            marts.dim_customers(models["int_customer_summary"]), ANALYTICS, "dim_customers", root
        )

    def item_side() -> None:
        models["fct_order_items"] = replace_table(
            order_items(models).sortWithinPartitions("year_month"), ANALYTICS, "fct_order_items", root
        )

    ensure_database(spark, ANALYTICS)
    if source_bytes(models["stg_order_items"]) >= LARGE_BYTES:
        parallel = 1
    with setting(spark, CLEANUP, "true"):
        side_by_side(lambda job: job(), [order_side, item_side], parallel)
    for name in VIEWS:
        models[name].createOrReplaceTempView(name)
    return Warehouse(models, quality.check_report(models))


def run(
    spark: SparkSession,
    folder: str,
    root: str | None = None,
    on_missing: str = "skip",
) -> tuple[LoadResult, Warehouse]:
    """CSV folder to checked marts."""
    loaded = load_all(spark, folder, root=root, on_missing=on_missing)
    warehouse = build_warehouse(spark, read_tables(spark, SOURCES, RAW), root)
    return loaded, warehouse
