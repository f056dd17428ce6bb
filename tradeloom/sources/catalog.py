"""The eight raw tables: files, columns and types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

RAW, ANALYTICS = "raw", "analytics"
#: Keeps the places a file holds; sums stay exact whatever their order.
MONEY = "decimal(28,6)"


@dataclass(frozen=True)
class SourceSpec:
    """One raw table. ``columns`` types what the models read; a file may hold
    more columns, in any order, and those load as text."""

    table: str
    file: str
    columns: dict[str, str]
    comment: str

    @property
    def pattern(self) -> str:
        """File name with any data-set prefix: ``orders_dataset.csv`` also
        finds ``shop_orders_dataset.csv``, as a file or a folder of parts."""
        return f"{{,*_}}{self.file}.csv"

    def schema(self, header: list[str], money: str = MONEY) -> T.StructType:
        types = {name: money if kind == MONEY else kind for name, kind in self.columns.items()}
        ddl = ", ".join(f"`{name}` {types.get(name, 'string')}" for name in header)
        return T.StructType.fromDDL(ddl)


# File stems (without data-set prefix), table and column names.
SOURCES: dict[str, SourceSpec] = {
    spec.table: spec
    for spec in (
        SourceSpec(
            "orders",
            "orders_dataset",
            {
                "order_id": "string",
                "customer_id": "string",
                "order_status": "string",
                "order_purchase_timestamp": "string",
                "order_approved_at": "string",
                "order_delivered_carrier_date": "string",
                "order_delivered_customer_date": "string",
                "order_estimated_delivery_date": "string",
            },
            "Orders, one row each",
        ),
        SourceSpec(
            "customers",
            "customers_dataset",
            {
                "customer_id": "string",
                "customer_unique_id": "string",
                "customer_zip_code_prefix": "string",
                "customer_city": "string",
                "customer_state": "string",
            },
            "Customer records; several may belong to one person",
        ),
        SourceSpec(
            "order_items",
            "order_items_dataset",
            {
                "order_id": "string",
                "order_item_id": "int",
                "product_id": "string",
                "seller_id": "string",
                "shipping_limit_date": "string",
                "price": MONEY,
                "freight_value": MONEY,
            },
            "Products within orders",
        ),
        SourceSpec(
            "order_payments",
            "order_payments_dataset",
            {
                "order_id": "string",
                "payment_sequential": "int",
                "payment_type": "string",
                "payment_installments": "int",
                "payment_value": MONEY,
            },
            "Payments; an order may have several",
        ),
        SourceSpec(
            "order_reviews",
            "order_reviews_dataset",
            {
                "review_id": "string",
                "order_id": "string",
                "review_score": "int",
                "review_comment_title": "string",
                "review_comment_message": "string",
                "review_creation_date": "string",
                "review_answer_timestamp": "string",
            },
            "Reviews; an order may have several",
        ),
        SourceSpec(
            "products",
            "products_dataset",
            {
                "product_id": "string",
                "product_category_name": "string",
                "product_photos_qty": "int",
                "product_weight_g": "double",
                "product_length_cm": "double",
                "product_height_cm": "double",
                "product_width_cm": "double",
            },
            "Product list",
        ),
        SourceSpec(
            "sellers",
            "sellers_dataset",
            {
                "seller_id": "string",
                "seller_zip_code_prefix": "string",
                "seller_city": "string",
                "seller_state": "string",
            },
            "Seller list",
        ),
        SourceSpec(
            "product_category_translation",
            "product_category_name_translation",
            {
                "product_category_name": "string",
                "product_category_name_english": "string",
            },
            "Category names in two languages",
        ),
    )
}
