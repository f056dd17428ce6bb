"""Registered queries: models, operators, checks and reports on the star tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tradeloom.functions import labels
from tradeloom.functions.measures import (
    HIGH_VALUE,
    LOW_VALUE,
    MID_VALUE,
    distinct_list,
    percent_of_rows,
    value_segment,
)
from tradeloom.functions.timestamps import day_diff, safe_timestamp
from tradeloom.lazy import Frames
from tradeloom.operators.lookup import HotKeys, frequent_keys, hot_keys_of_large, lookup_join, measured_bytes
from tradeloom.operators.ranking import top_k
from tradeloom.operators.stage import stage_folder, staged
from tradeloom.plans import build, intermediate, marts, quality, reports
from tradeloom.plans.reports import ReportFilter
from tradeloom.sources.catalog import SOURCES
from tradeloom.sources.csv_files import read_source
from tradeloom.sources.star_tables import raw_tables
from tradeloom.sources.tables import load_all, row_counts
from tradeloom.verification.oracle import sql

Query = Callable[[SparkSession, str], DataFrame]

HIGH_BAND, MID_BAND = 6_500_000, 4_000_000
SOME = ReportFilter(years=(1996, 1998, 1999), states=("NATION_1", "NATION_7", "NATION_12"))
ONE_YEAR = ReportFilter(years=(1997,))
TWO_STATES = ReportFilter(states=("NATION_3", "O'Brien"))
NO_MATCH = ReportFilter(years=(1900,))


class Models:
    """The models over one folder of star tables, built when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def raw(self) -> Frames:
        return raw_tables(self.spark, self.folder)

    @cached_property
    def staging(self) -> Frames:
        return build.staging_models(self.raw)

    @cached_property
    def hot_order_ids(self) -> HotKeys | None:
        return hot_keys_of_large(self.staging["stg_orders"], "order_id")

    @cached_property
    def enriched(self) -> DataFrame:
        return build.enriched_orders(self.staging, self.hot_order_ids)

    @cached_property
    def located(self) -> DataFrame:
        return build.located_orders(self.staging, build.enriched_orders(self.staging, self.hot_order_ids, repeats=True))

    @cached_property
    def summary(self) -> DataFrame:
        return build.customers(self.staging, self.located)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(self.located)

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return build.order_items(self.staging)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.summary)

    def mart(self, name: str) -> DataFrame:
        return getattr(self, name)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form the comparison reads."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, query: Callable[[Models], DataFrame], oracle: str | None) -> None:
    QUERIES[name] = lambda spark, folder: plain(query(Models(spark, folder)))
    if oracle is not None:
        ORACLE[name] = sql(oracle)


def doubles(view: str, *names: str) -> str:
    if not names:
        return f"SELECT * FROM {view}"
    casts = ", ".join(f"{name}::DOUBLE AS {name}" for name in names)
    return f"SELECT * REPLACE ({casts}) FROM {view}"


# Models ------------------------------------------------------------------------

for _name, _oracle in {
    "stg_orders": doubles("v_orders"),
    "stg_customers": doubles("v_customers"),
    "stg_order_items": doubles("v_items", "price", "freight_value"),
    "stg_order_payments": doubles("raw_payments", "payment_value"),
    "stg_order_reviews": doubles("v_reviews"),
    "stg_products": doubles("v_products"),
    "stg_sellers": doubles("v_sellers"),
}.items():
    register(_name, lambda m, name=_name: m.staging[name], _oracle)

ORDER_MONEY = ("total_revenue", "items_subtotal", "total_freight")
register("int_orders_enriched", lambda m: m.enriched, doubles("v_enriched", *ORDER_MONEY))
register("int_customer_summary", lambda m: m.summary, doubles("v_summary", "lifetime_value"))
register("fct_orders", lambda m: m.fct_orders, doubles("f_orders", *ORDER_MONEY))
register(
    "fct_order_items",
    lambda m: m.fct_order_items,
    doubles("f_items", "price", "freight_value", "total_item_value"),
)
register("dim_customers", lambda m: m.dim_customers, doubles("d_customers", "lifetime_value"))


def _written(m: Models, name: str) -> DataFrame:
    """A model as it is read after its tables were written twice."""
    root = f"{stage_folder(m.spark)}/lake-{uuid.uuid4().hex}"
    for _ in range(2):
        models = build.build_warehouse(m.spark, m.raw, root).models
    return models[name]


register("written_fct_orders", lambda m: _written(m, "fct_orders"), doubles("f_orders", *ORDER_MONEY))
register(
    "written_fct_orders_of_1997",
    lambda m: _written(m, "fct_orders").filter("purchase_year = 1997"),
    doubles("f_orders", *ORDER_MONEY) + " WHERE purchase_year = 1997",
)
register("written_dim_customers", lambda m: _written(m, "dim_customers"), doubles("d_customers", "lifetime_value"))
register(
    "written_int_orders_enriched_view",
    lambda m: (_written(m, "fct_orders"), m.spark.table("int_orders_enriched"))[1],
    doubles("v_enriched", *ORDER_MONEY),
)
register(
    "dim_customers_own_bands",
    lambda m: marts.dim_customers(m.summary, high=HIGH_BAND, mid=MID_BAND),
    f"""
    SELECT * REPLACE (lifetime_value::DOUBLE AS lifetime_value,
                      CASE WHEN lifetime_value >= {HIGH_BAND} THEN '{HIGH_VALUE}'
                           WHEN lifetime_value >= {MID_BAND} THEN '{MID_VALUE}'
                           ELSE '{LOW_VALUE}' END AS customer_segment)
    FROM d_customers
    """,
)


def _enriched_hot(m: Models) -> DataFrame:
    """Order keys that hold the most line items take the hot path."""
    found = frequent_keys(m.staging["stg_order_items"], "order_id", most=100)
    hot = found.select("order_id", F.lit(3).cast("bigint").alias("salts"))
    return build.enriched_orders(m.staging, HotKeys(hot, measured_bytes(hot)))


register("int_orders_enriched_hot_keys", _enriched_hot, doubles("v_enriched", *ORDER_MONEY))

# Sources -----------------------------------------------------------------------

register(
    "raw_row_counts",
    lambda m: row_counts(m.raw),
    """
    SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
    UNION ALL SELECT 'customers', count(*) FROM customer
    UNION ALL SELECT 'order_items', count(*) FROM lineitem
    UNION ALL SELECT 'order_payments', count(*) FROM lineitem
    UNION ALL SELECT 'order_reviews', count(*) FROM events
    UNION ALL SELECT 'products', count(*) FROM part
    UNION ALL SELECT 'sellers', count(*) FROM supplier
    UNION ALL SELECT 'product_category_translation', count(*) FROM translation
    """,
)


def _through_csv(m: Models, table: str, split_bytes: int, rows: DataFrame | None = None) -> DataFrame:
    """Write a raw table (or ``rows`` in its place) as CSV and read it back as a source."""
    folder = f"{stage_folder(m.spark)}/csv-{table}-{uuid.uuid4().hex}"
    rows = m.raw[table] if rows is None else rows
    rows.write.options(header=True, quote='"', escape='"', emptyValue="", quoteAll=table == "order_items").csv(folder)
    return read_source(m.spark, SOURCES[table], folder, split_bytes=split_bytes)


def _malformed_items(m: Models) -> DataFrame:
    """Items with line ends and quotes in an extra column; every seventh order
    has item numbers that are no numbers."""
    items = m.raw["order_items"]
    number = F.when(F.col("order_id") % 7 == 0, "six").otherwise(F.col("order_item_id").cast("string"))
    note = F.concat(F.lit('a "note",\r'), F.col("order_id"), F.lit("\nof two lines\r\n"))
    return items.withColumn("order_item_id", number).withColumn("note", note)


def _as_loaded(m: Models) -> DataFrame:
    """Prices of three places just under a whole number, and one at it."""
    quantity = F.col("l_quantity").cast("int") * 10
    text = F.when(F.col("l_linenumber") == 1, quantity.cast("string")).otherwise(F.concat((quantity - 1).cast("string"), F.lit(".996")))
    lines = table_of(m, "lineitem")
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.lit("p").alias("product_id"),
        F.lit("s").alias("seller_id"),
        F.lit("").alias("shipping_limit_date"),
        text.alias("price"),
        F.lit("0").alias("freight_value"),
    )


def table_of(m: Models, name: str) -> DataFrame:
    return m.spark.read.parquet(f"{m.folder}/{name}.parquet")


for _split in (1024, 2**30):
    register(
        f"csv_order_items_malformed_{'large' if _split == 1024 else 'small'}",
        lambda m, split=_split: _through_csv(m, "order_items", split, _malformed_items(m)).select(
            F.col("order_id").cast("bigint").alias("order_id"), "order_item_id"
        ),
        "SELECT order_id, order_item_id FROM v_items WHERE order_id % 7 <> 0",
    )
register(
    "csv_value_bands_as_loaded",
    lambda m: _through_csv(m, "order_items", 1024, _as_loaded(m))
    .groupBy(value_segment(F.col("price")).alias("segment"))
    .agg(F.count("*").alias("items")),
    f"""
    SELECT CASE WHEN value >= 500 THEN '{HIGH_VALUE}' WHEN value >= 150 THEN '{MID_VALUE}'
                ELSE '{LOW_VALUE}' END AS segment, count(*) AS items
    FROM (SELECT l_quantity * 10 - if(l_linenumber = 1, 0, 0.004) AS value FROM lineitem)
    GROUP BY ALL
    """,
)


register(
    "csv_order_reviews",
    lambda m: _through_csv(m, "order_reviews", split_bytes=1024).select(
        F.col("review_id").cast("bigint").alias("review_id"),
        F.col("order_id").cast("bigint").alias("order_id"),
        "review_score",
        F.col("review_comment_message").alias("comment_message"),
        safe_timestamp(F.col("review_creation_date")).alias("review_created_at"),
    ),
    """
    SELECT review_id, order_id, review_score, comment_message, review_created_at FROM v_reviews
    """,
)
register(
    "csv_order_items",
    lambda m: _through_csv(m, "order_items", split_bytes=1024).select(
        F.col("order_id").cast("bigint").alias("order_id"),
        "order_item_id",
        F.col("product_id").cast("bigint").alias("product_id"),
        "price",
        "freight_value",
    ),
    """
    SELECT order_id, order_item_id, product_id, price::DOUBLE AS price,
           freight_value::DOUBLE AS freight_value
    FROM v_items
    """,
)


def _loaded(m: Models) -> DataFrame:
    """What a load of a folder of source files reports; the file of one is away."""
    folder = f"{stage_folder(m.spark)}/incoming-{uuid.uuid4().hex}"
    for name, spec in SOURCES.items():
        if name != "sellers":
            rows = m.raw[name].write.options(header=True, quote='"', escape='"', emptyValue="")
            rows.csv(f"{folder}/shop_{spec.file}.csv")
    result = load_all(m.spark, folder, root=f"{folder}/lake")
    found = [(name, result.rows.get(name), name in result.missing) for name in SOURCES]
    return m.spark.createDataFrame(found, "table_name string, row_count bigint, missing boolean")


register(
    "loaded_sources",
    _loaded,
    """
    SELECT 'orders' AS table_name, count(*) AS row_count, false AS missing FROM orders
    UNION ALL SELECT 'customers', count(*), false FROM customer
    UNION ALL SELECT 'order_items', count(*), false FROM lineitem
    UNION ALL SELECT 'order_payments', count(*), false FROM lineitem
    UNION ALL SELECT 'order_reviews', count(*), false FROM events
    UNION ALL SELECT 'products', count(*), false FROM part
    UNION ALL SELECT 'sellers', NULL, true
    UNION ALL SELECT 'product_category_translation', count(*), false FROM translation
    """,
)

# Operators ---------------------------------------------------------------------

register(
    "latest_review_per_order",
    lambda m: intermediate.latest_reviews(m.staging["stg_order_reviews"]),
    "SELECT order_id, review_score, comment_message FROM ranked_reviews WHERE place = 1",
)
register(
    "latest_address_per_person",
    lambda m: m.summary.select("customer_unique_id", "city", "state"),
    "SELECT customer_unique_id, city, state FROM history WHERE place = 1",
)
register(
    "payments_per_order",
    lambda m: intermediate.payments_per_order(m.staging["stg_order_payments"]),
    """
    SELECT order_id, total_revenue::DOUBLE AS total_revenue, max_installments,
           array_to_string(types, ', ') AS payment_types
    FROM paid
    """,
)
register(
    "items_per_order",
    lambda m: intermediate.items_per_order(m.staging["stg_order_items"]),
    doubles("bought_items", "items_subtotal", "total_freight"),
)
register(
    "payment_types_by_installments",
    lambda m: m.staging["stg_order_payments"]
    .groupBy("payment_installments")
    .agg(distinct_list(F.col("payment_type")).alias("payment_types")),
    """
    SELECT payment_installments,
           string_agg(DISTINCT payment_type, ', ' ORDER BY payment_type) AS payment_types
    FROM raw_payments GROUP BY payment_installments
    """,
)

# Forms a time can take in a file, chosen per row by the key.
TIME_FORMS = (
    "{day} 13:05:09",
    "{day}T23:59:59",
    "{day}",
    "{day} 1:02",
    "{year}",
    "{year}-07",
    "",
    "soon",
    "{year}-02-30",
    "{year}-2-3 04:05:06.789",
    "03:04:05",
    "{day} 25:00:00",
    "{day} 10:00:00+02:00",
    " {day} 10:00:00",
    "{day} ",
    "{day} 10",
    "{year}/02/03 04:05:06",
)


def _time_forms(m: Models) -> DataFrame:
    orders = m.spark.read.parquet(f"{m.folder}/orders.parquet")
    day, year = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy")
    text = F.lit(None).cast("string")
    for number, form in enumerate(TIME_FORMS):
        filled = F.replace(F.replace(F.lit(form), F.lit("{day}"), day), F.lit("{year}"), year)
        text = F.when(F.col("o_orderkey") % len(TIME_FORMS) == number, filled).otherwise(text)
    return orders.select("o_orderkey", safe_timestamp(text).alias("parsed"))


_forms = ", ".join("'" + form + "'" for form in TIME_FORMS)
register(
    "parsed_times",
    _time_forms,
    f"""
    SELECT o_orderkey, try_cast(replace(replace(
               [{_forms}][1 + o_orderkey % {len(TIME_FORMS)}],
               '{{day}}', o_orderdate::DATE::VARCHAR), '{{year}}', year(o_orderdate)::VARCHAR)
               AS TIMESTAMP) AS parsed
    FROM orders
    """,
)
register(
    "day_boundaries",
    lambda m: m.spark.read.parquet(f"{m.folder}/events.parquet").select(
        "event_id",
        day_diff(F.col("ts"), F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("two_hours_later"),
        day_diff(F.col("ts"), F.col("ts") - F.expr("INTERVAL 30 HOURS")).alias("thirty_before"),
    ),
    """
    SELECT event_id, date_diff('day', ts, ts + INTERVAL 2 HOUR) AS two_hours_later,
           date_diff('day', ts, ts - INTERVAL 30 HOUR) AS thirty_before
    FROM events
    """,
)
register(
    "price_bands",
    lambda m: m.spark.read.parquet(f"{m.folder}/customer.parquet").select(
        "c_custkey", value_segment(F.col("c_acctbal") / 4).alias("segment")
    ),
    """
    SELECT c_custkey, CASE WHEN c_acctbal / 4 >= 500 THEN 'High Value'
                           WHEN c_acctbal / 4 >= 150 THEN 'Mid Value' ELSE 'Low Value' END AS segment
    FROM customer
    """,
)
register(
    "percent_labels",
    lambda m: m.spark.read.parquet(f"{m.folder}/lineitem.parquet")
    .groupBy("l_suppkey")
    .agg(percent_of_rows(F.col("l_returnflag") == "R").alias("rate"))
    .select("l_suppkey", labels.percent_label(F.col("rate")).alias("label")),
    """
    SELECT l_suppkey, printf('%.1f%%', count(*) FILTER (l_returnflag = 'R') * 100.0::DOUBLE
                                       / count(*)) AS label
    FROM lineitem GROUP BY l_suppkey
    """,
)
register(
    "orders_with_customer_columns",
    lambda m: build.located_orders(m.staging, m.staging["stg_orders"]).select(
        "order_id", "customer_id", "customer_unique_id", "has_customer"
    ),
    """
    SELECT order_id, o.customer_id, customer_unique_id, c.customer_id IS NOT NULL AS has_customer
    FROM v_orders AS o LEFT JOIN v_customers AS c ON c.customer_id = o.customer_id
    """,
)
register(
    "items_with_seller",
    lambda m: lookup_join(
        m.staging["stg_order_items"].select("order_id", "order_item_id", "seller_id"),
        m.staging["stg_sellers"].select("seller_id", "city"),
        "seller_id",
    ),
    """
    SELECT i.seller_id, order_id, order_item_id, city
    FROM v_items AS i LEFT JOIN v_sellers AS s ON s.seller_id = i.seller_id
    """,
)
register(
    "items_with_product_shuffled",
    lambda m: lookup_join(
        m.staging["stg_order_items"].select("order_id", "order_item_id", "product_id"),
        m.staging["stg_products"].select("product_id", "category"),
        "product_id",
        broadcast_bytes=0,
    ),
    """
    SELECT i.product_id, order_id, order_item_id, category
    FROM v_items AS i LEFT JOIN v_products AS p ON p.product_id = i.product_id
    """,
)
register(
    "states_by_freight",
    lambda m: top_k(
        m.fct_order_items.groupBy("seller_state").agg(F.sum("freight_value").alias("freight")),
        7,
        "freight",
        "seller_state",
    ),
    """
    SELECT seller_state, sum(freight_value)::DOUBLE AS freight FROM f_items
    GROUP BY seller_state ORDER BY sum(freight_value) DESC, seller_state LIMIT 7
    """,
)

# Checks ------------------------------------------------------------------------


def _failing(label: str) -> Callable[[Models], DataFrame]:
    check = next(c for c in quality.CHECKS if c.label == label)

    def query(m: Models) -> DataFrame:
        model = m.staging.get(check.model)
        return check.failing_rows(m.mart(check.model) if model is None else model)

    return query


def _repeated(view: str, column: str) -> str:
    return f"""
    SELECT {column}, n_records
    FROM (SELECT {column}, count({column}) AS n_records FROM {view} GROUP BY {column})
    WHERE n_records >= 2
    """


CHECK_VIEWS = {
    "stg_orders": "v_orders",
    "stg_customers": "v_customers",
    "stg_products": "v_products",
    "stg_sellers": "v_sellers",
    "fct_orders": "f_orders",
    "fct_order_items": "f_items",
    "dim_customers": "d_customers",
}
_money_of = {
    "fct_orders": ORDER_MONEY,
    "fct_order_items": ("price", "freight_value", "total_item_value"),
    "dim_customers": ("lifetime_value",),
}
for _check in quality.CHECKS:
    _view = CHECK_VIEWS[_check.model]
    if _check.kind == quality.UNIQUE:
        _oracle = _repeated(_view, _check.column)
    elif _check.kind == quality.NOT_NULL:
        _oracle = doubles(_view, *_money_of.get(_check.model, ()))
        _oracle += f" WHERE {_check.column} IS NULL"
    else:
        continue
    register(f"check_{_check.label}", _failing(_check.label), _oracle)

register(
    "check_accepted_values_order_status",
    _failing("accepted_values_stg_orders_order_status"),
    f"""
    SELECT order_status, count(*) AS n_records FROM v_orders
    WHERE order_status NOT IN {quality.ORDER_STATUSES}
    GROUP BY order_status
    """,
)
register(
    "check_accepted_values_review_score",
    _failing("accepted_values_fct_orders_review_score"),
    f"""
    SELECT review_score, count(*) AS n_records FROM f_orders
    WHERE review_score NOT IN {quality.REVIEW_SCORES} GROUP BY review_score
    """,
)
register(
    "check_delivered_before_purchase",
    _failing("delivered_before_purchase"),
    """
    SELECT order_id, actual_delivery_days FROM f_orders
    WHERE actual_delivery_days < 0
    """,
)
register(
    "check_delivered_without_items",
    _failing("delivered_without_items"),
    """
    SELECT order_id, 0::BIGINT AS item_count FROM v_orders
    WHERE order_status = 'delivered' AND order_id NOT IN (SELECT order_id FROM v_items)
    """,
)
register(
    "check_negative_revenue",
    _failing("negative_revenue"),
    "SELECT order_id, total_revenue::DOUBLE AS total_revenue FROM paid WHERE total_revenue < 0",
)
register(
    "check_unique_order_items",
    lambda m: quality.Check("stg_order_items", "order_id", quality.UNIQUE).failing_rows(
        m.staging["stg_order_items"]
    ),
    _repeated("v_items", "order_id"),
)
register(
    "check_not_null_customer_of_order",
    lambda m: quality.Check(
        "fct_orders", "customer_unique_id", quality.NOT_NULL
    ).failing_rows(m.fct_orders).select("order_id", "customer_id"),
    """
    SELECT order_id, customer_id FROM v_orders
    WHERE customer_id NOT IN (SELECT customer_id FROM v_customers)
    """,
)


def _quality_report(m: Models) -> DataFrame:
    located = staged(m.located, "orders_with_customer")
    summary = build.customers(m.staging, located)
    return quality.check_report(
        {
            **m.staging,
            "fct_orders": marts.fct_orders(located),
            "fct_order_items": m.fct_order_items,
            "dim_customers": marts.dim_customers(summary),
        }
    )


def _report_oracle() -> str:
    rows = []
    for check in quality.CHECKS:
        view = CHECK_VIEWS[check.model]
        if check.kind == quality.UNIQUE:
            failures = f"(SELECT count(*) FROM ({_repeated(view, check.column)}))"
        elif check.kind == quality.NOT_NULL:
            failures = f"(SELECT count(*) - count({check.column}) FROM {view})"
        elif check.kind == quality.ROWS:
            failures = f"(SELECT count(*) FROM {view} WHERE {check.condition})"
        else:
            allowed = ", ".join(repr(value) for value in check.values)
            failures = (
                f"(SELECT count(DISTINCT {check.column}) FROM {view} "
                f"WHERE {check.column} NOT IN ({allowed}))"
            )
        rows.append(
            f"SELECT '{check.label}' AS \"check\", '{check.model}' AS model, "
            f"'{check.column}' AS \"column\", '{check.severity}' AS severity, "
            f"{failures} AS failures"
        )
    return f"""
    SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn'
                   ELSE 'fail' END AS status
    FROM ({" UNION ALL ".join(rows)})
    """


register("quality_report", _quality_report, _report_oracle())

# Reports -----------------------------------------------------------------------


def _where(chosen: ReportFilter, *more: str) -> str:
    parts = list(more)
    if chosen.years:
        parts.append(f"list_contains({list(chosen.years)}, purchase_year)")
    if chosen.states:
        names = ", ".join("'" + state.replace("'", "''") + "'" for state in chosen.states)
        parts.append(f"customer_state IN ({names})")
    return " WHERE " + " AND ".join(parts) if parts else ""


_DELIVERED = "order_status = 'delivered'"
_KNOWN_DAYS = "actual_delivery_days IS NOT NULL"


def _average(column: str, digits: int) -> str:
    return f"round(sum({column})::DOUBLE / nullif(count({column}), 0), {digits})"


def _order_reports(chosen: ReportFilter) -> dict[str, str]:
    base = _where(chosen, _DELIVERED)
    with_days = _where(chosen, _DELIVERED, _KNOWN_DAYS)
    on_time = "100.0::DOUBLE * count(*) FILTER (delivery_status = 'On Time') / nullif(count(*), 0)"
    late = "100.0::DOUBLE * count(*) FILTER (delivery_status = 'Late') / nullif(count(*), 0)"
    by_status = f"""SELECT order_status, count(*) AS orders FROM f_orders {_where(chosen)}
                    GROUP BY ALL"""
    by_delivery = f"""
        SELECT delivery_status, count(*) AS orders
        FROM f_orders {_where(chosen, _DELIVERED, "delivery_status IN ('On Time', 'Late')")}
        GROUP BY ALL"""
    kpis = f"""
        SELECT count(*) AS total_orders, round(sum(total_revenue), 0)::DOUBLE AS total_revenue,
               {_average("total_revenue", 2)} AS avg_order_value,
               {_average("review_score", 2)} AS avg_review_score
        FROM f_orders {base}"""
    delivery = f"""
        SELECT {_average("actual_delivery_days", 1)} AS avg_days, {on_time} AS on_time_rate,
               {late} AS late_rate
        FROM f_orders {with_days}"""
    trend = f"""
        SELECT year_month, {_average("actual_delivery_days", 1)} AS avg_days,
               {_average("days_vs_estimate", 1)} AS avg_vs_estimate
        FROM f_orders {with_days} GROUP BY year_month"""
    return {
        "overview_kpis": kpis,
        "overview_labels": f"""
            SELECT format('{{:,}}', total_orders) AS total_orders,
                   'R$ ' || format('{{:,}}', trunc(total_revenue)::BIGINT) AS total_revenue,
                   'R$ ' || printf('%.2f', avg_order_value) AS avg_order_value,
                   printf('%.2f', avg_review_score) AS avg_review_score
            FROM ({kpis})""",
        "revenue_by_month": f"""
            SELECT year_month, round(sum(total_revenue), 0)::DOUBLE AS revenue
            FROM f_orders {base} GROUP BY year_month""",
        "orders_by_status": by_status,
        "order_status_shares": f"""
            SELECT *, orders / sum(orders) OVER () AS share FROM ({by_status})""",
        "top_states_by_revenue": f"""
            SELECT customer_state AS state, round(sum(total_revenue), 0)::DOUBLE AS revenue
            FROM f_orders {base} GROUP BY customer_state
            ORDER BY revenue DESC NULLS LAST, state LIMIT 10""",
        "delivery_kpis": delivery,
        "delivery_labels": f"""
            SELECT avg_days::VARCHAR || ' days' AS avg_days,
                   printf('%.1f%%', on_time_rate) AS on_time_rate,
                   printf('%.1f%%', late_rate) AS late_rate
            FROM ({delivery})""",
        "orders_by_delivery_status": by_delivery,
        "delivery_status_shares": f"""
            SELECT *, orders / sum(orders) OVER () AS share FROM ({by_delivery})""",
        "slowest_states": f"""
            SELECT customer_state AS state, {_average("actual_delivery_days", 1)} AS avg_days
            FROM f_orders {with_days} GROUP BY customer_state
            ORDER BY avg_days DESC NULLS LAST, state LIMIT 15""",
        "delivery_trend": trend,
        "delivery_trend_long": f"""
            SELECT year_month, 'avg_days' AS variable, avg_days AS value FROM ({trend})
            UNION ALL
            SELECT year_month, 'avg_vs_estimate', avg_vs_estimate FROM ({trend})""",
    }


def _category_report(chosen: ReportFilter) -> str:
    years = ", ".join(map(str, chosen.years))
    year = f"AND year(purchased_at) IN ({years})" if chosen.years else ""
    return f"""
        SELECT product_category, round(sum(price), 0)::DOUBLE AS revenue, count(*) AS items_sold
        FROM f_items WHERE order_status = 'delivered' AND product_category IS NOT NULL {year}
        GROUP BY product_category ORDER BY revenue DESC, product_category LIMIT 15"""


_LEADING = """
    SELECT product_category FROM f_items
    WHERE order_status = 'delivered' AND product_category IS NOT NULL
    GROUP BY product_category ORDER BY sum(price) DESC, product_category LIMIT 5"""
_CUSTOMER_KPIS = f"""
    SELECT count(*) AS total_customers,
           sum(is_repeat_customer::INTEGER)::BIGINT AS repeat_customers,
           {_average("lifetime_value", 2)} AS avg_ltv,
           {_average("avg_review_score::DECIMAL(18, 2)", 2)} AS avg_review
    FROM d_customers"""
_SEGMENTS = "SELECT customer_segment, count(*) AS customers FROM d_customers GROUP BY ALL"

_PLAIN_REPORTS = {
    "years": "SELECT DISTINCT purchase_year FROM f_orders",
    "states": "SELECT DISTINCT customer_state FROM f_orders",
    "leading_categories": _LEADING,
    "leading_categories_by_month": f"""
        SELECT year_month, product_category, round(sum(price), 0)::DOUBLE AS revenue
        FROM f_items
        WHERE order_status = 'delivered' AND product_category IN ({_LEADING})
        GROUP BY year_month, product_category""",
    "customer_kpis": _CUSTOMER_KPIS,
    "customer_labels": f"""
        SELECT format('{{:,}}', total_customers) AS total_customers,
               format('{{:,}}', repeat_customers) AS repeat_customers,
               'R$ ' || printf('%.2f', avg_ltv) AS avg_ltv,
               printf('%.2f', avg_review) AS avg_review
        FROM ({_CUSTOMER_KPIS})""",
    "customers_by_segment": _SEGMENTS,
    "segment_shares": f"""
        SELECT *, customers / sum(customers) OVER () AS share FROM ({_SEGMENTS})""",
    "top_states_by_customers": """
        SELECT state, count(*) AS customers FROM d_customers
        GROUP BY state ORDER BY customers DESC, state LIMIT 10""",
    "new_and_repeat": """
        SELECT if(is_repeat_customer, 'Repeat', 'New') AS type, count(*) AS customers
        FROM d_customers GROUP BY ALL""",
    "top_customers": """
        SELECT customer_unique_id, state, customer_segment, total_orders,
               lifetime_value::DOUBLE AS lifetime_value, avg_review_score
        FROM d_customers ORDER BY lifetime_value DESC NULLS LAST, customer_unique_id LIMIT 100""",
}


def _report(name: str, chosen: ReportFilter = reports.EVERYTHING) -> Callable[[Models], DataFrame]:
    table = reports.REPORTS[name][0]
    return lambda m: reports.run_report({table: m.mart(table)}, name, chosen)


for _name, _oracle in _PLAIN_REPORTS.items():
    register(f"report_{_name}", _report(_name), _oracle)

_FEW = ("overview_kpis", "orders_by_status", "top_states_by_revenue", "top_categories")
for _suffix, _chosen, _only in (
    ("", reports.EVERYTHING, None),
    ("_some", SOME, None),
    ("_no_match", NO_MATCH, None),
    ("_one_year", ONE_YEAR, _FEW),
    ("_two_states", TWO_STATES, _FEW),
):
    _texts = _order_reports(_chosen)
    _texts["top_categories"] = _category_report(_chosen)
    for _name in _only or _texts:
        register(f"report_{_name}{_suffix}", _report(_name, _chosen), _texts[_name])

register(
    "report_category_bars",
    lambda m: reports.as_bars(
        reports.top_categories(m.fct_order_items), "items_sold", "product_category"
    ),
    _category_report(reports.EVERYTHING),
)


def _local_frame(m: Models, name: str) -> DataFrame:
    """A report as the local frame a caller gets, asked for twice."""
    session = reports.ReportSession({"fct_orders": m.fct_orders, "dim_customers": m.dim_customers})
    session.frame(name)
    return m.spark.createDataFrame(session.frame(name))


register("report_frame_of_segments", lambda m: _local_frame(m, "customers_by_segment"), None)
ORACLE["report_frame_of_segments"] = ORACLE["report_customers_by_segment"]
