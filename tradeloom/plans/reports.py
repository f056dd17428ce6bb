"""Report queries over the three mart tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.functions import labels
from tradeloom.functions.measures import (
    LATE,
    NOT_DELIVERED,
    ON_TIME,
    mean,
    percent_of_rows,
    repeat_label,
    round_column,
    round_double,
)
from tradeloom.functions.timestamps import in_years
from tradeloom.operators.ranking import share_of_total, to_long, top_k

DELIVERED = "delivered"


@dataclass(frozen=True)
class ReportFilter:
    """Chosen years and states. An empty choice does not filter; any other
    drops rows whose year or state is unknown."""

    years: tuple[int, ...] = ()
    states: tuple[str, ...] = ()

    def condition(self, status: str | None = DELIVERED) -> Column:
        chosen = F.lit(True)
        if self.years:
            chosen = chosen & F.col("purchase_year").isin(*self.years)
        if self.states:
            chosen = chosen & F.col("customer_state").isin(*self.states)
        if status is not None:
            chosen = chosen & (F.col("order_status") == status)
        return chosen

    def item_condition(self) -> Column:
        """Delivered items with a category, by year only."""
        chosen = (F.col("order_status") == DELIVERED) & F.col("product_category").isNotNull()
        return chosen & in_years(F.col("purchased_at"), self.years) if self.years else chosen


EVERYTHING = ReportFilter()


def _distinct(df: DataFrame, name: str) -> DataFrame:
    return df.select(name).distinct().orderBy(F.asc_nulls_last(name))


def _sum_by(df: DataFrame, keys: Sequence[str | Column], measure: str, name: str) -> DataFrame:
    """Sums rounded to whole units."""
    summed = df.groupBy(*keys).agg(F.sum(measure).alias(name))
    return summed.withColumn(name, round_column(summed, name, 0))


def _count_by(df: DataFrame, key: str | Column, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


# Order overview ------------------------------------------------------------


def years(fct_orders: DataFrame) -> DataFrame:
    return _distinct(fct_orders, "purchase_year")


def states(fct_orders: DataFrame) -> DataFrame:
    return _distinct(fct_orders, "customer_state")


def overview_kpis(fct_orders: DataFrame, chosen: ReportFilter = EVERYTHING) -> DataFrame:
    kpis = fct_orders.filter(chosen.condition()).agg(
        F.count("*").alias("total_orders"),
        F.sum("total_revenue").alias("total_revenue"),
        round_double(mean(F.col("total_revenue")), 2).alias("avg_order_value"),
        round_double(mean(F.col("review_score")), 2).alias("avg_review_score"),
    )
    return kpis.withColumn("total_revenue", round_column(kpis, "total_revenue", 0))


def overview_labels(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        labels.count_label(F.col("total_orders")).alias("total_orders"),
        labels.money_whole_label(F.col("total_revenue")).alias("total_revenue"),
        labels.money_label(F.col("avg_order_value")).alias("avg_order_value"),
        labels.score_label(F.col("avg_review_score")).alias("avg_review_score"),
    )


def revenue_by_month(fct_orders: DataFrame, chosen: ReportFilter = EVERYTHING) -> DataFrame:
    rows = fct_orders.filter(chosen.condition())
    monthly = _sum_by(rows, ["year_month"], "total_revenue", "revenue")
    return monthly.orderBy(F.asc_nulls_last("year_month"))


def orders_by_status(fct_orders: DataFrame, chosen: ReportFilter = EVERYTHING) -> DataFrame:
    """All statuses, not only delivered orders."""
    rows = fct_orders.filter(chosen.condition(status=None))
    return _count_by(rows, "order_status", "orders").orderBy(
        F.desc("orders"), F.asc_nulls_last("order_status")
    )


def top_states_by_revenue(
    fct_orders: DataFrame, chosen: ReportFilter = EVERYTHING, k: int = 10
) -> DataFrame:
    rows = fct_orders.filter(chosen.condition()).withColumnRenamed("customer_state", "state")
    return top_k(_sum_by(rows, ["state"], "total_revenue", "revenue"), k, "revenue", "state")


# Delivery --------------------------------------------------------------------


def _with_days(fct_orders: DataFrame, chosen: ReportFilter) -> DataFrame:
    return fct_orders.filter(chosen.condition() & F.col("actual_delivery_days").isNotNull())


def delivery_kpis(fct_orders: DataFrame, chosen: ReportFilter = EVERYTHING) -> DataFrame:
    return _with_days(fct_orders, chosen).agg(
        round_double(mean(F.col("actual_delivery_days")), 1).alias("avg_days"),
        percent_of_rows(F.col("delivery_status") == ON_TIME).alias("on_time_rate"),
        percent_of_rows(F.col("delivery_status") == LATE).alias("late_rate"),
    )


def delivery_labels(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        labels.days_label(F.col("avg_days")).alias("avg_days"),
        labels.percent_label(F.col("on_time_rate")).alias("on_time_rate"),
        labels.percent_label(F.col("late_rate")).alias("late_rate"),
    )


def orders_by_delivery_status(
    fct_orders: DataFrame, chosen: ReportFilter = EVERYTHING
) -> DataFrame:
    rows = fct_orders.filter(chosen.condition() & (F.col("delivery_status") != NOT_DELIVERED))
    return _count_by(rows, "delivery_status", "orders")


def slowest_states(
    fct_orders: DataFrame, chosen: ReportFilter = EVERYTHING, k: int = 15
) -> DataFrame:
    rows = _with_days(fct_orders, chosen).groupBy(F.col("customer_state").alias("state"))
    averages = rows.agg(round_double(mean(F.col("actual_delivery_days")), 1).alias("avg_days"))
    return top_k(averages, k, "avg_days", "state")


def delivery_trend(fct_orders: DataFrame, chosen: ReportFilter = EVERYTHING) -> DataFrame:
    return (
        _with_days(fct_orders, chosen)
        .groupBy("year_month")
        .agg(
            round_double(mean(F.col("actual_delivery_days")), 1).alias("avg_days"),
            round_double(mean(F.col("days_vs_estimate")), 1).alias("avg_vs_estimate"),
        )
        .orderBy(F.asc_nulls_last("year_month"))
    )


def delivery_trend_long(fct_orders: DataFrame, chosen: ReportFilter = EVERYTHING) -> DataFrame:
    """The trend as one line per measure."""
    trend = delivery_trend(fct_orders, chosen)
    return to_long(trend, ["year_month"], ["avg_days", "avg_vs_estimate"])


# Products --------------------------------------------------------------------


def top_categories(
    fct_order_items: DataFrame, chosen: ReportFilter = EVERYTHING, k: int = 15
) -> DataFrame:
    """Revenue and item count of the categories with the most item revenue."""
    summed = (
        fct_order_items.filter(chosen.item_condition())
        .groupBy("product_category")
        .agg(F.sum("price").alias("revenue"), F.count("*").alias("items_sold"))
    )
    rounded = summed.withColumn("revenue", round_column(summed, "revenue", 0))
    return top_k(rounded, k, "revenue", "product_category")


def leading_categories(fct_order_items: DataFrame, k: int = 5) -> DataFrame:
    """Names of the top categories over all years."""
    summed = (
        fct_order_items.filter(EVERYTHING.item_condition())
        .groupBy("product_category")
        .agg(F.sum("price").alias("revenue"))
    )
    return top_k(summed, k, "revenue", "product_category").select("product_category")


def leading_categories_by_month(fct_order_items: DataFrame, k: int = 5) -> DataFrame:
    """Monthly revenue of the ``k`` leading categories, for all years.

    The list stays in the query as a semi join; it has at most ``k`` rows, so
    it is sent to the executors.
    """
    leading = F.broadcast(leading_categories(fct_order_items, k))
    rows = fct_order_items.filter(F.col("order_status") == DELIVERED)
    rows = rows.join(leading, "product_category", "left_semi")
    monthly = _sum_by(rows, ["year_month", "product_category"], "price", "revenue")
    return monthly.orderBy(
        F.asc_nulls_last("year_month"), F.asc_nulls_last("product_category")
    ).select("year_month", "product_category", "revenue")


def as_bars(report: DataFrame, measure: str, tie: str) -> DataFrame:
    """Display order of bar rows: smallest total first."""
    return report.orderBy(F.asc_nulls_last(measure), F.asc_nulls_last(tie))


# Customers -------------------------------------------------------------------


def customer_kpis(dim_customers: DataFrame) -> DataFrame:
    score = F.col("avg_review_score").cast("decimal(18,2)")
    return dim_customers.agg(
        F.count("*").alias("total_customers"),
        F.sum(F.when(F.col("is_repeat_customer"), 1).otherwise(0)).alias("repeat_customers"),
        round_double(mean(F.col("lifetime_value")), 2).alias("avg_ltv"),
        round_double(mean(score), 2).alias("avg_review"),
    )


def customer_labels(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        labels.count_label(F.col("total_customers")).alias("total_customers"),
        labels.count_label(F.col("repeat_customers")).alias("repeat_customers"),
        labels.money_label(F.col("avg_ltv")).alias("avg_ltv"),
        labels.score_label(F.col("avg_review")).alias("avg_review"),
    )


def customers_by_segment(dim_customers: DataFrame) -> DataFrame:
    return _count_by(dim_customers, "customer_segment", "customers")


def top_states_by_customers(dim_customers: DataFrame, k: int = 10) -> DataFrame:
    return top_k(_count_by(dim_customers, "state", "customers"), k, "customers", "state")


def new_and_repeat(dim_customers: DataFrame) -> DataFrame:
    return _count_by(
        dim_customers, repeat_label(F.col("is_repeat_customer")).alias("type"), "customers"
    )


def top_customers(dim_customers: DataFrame, k: int = 100) -> DataFrame:
    rows = dim_customers.select(
        "customer_unique_id",
        "state",
        "customer_segment",
        "total_orders",
        "lifetime_value",
        "avg_review_score",
    )
    return top_k(rows, k, "lifetime_value", "customer_unique_id")


# All of them -----------------------------------------------------------------


def _shares(report: Callable[..., DataFrame], measure: str) -> Callable[..., DataFrame]:
    return lambda *args: share_of_total(report(*args), measure)


ORDERS, ITEMS, CUSTOMERS = "fct_orders", "fct_order_items", "dim_customers"

# Report name to its table, its function, and whether it takes the filter.
REPORTS: dict[str, tuple[str, Callable[..., DataFrame], bool]] = {
    "years": (ORDERS, years, False),
    "states": (ORDERS, states, False),
    "overview_kpis": (ORDERS, overview_kpis, True),
    "overview_labels": (ORDERS, lambda *args: overview_labels(overview_kpis(*args)), True),
    "revenue_by_month": (ORDERS, revenue_by_month, True),
    "orders_by_status": (ORDERS, orders_by_status, True),
    "order_status_shares": (ORDERS, _shares(orders_by_status, "orders"), True),
    "top_states_by_revenue": (ORDERS, top_states_by_revenue, True),
    "delivery_kpis": (ORDERS, delivery_kpis, True),
    "delivery_labels": (ORDERS, lambda *args: delivery_labels(delivery_kpis(*args)), True),
    "orders_by_delivery_status": (ORDERS, orders_by_delivery_status, True),
    "delivery_status_shares": (ORDERS, _shares(orders_by_delivery_status, "orders"), True),
    "slowest_states": (ORDERS, slowest_states, True),
    "delivery_trend": (ORDERS, delivery_trend, True),
    "delivery_trend_long": (ORDERS, delivery_trend_long, True),
    "top_categories": (ITEMS, top_categories, True),
    "leading_categories": (ITEMS, leading_categories, False),
    "leading_categories_by_month": (ITEMS, leading_categories_by_month, False),
    "customer_kpis": (CUSTOMERS, customer_kpis, False),
    "customer_labels": (CUSTOMERS, lambda df: customer_labels(customer_kpis(df)), False),
    "customers_by_segment": (CUSTOMERS, customers_by_segment, False),
    "segment_shares": (CUSTOMERS, _shares(customers_by_segment, "customers"), False),
    "top_states_by_customers": (CUSTOMERS, top_states_by_customers, False),
    "new_and_repeat": (CUSTOMERS, new_and_repeat, False),
    "top_customers": (CUSTOMERS, top_customers, False),
}


def run_report(
    marts: Mapping[str, DataFrame], name: str, chosen: ReportFilter = EVERYTHING
) -> DataFrame:
    table, report, takes_filter = REPORTS[name]
    return report(marts[table], chosen) if takes_filter else report(marts[table])


class ReportSession:
    """Reports as local frames, each reused for ``ttl`` seconds.

    What is kept is the finished report (grouped or limited, so a few hundred
    rows at most), not the mart behind it.
    """

    def __init__(self, marts: Mapping[str, DataFrame], ttl: float = 300, clock=time.monotonic):
        self._marts, self._ttl, self._clock = marts, ttl, clock
        self._kept: dict[tuple, tuple[float, pd.DataFrame]] = {}

    def frame(self, name: str, chosen: ReportFilter = EVERYTHING) -> pd.DataFrame:
        key = (name, chosen if REPORTS[name][2] else EVERYTHING)
        made, frame = self._kept.get(key, (None, None))
        if made is None or self._clock() - made >= self._ttl:
            frame = run_report(self._marts, *key).toPandas()
            now = self._clock()
            self._kept = {k: kept for k, kept in self._kept.items() if now - kept[0] < self._ttl}
            self._kept[key] = (now, frame)
        return frame.copy()

    def refresh(self) -> None:
        self._kept.clear()
