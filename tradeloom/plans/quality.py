"""Data checks: each finds failing rows, all of them fold into one report."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# The order statuses and review scores that may occur.
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
)
REVIEW_SCORES = (1, 2, 3, 4, 5)

UNIQUE, NOT_NULL, ACCEPTED, ROWS = "unique", "not_null", "accepted_values", "rows"


@dataclass(frozen=True)
class Check:
    """``kind`` says how ``column`` is checked; ``rows`` checks fail where
    ``condition`` holds and show ``shown``."""

    model: str
    column: str
    kind: str
    severity: str = "error"
    values: tuple = ()
    condition: str = ""
    name: str = ""
    shown: tuple[str, ...] = ()

    @property
    def label(self) -> str:
        return self.name or f"{self.kind}_{self.model}_{self.column}"

    def fails(self) -> Column:
        """Row condition of a check that looks at one row at a time."""
        return F.col(self.column).isNull() if self.kind == NOT_NULL else F.expr(self.condition)

    def failing_rows(self, df: DataFrame) -> DataFrame:
        """Rows (or repeated and unknown values with their counts) that fail."""
        value = F.col(self.column)
        counted = [F.count("*").alias("n_records")]
        if self.kind == UNIQUE:
            repeated = df.filter(value.isNotNull()).groupBy(self.column).agg(*counted)
            return repeated.filter("n_records > 1")
        if self.kind == ACCEPTED:
            return df.groupBy(self.column).agg(*counted).filter(~value.isin(*self.values))
        failing = df.filter(self.fails())
        return failing.select(*self.shown) if self.shown else failing


def _each(kind: str, columns: Mapping[str, Iterable[str]]) -> list[Check]:
    return [Check(model, name, kind) for model, names in columns.items() for name in names]


CHECKS: tuple[Check, ...] = (
    *_each(
        UNIQUE,
        {
            "stg_orders": ["order_id"],
            "stg_customers": ["customer_id"],
            "stg_products": ["product_id"],
            "stg_sellers": ["seller_id"],
            "fct_orders": ["order_id"],
            "dim_customers": ["customer_unique_id"],
        },
    ),
    *_each(
        NOT_NULL,
        {
            "stg_orders": ["order_id", "customer_id", "order_status"],
            "stg_customers": ["customer_id"],
            "stg_products": ["product_id"],
            "stg_sellers": ["seller_id"],
            "fct_orders": ["order_id", "total_revenue"],
            "fct_order_items": ["order_id", "price"],
            "dim_customers": ["customer_unique_id"],
        },
    ),
    Check("stg_orders", "order_status", ACCEPTED, values=ORDER_STATUSES),
    Check("fct_orders", "review_score", ACCEPTED, severity="warn", values=REVIEW_SCORES),
    Check(
        "fct_orders",
        "actual_delivery_days",
        ROWS,
        condition="actual_delivery_days < 0",
        name="delivered_before_purchase",
        shown=("order_id", "actual_delivery_days"),
    ),
    Check(
        "fct_orders",
        "item_count",
        ROWS,
        condition="order_status = 'delivered' AND item_count <= 0",
        name="delivered_without_items",
        shown=("order_id", "item_count"),
    ),
    Check(
        "fct_orders",
        "total_revenue",
        ROWS,
        condition="total_revenue < 0",
        name="negative_revenue",
        shown=("order_id", "total_revenue"),
    ),
)


class ChecksFailed(AssertionError):
    """At least one check of severity ``error`` found failing rows."""


def check_report(models: Mapping[str, DataFrame], checks: Iterable[Check] = CHECKS) -> DataFrame:
    """``check, model, column, severity, failures, status`` of every check.

    All row-at-a-time checks of a model share one pass over it; a pass reads
    only the columns checked. Value checks group, which combines repeated
    values before the shuffle.
    """
    row_checks = defaultdict(list)
    parts = []
    for check in checks:
        if check.kind in (NOT_NULL, ROWS):
            row_checks[check.model].append(check)
        else:
            failing = check.failing_rows(models[check.model])
            parts.append(_as_rows(failing.agg(F.count("*").alias(check.label)), [check]))
    for model, group in row_checks.items():
        counts = [F.count_if(check.fails()).alias(check.label) for check in group]
        parts.append(_as_rows(models[model].agg(*counts), group))
    found = reduce(DataFrame.unionByName, parts)
    status = (
        F.when(F.col("failures") == 0, "pass")
        .when(F.col("severity") == "warn", "warn")
        .otherwise("fail")
    )
    return found.withColumn("status", status)


def _as_rows(counts: DataFrame, checks: list[Check]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(check.label).alias("check"),
            F.lit(check.model).alias("model"),
            F.lit(check.column).alias("column"),
            F.lit(check.severity).alias("severity"),
            F.col(check.label).alias("failures"),
        )
        for check in checks
    ]
    return counts.select(F.inline(F.array(*rows)))


def enforce(report: DataFrame) -> None:
    """Raise if a check failed; warnings pass. One row per check comes back."""
    failed = [row["check"] for row in report.filter("status = 'fail'").collect()]
    if failed:
        raise ChecksFailed(f"{len(failed)} checks failed: {', '.join(sorted(failed))}")
