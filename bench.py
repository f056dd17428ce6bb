"""Time the headline queries and print one JSON line.

``value`` sums the headline queries, which build their models from the star
tables. ``written_*`` are reports on the written marts, with and without a year.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from tradeloom.plans import build, reports
from tradeloom.session import get_session
from tradeloom.sources.star_tables import raw_tables
from tradeloom.verification.queries import QUERIES

HEADLINES = (
    "stg_orders",
    "stg_order_items",
    "stg_order_reviews",
    "stg_products",
    "payments_per_order",
    "items_per_order",
    "latest_review_per_order",
    "int_orders_enriched",
    "int_customer_summary",
    "fct_orders",
    "fct_order_items",
    "dim_customers",
    "report_overview_kpis",
    "report_revenue_by_month",
    "report_orders_by_status",
    "report_top_states_by_revenue",
    "report_delivery_kpis",
    "report_orders_by_delivery_status",
    "report_slowest_states",
    "report_delivery_trend",
    "report_top_categories",
    "report_leading_categories_by_month",
    "report_customer_kpis",
    "report_customers_by_segment",
    "report_top_states_by_customers",
    "report_new_and_repeat",
    "report_top_customers",
)


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


WRITTEN = ("overview_kpis", "revenue_by_month", "top_states_by_revenue", "top_categories", "top_customers")
YEAR = reports.ReportFilter(years=(1997,))


def best(job, times: int = 3) -> float:
    """Least of several runs after one to warm up."""
    job()
    return round(min(timed(job) for _ in range(times)), 3)


def timed(job) -> float:
    start = time.perf_counter()
    job()
    return time.perf_counter() - start


def written_reports(spark, folder: str) -> dict[str, float]:
    """Reports on marts written to a lake; a year reads its own folder only."""
    with tempfile.TemporaryDirectory(prefix="bench-lake-") as lake:
        models = build.build_warehouse(spark, raw_tables(spark, folder), f"file://{lake}").models
        found = {}
        for name in WRITTEN:
            for label, chosen in (("", reports.ReportFilter()), ("_one_year", YEAR)):
                job = lambda: noop(reports.run_report(models, name, chosen))  # noqa: B023, E731
                found[f"written_{name}{label}"] = best(job)
        year = reports.run_report(models, "revenue_by_month", YEAR)
        assert "PartitionFilters: [isnotnull(purchase_year" in year._jdf.queryExecution().toString()
        return found


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        master=f"local[{cpus}]",
        extra={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, "report_overview_kpis", folder)
    found = {name: best(lambda: seconds(spark, name, folder), 2) for name in HEADLINES}  # noqa: B023
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(found.values()), 3),
        "unit": "sec",
        "queries": found | written_reports(spark, folder),
        "sf": folder.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
