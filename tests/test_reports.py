"""Report filters, empty results, reuse of finished reports, plan shapes."""

import pytest
from pyspark.sql import functions as F

import shop
from tradeloom.plans import build, marts, reports
from tradeloom.plans.reports import REPORTS, ReportFilter, ReportSession, run_report


@pytest.fixture(scope="module")
def tables(spark):
    frames = build.staging_models(shop.raw_frames(spark))
    located = build.located_orders(frames, build.enriched_orders(frames))
    return {
        "fct_orders": marts.fct_orders(located).cache(),
        "fct_order_items": build.order_items(frames).cache(),
        "dim_customers": marts.dim_customers(build.customers(frames, located)).cache(),
    }


def frame(tables, name, chosen=reports.EVERYTHING):
    return [row.asDict() for row in run_report(tables, name, chosen).collect()]


def test_lists_put_unknown_last(tables):
    assert [r["purchase_year"] for r in frame(tables, "years")] == [2017, 2018, None]
    assert [r["customer_state"] for r in frame(tables, "states")][-1] is None


def test_choice_drops_unknown_and_no_choice_keeps(tables):
    counts = {
        chosen: sum(r["orders"] for r in frame(tables, "orders_by_status", chosen))
        for chosen in (
            ReportFilter(),
            ReportFilter(years=(2017, 2018)),
            ReportFilter(states=("SP", "O'D")),
            ReportFilter(years=(2018,), states=("RJ",)),
        )
    }
    assert list(counts.values()) == [9, 8, 4, 1]


def test_empty_choice_of_rows(tables):
    nothing = ReportFilter(years=(1900,))
    kpis = frame(tables, "overview_kpis", nothing)[0]
    assert kpis.pop("total_orders") == 0 and set(kpis.values()) == {None}
    assert set(frame(tables, "delivery_kpis", nothing)[0].values()) == {None}
    assert frame(tables, "revenue_by_month", nothing) == []
    assert frame(tables, "order_status_shares", nothing) == []


def test_customer_kpis_of_no_customers(tables):
    row = reports.customer_kpis(tables["dim_customers"].limit(0)).first()
    assert row.total_customers == 0 and row.repeat_customers is None and row.avg_ltv is None


def test_items_ignore_states_and_overall_lists_ignore_years(tables):
    by_state = frame(tables, "top_categories", ReportFilter(states=("nowhere",)))
    assert by_state == frame(tables, "top_categories")
    assert frame(tables, "top_categories", ReportFilter(years=(2018,))) == []
    assert frame(tables, "leading_categories_by_month", ReportFilter(years=(1900,)))


def test_no_leading_categories(tables):
    empty = tables["fct_order_items"].filter("false")
    assert reports.leading_categories_by_month(empty).collect() == []


def test_bars_show_smallest_first(tables):
    bars = reports.as_bars(run_report(tables, "top_categories"), "revenue", "product_category")
    totals = [row.revenue for row in bars.collect()]
    assert totals == sorted(totals) and len(totals) == 2


def test_rates_and_labels(tables):
    kpis = frame(tables, "delivery_kpis")[0]
    assert kpis["on_time_rate"] + kpis["late_rate"] == pytest.approx(100)
    assert frame(tables, "delivery_labels")[0]["on_time_rate"].endswith("%")
    assert frame(tables, "overview_labels")[0]["total_orders"] == "7"


def test_session_reuses_reports_until_they_age(tables):
    now = [0.0]
    calls = []

    class Counting(dict):
        def __getitem__(self, key):
            calls.append(key)
            return super().__getitem__(key)

    session = ReportSession(Counting(tables), ttl=300, clock=lambda: now[0])
    first = session.frame("overview_kpis")
    session.frame("customer_kpis", ReportFilter(years=(2017,)))
    session.frame("customer_kpis")
    assert len(calls) == 2
    now[0] = 299
    assert session.frame("overview_kpis").equals(first) and len(calls) == 2
    session.frame("overview_kpis", ReportFilter(years=(2017,)))
    assert len(calls) == 3
    now[0] = 300
    session.frame("overview_kpis")
    assert len(calls) == 4
    session.refresh()
    session.frame("overview_kpis")
    assert len(calls) == 5


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_plans_have_no_products_or_python(tables, name):
    text = plan(run_report(tables, name))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "Window "):
        assert unwanted not in text


def test_month_report_uses_a_semi_join(tables):
    text = plan(reports.leading_categories_by_month(tables["fct_order_items"]))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text and "TakeOrderedAndProject" in text


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "fct_orders")
    rows = spark.createDataFrame(
        [("o", 2017, "SP", "delivered", 1.0, "x")],
        "order_id string, purchase_year int, customer_state string, order_status string, "
        "total_revenue double, review_comment string",
    )
    rows.write.parquet(path)
    table = spark.read.parquet(path)
    text = plan(reports.top_states_by_revenue(table, ReportFilter(years=(2017,), states=("SP",))))
    schema = text.split("ReadSchema: ")[1]
    assert "review_comment" not in schema and "order_id" not in schema
    pushed = text.split("PushedFilters: ")[1].split("ReadSchema")[0]
    for part in ("order_status", "purchase_year", "customer_state"):
        assert part in pushed


def test_unused_facts_are_not_joined(tables, spark):
    """A status count needs neither payments nor reviews nor items."""
    frames = build.staging_models(shop.raw_frames(spark))
    orders = build.enriched_orders(frames)
    text = plan(orders.groupBy("order_status").agg(F.count("*").alias("n")))
    assert "Join" not in text
