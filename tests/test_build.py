"""CSV folder to checked marts."""

import re
import time

import pytest

import shop
from tradeloom.plans import build, quality, reports
from tradeloom.plans.quality import CHECKS, Check, ChecksFailed


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    shop.write_csvs(folder)
    root = str(tmp_path_factory.mktemp("lake"))
    build.run(spark, str(folder), root)
    loaded, warehouse = build.run(spark, str(folder), root)
    assert loaded.missing == []
    return warehouse


def test_tables_and_views(spark, built):
    assert {t.name for t in spark.catalog.listTables("analytics")} >= set(build.MARTS)
    for name in build.MARTS:
        assert spark.table(f"analytics.{name}").count() == built.models[name].count()
    for name in build.VIEWS:
        assert spark.table(name).columns == built.models[name].columns
    assert spark.table("analytics.fct_orders").count() == len(shop.ROWS["orders"])


def test_year_folders_prune(spark, built):
    chosen = reports.ReportFilter(years=(2018,))
    rows = spark.table("analytics.fct_orders").filter(chosen.condition())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_year" in plan
    assert rows.count() == 2


def test_checks_of_the_shop(built):
    found = {row.check: row for row in built.checks.collect()}
    assert len(found) == len(CHECKS) == 22
    failing = {name: (row.failures, row.status) for name, row in found.items() if row.failures}
    assert failing == {
        "delivered_before_purchase": (1, "fail"),
        "delivered_without_items": (4, "fail"),
        "negative_revenue": (1, "fail"),
    }
    with pytest.raises(ChecksFailed, match="3 checks failed.*negative_revenue"):
        quality.enforce(built.checks)


BROKEN = {
    "orders": [
        *shop.ROWS["orders"],
        ("o1", "c2", "lost", *shop.ROWS["orders"][0][3:]),
        ("o1", "c2", "lost", *shop.ROWS["orders"][0][3:]),
        (None, None, None, *shop.ROWS["orders"][0][3:]),
    ],
    "order_reviews": [*shop.ROWS["order_reviews"], ("r9", "o4", 7, None, None, "2018-01-01", None)],
    "products": [*shop.ROWS["products"], ("x1", None, None, None, None, None, None)],
}


def test_broken_rows_are_found(spark):
    frames = build.staging_models(shop.raw_frames(spark, BROKEN))
    located = build.located_orders(frames, build.enriched_orders(frames))
    from tradeloom.plans import marts

    models = {
        **frames,
        "fct_orders": marts.fct_orders(located),
        "fct_order_items": build.order_items(frames),
        "dim_customers": marts.dim_customers(build.customers(frames, located)),
    }
    report = {row.check: (row.failures, row.status) for row in quality.check_report(models).collect()}
    assert report["unique_stg_orders_order_id"] == (1, "fail")
    assert report["unique_stg_products_product_id"] == (1, "fail")
    assert report["unique_stg_sellers_seller_id"] == (0, "pass")
    assert report["not_null_stg_orders_order_id"] == (1, "fail")
    assert report["not_null_stg_orders_customer_id"] == (1, "fail")
    assert report["not_null_stg_orders_order_status"] == (1, "fail")
    assert report["accepted_values_stg_orders_order_status"] == (1, "fail")
    assert report["accepted_values_fct_orders_review_score"] == (1, "warn")
    repeated = CHECKS[0].failing_rows(models["stg_orders"]).collect()
    assert [tuple(row) for row in repeated] == [("o1", 3)]
    statuses = next(c for c in CHECKS if c.column == "order_status" and c.values)
    assert [tuple(r) for r in statuses.failing_rows(models["stg_orders"]).collect()] == [("lost", 2)]


def test_warnings_do_not_fail_the_run(spark):
    frame = spark.createDataFrame([(9,), (None,)], "score int")
    check = Check("m", "score", quality.ACCEPTED, severity="warn", values=(1, 2))
    report = quality.check_report({"m": frame}, [check])
    assert report.first().status == "warn"
    quality.enforce(report)


def test_order_fact_is_written_once_without_a_shuffle_for_its_layout(spark, built, tmp_path, monkeypatch):
    """The person history reads the order fact's version, which holds two columns more."""
    from tradeloom.plans import marts
    from tradeloom.sources.tables import version_frame

    shown, version = spark.table("analytics.fct_orders"), version_frame(spark, "analytics", "fct_orders")
    assert set(version.columns) - set(shown.columns) == set(marts.MARKS)
    assert built.models["fct_orders"].columns == marts.fct_orders(version).columns
    plan = built.models["int_customer_summary"]._jdf.queryExecution().optimizedPlan().toString()
    assert "order_repeats" in plan and "analytics_versions" in plan

    planned = []

    def keep(df, database, table, *args, **named):
        planned.append(df._jdf.queryExecution().optimizedPlan().toString())
        return spark.table(f"{database}.{table}")

    monkeypatch.setattr(build, "replace_table", keep)
    build.build_warehouse(spark, shop.raw_frames(spark, {}), str(tmp_path), parallel=1)
    assert len(planned) == 3 and not any("Rebalance" in plan for plan in planned)


def test_customers_that_fit_a_lookup_move_no_orders(spark, tmp_path, monkeypatch):
    """Orders of repeated and unknown customers give the same rows either way."""
    customers = [*shop.ROWS["customers"], ("c1", "p9", "1", "Twice", "SP"), (None, "p10", "1", "None", "SP")]
    orders = [*shop.ROWS["orders"], ("o10", None, *shop.ROWS["orders"][0][2:])]
    frames = build.staging_models(shop.raw_frames(spark, {"customers": customers, "orders": orders}))
    frames["stg_customers"].write.parquet(f"{tmp_path}/customers")
    models = {**frames, "stg_customers": spark.read.parquet(f"{tmp_path}/customers")}
    found = []
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most in (2**30, 0):
            monkeypatch.setattr(build, "lookup_bytes", lambda _, most=most: most)
            located = build.located_orders(models, build.enriched_orders(models))
            text = located._jdf.queryExecution().executedPlan().toString()
            assert ("Join [customer_id" in text, "hashpartitioning(customer_id" in text) == (True, most == 0)
            found.append(sorted(map(str, located.collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found[0] == found[1] and len(found[0]) == len(orders) + 1


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files.mkString("\n")))


def test_a_build_leaves_no_shuffle_files(spark, tmp_path):
    """They go when a write ends, not when the driver collects its garbage."""
    from tradeloom.operators.stage import CLEANUP

    raw = shop.raw_frames(spark, {})
    written = raw["orders"].groupBy("order_id").count()
    written.write.parquet(f"{tmp_path}/other")
    before, set_before = shuffle_files(spark), spark.conf.get(CLEANUP)
    assert before
    build.build_warehouse(spark, raw, str(tmp_path))
    until = time.time() + 20
    while left := shuffle_files(spark) - before:
        assert time.time() < until, left
        time.sleep(0.2)
    assert spark.conf.get(CLEANUP) == set_before


@pytest.mark.parametrize("large, parallel", [(2**70, 2), (0, 1)])
def test_large_sides_run_one_after_the_other(spark, tmp_path, monkeypatch, large, parallel):
    seen = []
    monkeypatch.setattr(build, "LARGE_BYTES", large, raising=False)
    run = build.side_by_side
    monkeypatch.setattr(build, "side_by_side", lambda job, names, n: seen.append(n) or run(job, names, n))
    warehouse = build.build_warehouse(spark, shop.raw_frames(spark, {}), str(tmp_path))
    assert seen == [parallel]
    assert warehouse.models["fct_orders"].count() == len(shop.ROWS["orders"])
