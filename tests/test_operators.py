"""Operators and expressions on their own."""

import random

import pytest
from pyspark.sql import functions as F

import shop
from tradeloom.functions import labels
from tradeloom.functions.measures import distinct_list, percent_of_rows, round_double
from tradeloom.functions.timestamps import in_years, year_month
from tradeloom.operators.latest import latest_by
from tradeloom.operators import lookup
from tradeloom.operators.lookup import hot_keys, lookup_join, measured_bytes, source_bytes
from tradeloom.operators.ranking import share_of_total, to_long, top_k
from tradeloom.operators.stage import stage_folder, staged
from tradeloom.plans import build
from tradeloom.sources.catalog import SOURCES
from tradeloom.sources.tables import load_all, read_tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def numbers(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def test_latest_by_prefers_newest_then_id(spark):
    rows = [(1, 5, 1, "a"), (1, 5, 2, "b"), (1, None, 9, "c"), (2, None, 1, None), (None, 1, 1, "d")]
    df = spark.createDataFrame(rows, "k int, at int, id int, v string")
    assert {r.k: r.v for r in latest_by(df, ["k"], ["at", "id"], ["v"]).collect()} == {
        1: "b",
        2: None,
        None: "d",
    }


def test_measured_bytes_counts_text(spark):
    df = spark.createDataFrame([("abc", 1), ("é", 2), (None, 3)], "s string, n int")
    assert measured_bytes(df) == 3 * 2 * 16 + 5
    with pytest.raises(TypeError):
        measured_bytes(spark.sql("SELECT array(1) AS a"))


def test_lookup_broadcasts_only_within_bound(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.range(50).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    small, large = lookup_join(left, right, "k"), lookup_join(left, right, "k", broadcast_bytes=10)
    assert "BroadcastHashJoin" in plan(small) and small.count() == large.count() == 100
    assert "ResolvedHint (strategy=broadcast)" not in large._jdf.queryExecution().analyzed().toString()


def test_a_source_read_twice_counts_once(spark, tmp_path):
    spark.range(1000).selectExpr("id AS k", "id % 7 AS brand").write.parquet(f"{tmp_path}/part")
    part = spark.read.parquet(f"{tmp_path}/part")
    other = spark.range(1000).selectExpr("id AS k", "id % 5 AS brand")
    other.write.parquet(f"{tmp_path}/other")
    names = part.select("brand").distinct().selectExpr("brand", "brand + 1 AS name")
    assert source_bytes(part.join(names, "brand", "left")) == source_bytes(part) > 0
    both = part.join(spark.read.parquet(f"{tmp_path}/other").select("k"), "k", "left")
    assert source_bytes(both) > source_bytes(part)


def test_the_bound_of_a_lookup_goes_by_the_least_heap(spark, monkeypatch):
    for heap, bound in ((10**9, lookup.LOOKUP_BYTES), (10 * 2**30, 2**30)):
        monkeypatch.setattr(lookup, "least_heap", lambda _, heap=heap: heap)
        assert lookup.lookup_bytes(spark) == bound
    monkeypatch.undo()
    assert 2**30 < lookup.least_heap(spark) <= 6 * 2**30


def test_lookups_run_no_job_before_the_action(spark, tmp_path):
    """Nor does a lookup that is itself a join count as large."""
    shop.write_csvs(tmp_path)
    load_all(spark, str(tmp_path))
    raw = read_tables(spark, SOURCES, "raw")
    spark.sparkContext.setJobGroup("lookups", "lookups")
    try:
        models = build.staging_models(raw)
        products, items = models["stg_products"], build.order_items(models)
        assert plan(items).count("BroadcastHashJoin [product") == 2
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("lookups")) == []
        assert products.count() and items.count()
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("lookups"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_keys(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    )
    (row,) = hot_keys(df, "k", share=0.05).frame.collect()
    assert row.k == -1 and row.salts == 1  # a third of the rows, at 8 partitions
    (row,) = hot_keys(df, "k", share=0.05, partitions=0.1).frame.collect()
    assert row.salts == 27
    nulls = spark.sql("SELECT CAST(NULL AS STRING) AS k FROM range(9)")
    for none, key in ((spark.range(30_000), "id"), (spark.range(0), "id"), (nulls, "k")):
        found = hot_keys(none, key, share=0.05)
        assert found.frame.collect() == [] and found.bytes == 0


def test_top_k_ties_and_nulls(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", None), ("d", 1)], "k string, v int")
    assert [r.k for r in top_k(df, 3, "v", "k").collect()] == ["a", "b", "d"]
    assert "TakeOrderedAndProject" in plan(top_k(df, 3, "v", "k"))


def test_share_of_total(spark):
    shares = {r.i: r.share for r in share_of_total(numbers(spark, [1.0, 3.0]), "v").collect()}
    assert shares == {0: 0.25, 1: 0.75}
    assert share_of_total(numbers(spark, []), "v").collect() == []


def test_shares_read_the_report_once(spark):
    report = spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 3).alias("k")).count()
    shares = share_of_total(report, "count")
    assert sum(row.share for row in shares.collect()) == pytest.approx(1)
    text = plan(shares)
    assert "Exchange hashpartitioning" not in text and "Range" not in text and "Window" not in text


def test_to_long(spark):
    df = spark.createDataFrame([("m", 1.0, None)], "k string, a double, b double")
    assert sorted(map(tuple, to_long(df, ["k"], ["a", "b"]).collect()), key=str) == [
        ("m", "a", 1.0),
        ("m", "b", None),
    ]


def test_staged_frame_is_read_from_the_shared_folder(spark):
    df = spark.range(5).select(F.col("id").cast("decimal(18,2)").alias("x"))
    kept = staged(df, "numbers")
    assert kept.schema == df.schema and kept.count() == 5
    assert all(stage_folder(spark) in name for name in kept.inputFiles())
    assert staged(df, "numbers").inputFiles() != kept.inputFiles()


def test_distinct_list(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "b"), (2, None), (3, ""), (3, None)], "k int, v string"
    )
    rows = df.groupBy("k").agg(distinct_list(F.col("v")).alias("v")).collect()
    assert {r.k: r.v for r in rows} == {1: "a, b", 2: None, 3: ""}


def test_percent_of_no_rows_is_null(spark):
    assert numbers(spark, []).agg(percent_of_rows(F.col("v") > 1)).first()[0] is None


def test_round_double_follows_the_binary_value(spark):
    values = [1.005, 2.675, -1.005, 0.125, 2.5, -2.5, 1e15 + 0.3]
    rows = numbers(spark, values).select("i", round_double(F.col("v"), 2), round_double(F.col("v"), 0))
    got = {r[0]: (r[1], r[2]) for r in rows.collect()}
    assert [got[i][0] for i in range(4)] == [1.0, 2.68, -1.0, 0.13]
    assert got[4][1] == 3.0 and got[5][1] == -3.0


def test_percent_label_equals_exact_rounding(spark):
    random.seed(1)
    values = [12.25, 12.75, 12.35, 0.05, 0.15, 0.25, 99.95, 0.0, 100.0, 33.35, 1 / 3, 66.65]
    values += [100.0 * random.randint(0, n) / n for n in range(1, 2001)]
    rows = numbers(spark, values).select("i", labels.percent_label(F.col("v"))).collect()
    wrong = [(values[r[0]], r[1]) for r in rows if r[1] != f"{values[r[0]]:.1f}%"]
    assert wrong == []


def test_other_labels(spark):
    row = spark.range(1).select(
        labels.count_label(F.lit(1234567)),
        labels.money_whole_label(F.lit(1999.99)),
        labels.money_label(F.lit(12.5)),
        labels.days_label(F.lit(12.5)),
        labels.score_label(F.lit(None).cast("double")),
    )
    assert tuple(row.first()) == ("1,234,567", "R$ 1,999", "R$ 12.50", "12.5 days", None)


def test_months_do_not_depend_on_the_session_time_zone(spark):
    times = spark.sql(
        "SELECT explode(array(TIMESTAMP_NTZ '2017-10-15 00:30:00', "
        "TIMESTAMP_NTZ '2018-11-30 23:59:59', NULL)) AS t"
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        months = [row[0] for row in times.select(year_month(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert months == ["2017-10", "2018-11", None]


def test_in_years_equals_year_and_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    ours = orders.filter(in_years(F.col("o_orderdate"), [1996, 1999]))
    assert ours.count() == orders.filter(F.year("o_orderdate").isin(1996, 1999)).count() > 0
    pushed = plan(ours).split("PushedFilters:")[1].split("]")[0]
    assert "GreaterThanOrEqual(o_orderdate" in pushed
