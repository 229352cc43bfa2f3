"""Plan shape (no pair-emitting joins, pruned scans) and the CSV feed / sinks."""

import os

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.params import Params
from shelfwise.operators import etl
from shelfwise.plans import kpis, registry
from shelfwise.sources import feed, warehouse

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_no_pair_emitting_joins(spark, name):
    plan = _plan(registry.run(name, spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["sales_stats", "abc_stats", "sku_window_stats", "seasonal_analysis",
                                  "store_performance"])
def test_trailing_windows_prune_months_and_push_filters(spark, name):
    from shelfwise.plans import core, dashboards

    wh = warehouse.from_tpch(spark, SF)
    build = getattr(core, name, None) or getattr(dashboards, name)
    plan = _plan(build(wh, Params(read_snapshots=False)))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "inventory_data" in line]
    windowed = [s for s in scans if "month_key" in s.split("PartitionFilters:")[1].split("]")[0]]
    assert windowed, scans
    assert all("GreaterThanOrEqual(date" in s for s in windowed)


def test_current_stock_reads_only_needed_columns(spark):
    df = registry.run("current_stock_levels", spark, SF)
    files = df.inputFiles()
    assert files and all("/sku_analysis/" in f for f in files)  # the SKU table, not the history
    scan, = [line for line in _plan(df).splitlines() if "FileScan parquet" in line]
    assert "stock" in scan and "turnover" not in scan and "revenue_percentage" not in scan
    from shelfwise.functions.expr import decimals_to_double

    lazy = warehouse.from_tpch(spark, SF, materialized=False)
    plan = _plan(decimals_to_double(registry.QUERIES["current_stock_levels"](lazy, registry.DEFAULT)))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem" in line][0]
    assert "l_comment" not in scan and "l_receiptdate" not in scan


CSV = (
    "Date,Store ID,Product ID,Category,Region,Inventory Level,Units Sold,Units Ordered,Demand Forecast,"
    "Price,Discount,Weather Condition,Holiday/Promotion,Competitor Pricing,Seasonality\r\n"
    "2022-01-01,S001,P0001,Groceries,North,231,127,55,135.47,33.50,20,Rainy,\"Sale, big\",29.69,Autumn\r\n"
    "2022-01-01,S001,P0001,Groceries,North,999,1,1,1.00,1.00,0,Sunny,0,1.00,Autumn\r\n"
    "2022-01-02,S001,P0002,Toys,South,10,5,1,1.00,2.00,10,\\N,0,1.00,Winter\r\n"
    "bad-date,S001,P0002,Toys,South,10,5,1,1.00,2.00,10,Sunny,0,1.00,Winter\r\n"
)


def test_csv_feed_load_and_export(spark, tmp_dir):
    path = os.path.join(tmp_dir, "feed.csv")
    with open(path, "w", newline="") as fh:
        fh.write(CSV)
    staging = feed.read_staging(spark, path)
    assert staging.count() == 4
    wh = warehouse.load(spark, staging)
    rows = {(r.date.isoformat(), r.product_id): r for r in wh.fact.collect()}
    assert set(rows) == {("2022-01-01", "P0001"), ("2022-01-02", "P0002")}
    first = rows[("2022-01-01", "P0001")]
    assert first.inventory_level == 231 and first.holiday_promotion == "Sale, big"
    assert first.seasonality == "Autumn"  # no trailing carriage return
    assert rows[("2022-01-02", "P0002")].weather_condition is None
    out = os.path.join(tmp_dir, "out")
    feed.export_csv(registry.present("dim_products", wh.products), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["product_id", "category", "product_name"] and back.count() == 2


def test_materialized_equals_lazy(spark):
    lazy = warehouse.from_tpch(spark, SF, materialized=False)
    mat = warehouse.from_tpch(spark, SF)
    cols = lazy.fact.columns
    assert lazy.fact.exceptAll(mat.fact.select(*cols)).count() == 0
    assert mat.fact.select(*cols).exceptAll(lazy.fact).count() == 0
    from shelfwise.functions.expr import decimals_to_double

    # the lazy warehouse also takes the per-product-first path (dimension size unknown)
    for name in ["executive_kpi_dashboard", "current_stock_levels", "inventory_turnover", "store_performance",
                 "seasonal_analysis", "category_performance", "seasonality_summary"]:
        a = decimals_to_double(registry.QUERIES[name](lazy, registry.DEFAULT)).collect()
        b = decimals_to_double(registry.QUERIES[name](mat, registry.DEFAULT)).collect()
        assert sorted(a) == sorted(b), name


def test_kpi_upsert_is_idempotent(spark, tmp_dir):
    wh = warehouse.from_tpch(spark, SF)
    table = kpis.inventory_kpis(wh)
    path = os.path.join(tmp_dir, "kpis")
    kpis.upsert_kpis(table, path)
    kpis.upsert_kpis(table, path)
    back = spark.read.parquet(path)
    assert back.count() == table.count()
    assert back.groupBy("store_id", "region", "product_id", "calculation_date").count().filter("count > 1").count() == 0


def test_insert_ignore_on_load_order_columns(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early")], "k string, o int, v string")
    assert etl.insert_ignore(df, ["k"], [F.col("o")]).collect()[0].v == "early"


@pytest.mark.parametrize("name", ["stockout_risk", "executive_kpi_dashboard", "category_performance", "inventory_kpis"])
def test_simple_fused_and_snapshot_paths_agree(spark, name):
    sf = "/root/testdata/sf0.01"
    base = registry.run(name, spark, sf).collect()
    for p in (Params(read_snapshots=False), Params(read_snapshots=False, fused_sku_stats=True)):
        other = registry.run(name, spark, sf, p=p, fused=p.fused_sku_stats).collect()
        assert sorted(other) == sorted(base), p


def _fact_scans(df) -> int:
    """Fact scans of the plan that ran, after adaptive execution reused equal shuffles."""
    import re

    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return len(re.findall(r"FileScan parquet[^\n]*inventory_data", ran))


def test_fused_statistics_scan_the_window_once(spark):
    from shelfwise.plans import core

    p = Params(read_snapshots=False, fused_sku_stats=True)
    wh = warehouse.from_tpch(spark, SF)
    assert _fact_scans(core.sku_window_stats(wh, p)) == 1
    # ranks use the statistics in two shapes: to find the cuts and to number the rows
    assert _fact_scans(registry.run("abc_classification", spark, SF, p=p, fused=True)) <= 2
    assert _fact_scans(registry.run("abc_classification", spark, SF)) == 0


def test_season_reports_scan_the_year_once(spark):
    for name in ("seasonal_analysis", "seasonality_summary"):
        assert _fact_scans(registry.run(name, spark, SF)) == 1, name


def test_check_queries_read_the_written_kpi_table(spark):
    for name in ("inventory_kpis", "fk_violations", "table_profile"):
        assert "sku_window_stats" not in _plan(registry.run(name, spark, SF)), name


def test_snapshot_path_reads_no_fact(spark):
    plan = _plan(registry.run("stockout_risk", spark, SF))
    assert "inventory_data" not in plan


def test_export_reports_in_presentation_order(spark, tmp_dir):
    from shelfwise.plans import reports

    wh = warehouse.from_tpch(spark, "/root/testdata/sf0.01")
    paths = reports.export_reports(wh, tmp_dir, names=["stockout_risk", "store_performance"])
    risk = spark.read.option("header", True).option("inferSchema", True).csv(paths[0]).collect()
    scores = [r.stockout_risk_score for r in risk]
    assert len(risk) == 60 and scores == sorted(scores, reverse=True)
    stores = spark.read.option("header", True).option("inferSchema", True).csv(paths[1]).collect()
    turn = [r.inventory_turnover_ratio for r in stores]
    assert turn == sorted(turn, reverse=True)


def test_written_warehouse_from_csv_feed(spark, tmp_dir):
    path = os.path.join(tmp_dir, "feed.csv")
    with open(path, "w", newline="") as fh:
        fh.write(CSV)
    wh = warehouse.materialize(warehouse.load(spark, feed.read_staging(spark, path)), os.path.join(tmp_dir, "wh"))
    assert wh.fact.count() == 2 and str(wh.latest) == "2022-01-02"
    stock = {r.product_id: (r.inventory_level, r.stock_status) for r in
             registry.QUERIES["current_stock_levels"](wh, registry.DEFAULT).collect()}
    assert stock == {"P0001": (231, "HIGH"), "P0002": (10, "CRITICAL")}


def test_concurrent_first_calls_load_once(spark):
    from concurrent.futures import ThreadPoolExecutor

    sf = "/root/testdata/sf0.001"
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda _: warehouse.from_tpch(spark, sf, product_modulus=7), range(4)))
    assert all(w is got[0] for w in got)


def test_month_clustered_write_keeps_rows_and_cuts_files(spark, tmp_dir):
    import glob

    lazy = warehouse.from_tpch(spark, "/root/testdata/sf0.01", materialized=False)
    a = warehouse.materialize(lazy, os.path.join(tmp_dir, "plain"), cluster_months=False)
    lazy = warehouse.from_tpch(spark, "/root/testdata/sf0.01", materialized=False)
    b = warehouse.materialize(lazy, os.path.join(tmp_dir, "clustered"), cluster_months=True)
    assert a.fact.exceptAll(b.fact).count() == 0 and a.fact.count() == b.fact.count()

    def files(name):
        return len(glob.glob(os.path.join(tmp_dir, name, "inventory_data", "part=*", "month_key=*", "*.parquet")))

    assert files("clustered") <= files("plain")


def test_current_stock_presentation_order(spark):
    rows = registry.present("current_stock_levels", registry.run("current_stock_levels", spark, SF)).collect()
    rank = {"CRITICAL": 1, "LOW": 2, "NORMAL": 3, "HIGH": 4}
    keys = [(rank[r.stock_status], r.inventory_level) for r in rows]
    assert keys == sorted(keys) and "_status_rank" not in rows[0].asDict()
