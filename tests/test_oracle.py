"""Every registered query against its DuckDB oracle on the driver's tables."""

import os

import pytest
from compare import compare, duck

import __spark_entry__ as se
from shelfwise.plans import registry, roundtrips

SF = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]


@pytest.mark.parametrize("sf_dir", [s for s in SF if os.path.exists(s)])
def test_all_queries_match_oracle(spark, sf_dir):
    res = compare(spark, sf_dir, [*registry.QUERIES, *roundtrips.QUERIES], con=duck(sf_dir))
    bad = {k: v for k, v in res.items() if not (v.get("schema_ok") and v.get("values_ok"))}
    assert not bad, bad


def test_every_query_has_oracle():
    assert set(registry.QUERIES) <= set(se.queries())
    assert set(registry.QUERIES) <= set(se.oracle_sql()) <= set(se.queries())


def test_entry_smoke(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert rows[0]["total_store_locations"] > 0


def test_expected_sizes_sf0_01(spark):
    q = se.queries()
    sf = "/root/testdata/sf0.01"
    # sizes stated in FIXTURES.md for this mapping
    assert q["fact_inventory"](spark, sf).count() == 49326
    assert q["current_stock_levels"](spark, sf).count() == 250
    assert q["reorder_analysis"](spark, sf).count() == 60
    assert q["stockout_risk"](spark, sf).count() == 60


def test_wide_catalogue_matches_oracle(spark):
    """25,000 SKUs (product_id = l_partkey mod 1000): larger quartile groups
    and Pareto windows, many more reorder candidates per category."""
    sf = "/root/testdata/sf0.01"
    names = [
        "current_stock_levels", "reorder_analysis", "inventory_turnover", "abc_classification",
        "seasonal_analysis", "executive_kpi_dashboard", "store_performance", "category_performance",
        "seasonality_summary", "stockout_risk", "quality_report", "category_distribution", "inventory_kpis",
    ]
    res = compare(spark, sf, names, con=duck(sf), product_modulus=1000)
    bad = {k: v for k, v in res.items() if not (v.get("schema_ok") and v.get("values_ok"))}
    assert not bad, bad
