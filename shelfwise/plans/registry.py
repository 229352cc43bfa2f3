"""Named analyses over a warehouse, with output types fixed for consumers.

``QUERIES[name](wh)`` returns the internal DataFrame (exact decimals);
``run(name, spark, sf_dir)`` loads (or reuses) the warehouse of the driver
tables in ``sf_dir`` and returns the presentation DataFrame (decimals as
doubles, dates as ISO text, no month partition column).
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.expr import presentation
from ..functions.params import DEFAULT, Params
from ..operators import etl, integrity, quality, rejects
from ..sources import warehouse as whmod
from ..sources.warehouse import Warehouse
from . import core, dashboards, kpis


def _fact(wh: Warehouse) -> DataFrame:
    return wh.fact.select(*schemas.INVENTORY.fieldNames())


def _tables(wh: Warehouse, p: Params) -> dict[str, DataFrame]:
    return {
        "inventory_data": _fact(wh),
        "inventory_kpis": kpis.inventory_kpis(wh, p),
        "products": wh.products,
        "staging_inventory_data": wh.staging,
        "stores": wh.stores,
    }


def _fk(wh: Warehouse, p: Params) -> DataFrame:
    """Of the fact's keys the staged rows that break them: the load drops these, so the fact itself has none."""
    return integrity.fk_violations(etl.parse_staging(wh.staging), wh.stores, wh.products, "inventory_data").unionByName(
        integrity.fk_violations(kpis.inventory_kpis(wh, p), wh.stores, wh.products, "inventory_kpis")
    )


def _rejects(wh: Warehouse, p: Params) -> DataFrame:
    if wh.load_log is None:
        raise ValueError("only a written warehouse has counted its loads")
    return rejects.load_rejects(wh.load_log)


def at_month_end(wh: Warehouse) -> Warehouse:
    """The warehouse as it stood at the end of the month before its latest date."""
    latest = wh.latest or wh.fact.agg(F.max("date")).first()[0]
    return whmod.as_of(wh, latest.replace(day=1) - datetime.timedelta(days=1))


def _pk(wh: Warehouse, p: Params) -> DataFrame:
    parsed = etl.parse_staging(wh.staging)
    return integrity.pk_violations(
        [
            ("staging_inventory_data", parsed, schemas.INVENTORY_KEY),
            ("inventory_data", integrity.suspects(_fact(wh).select(*schemas.INVENTORY_KEY), "date", schemas.SKU), schemas.INVENTORY_KEY),
            ("stores", wh.stores, schemas.STORES_KEY),
            ("products", wh.products, schemas.PRODUCTS_KEY),
            ("inventory_kpis", kpis.inventory_kpis(wh, p), schemas.KPIS_KEY),
        ]
    )


QUERIES: dict[str, Callable[[Warehouse, Params], DataFrame]] = {
    # the ten analyses
    "current_stock_levels": core.current_stock_levels,
    "reorder_analysis": core.reorder_analysis,
    "inventory_turnover": core.inventory_turnover,
    "abc_classification": core.abc_classification,
    "seasonal_analysis": core.seasonal_analysis,
    "executive_kpi_dashboard": dashboards.executive_kpi_dashboard,
    "store_performance": dashboards.store_performance,
    "category_performance": dashboards.category_performance,
    "seasonality_summary": dashboards.seasonality_summary,
    "stockout_risk": dashboards.stockout_risk,
    # load-time reports
    "quality_report": lambda wh, p: quality.quality_report(_fact(wh), wh.products),
    "region_distribution": lambda wh, p: quality.region_distribution(_fact(wh)),
    "category_distribution": lambda wh, p: quality.category_distribution(_fact(wh), wh.products),
    # tables of the model
    "dim_stores": lambda wh, p: wh.stores,
    "dim_products": lambda wh, p: wh.products,
    "fact_inventory": lambda wh, p: _fact(wh),
    "inventory_kpis": kpis.inventory_kpis,
    # key and catalog checks
    "table_profile": lambda wh, p: integrity.table_profile(wh.spark, _tables(wh, p)),
    "fk_violations": _fk,
    "pk_violations": _pk,
    "constraint_report": lambda wh, p: integrity.constraint_report(_fk(wh, p)),
    "load_rejects": _rejects,
    # an earlier date
    "inventory_kpis_at_month_end": lambda wh, p: kpis.inventory_kpis(at_month_end(wh), p),
    "stockout_risk_at_month_end": lambda wh, p: dashboards.stockout_risk(at_month_end(wh), p),
    "executive_kpi_dashboard_at_month_end": lambda wh, p: dashboards.executive_kpi_dashboard(at_month_end(wh), p),
}

# Presentation order of each report (the reference's ORDER BY, with the key
# columns appended so the order is total).
ORDER_BY: dict[str, list] = {
    "current_stock_levels": ["_status_rank", "inventory_level", "store_id", "region", "product_id"],
    "reorder_analysis": ["category", "_coverage", "store_id", "region", "product_id"],
    "inventory_turnover": ["category", ("inventory_turnover_ratio", "desc"), "store_id", "region", "product_id"],
    "abc_classification": ["store_id", "region", "revenue_rank"],
    "seasonal_analysis": ["category", "seasonality", "weather_condition", "store_id", "region"],
    "store_performance": [("inventory_turnover_ratio", "desc"), "store_id", "region"],
    "category_performance": [("total_revenue_90d_usd", "desc"), "category"],
    "seasonality_summary": [("seasonal_index", "desc"), "seasonality"],
    "stockout_risk": [("stockout_risk_score", "desc"), "store_id", "region", "product_id"],
    "region_distribution": ["region"],
    "category_distribution": ["category"],
    "dim_stores": ["store_id", "region"],
    "dim_products": ["category", "product_id"],
    "fact_inventory": list(schemas.INVENTORY_KEY),
    "table_profile": ["table_name"],
    "load_rejects": ["reason", "column_name"],
    "constraint_report": ["table_name", "column_name"],
}


def present(name: str, df: DataFrame) -> DataFrame:
    """Apply the report's presentation order (a global sort: use for export)."""
    keys = ORDER_BY.get(name)
    if not keys:
        return df
    if "_status_rank" in keys:
        rank = {s: i + 1 for i, s in enumerate(core.STOCK_STATUS)}
        df = df.withColumn(
            "_status_rank",
            F.coalesce(*[F.when(F.col("stock_status") == s, F.lit(r)) for s, r in rank.items()], F.lit(4)),
        )
    if "_coverage" in keys:  # the unrounded ratio
        df = df.withColumn("_coverage", F.col("current_stock") / F.greatest(F.col("reorder_point"), F.lit(1)))
    cols = [F.col(k[0]).desc() if isinstance(k, tuple) else F.col(k).asc() for k in keys]
    return df.orderBy(*cols).drop("_status_rank", "_coverage")


# Queries that read both the sales-window and the ABC-window statistics:
# they use the fused per-SKU aggregate (one scan, one shuffle).
FUSED = {
    "executive_kpi_dashboard",
    "category_performance",
    "stockout_risk",
    "inventory_kpis",
    "table_profile",
    "fk_violations",
    "pk_violations",
    "constraint_report",
}


def run(
    name: str,
    spark: SparkSession,
    sf_dir: str,
    p: Params = DEFAULT,
    materialized: bool = True,
    fused: bool | None = None,
    product_modulus: int = 10,
) -> DataFrame:
    wh = whmod.from_tpch(spark, sf_dir, product_modulus=product_modulus, materialized=materialized)
    if fused is None:
        fused = p.fused_sku_stats or name in FUSED
    if fused != p.fused_sku_stats:
        p = replace(p, fused_sku_stats=fused)
    return presentation(QUERIES[name](wh, p))
