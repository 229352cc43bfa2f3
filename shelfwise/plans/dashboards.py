"""Dashboard analyses built on the core views: executive KPIs, store and
category performance, seasonality summary, stockout risk.

Scale notes
-----------
* Everything is aggregated from SKU-grain tables, distinct days by merging day bitmaps; on a written
  warehouse no dashboard but the seasonality summary reads the fact.
* What a dashboard needs of stock, reorder, turnover and ABC is one row per SKU of
  ``core.sku_analysis``: on a written warehouse a single scan of a stored table, without rank or join.
* One-row results are combined by a union and one aggregate, never a cross
  join; global ranks run over one row per store location or category.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.expr import (
    band,
    count_if,
    greatest_strict,
    mean,
    ratio,
    rnd,
    rnd_int,
    sum_if,
)
from ..functions.params import DEFAULT, Params
from ..operators import sku_stats
from ..operators.windowing import descending
from ..sources.warehouse import Warehouse
from . import core

SKU = list(schemas.SKU)
LOC = list(schemas.LOCATION)


def one_row(*frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row aggregates side by side: each becomes
    a row of one union, and the greatest of a column is its only value."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def _rating(turnover: Column, p: Params) -> Column:
    return band(
        [
            (turnover >= p.excellent_turnover, "EXCELLENT"),
            (turnover >= p.good_turnover, "GOOD"),
            (turnover >= p.average_turnover, "AVERAGE"),
        ],
        "NEEDS_IMPROVEMENT",
    )


def _fill_rate(total: Column, critical: Column) -> Column:
    return rnd(ratio(total - critical, F.greatest(total, F.lit(1))) * 100, 2)


# ---------------------------------------------------------------- Q6
def executive_kpi_dashboard(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    def build():
        week = core.sku_window_stats(wh, p).filter(F.col("week_n") > 0)
        current = week.agg(
            F.count_distinct(F.concat(F.col("store_id"), F.lit("-"), F.col("region"))).alias(
                "total_store_locations"
            ),
            F.count_distinct("product_id").alias("total_products"),
            F.sum("week_level").alias("total_inventory_units"),
            F.round(F.sum("week_net_level"), 2).alias("total_inventory_value_usd"),
            F.sum("week_units").alias("weekly_units_sold"),
        ).select("*", wh.latest_date().alias("data_updated_date"))

        mv, st, cls = F.col("turnover.movement_type"), F.col("stock.stock_status"), F.col("abc.abc_classification")
        revenue = F.col("abc.total_revenue")
        skus = core.sku_analysis(wh, p).agg(
            mean(F.sum("turnover.inventory_turnover_ratio"), F.count("turnover")).alias("avg_turnover_raw"),
            count_if(mv == "FAST_MOVER").alias("fast_moving_products"),
            count_if(mv == "MEDIUM_MOVER").alias("medium_moving_products"),
            count_if(mv == "SLOW_MOVER").alias("slow_moving_products"),
            count_if(mv == "NON_MOVER").alias("non_moving_products"),
            count_if(st == "CRITICAL").alias("critical_stock_items"),
            count_if(st == "LOW").alias("low_stock_items"),
            F.count(F.lit(1)).alias("stock_items"),
            count_if(cls == "A").alias("class_a_products"),
            count_if(cls == "B").alias("class_b_products"),
            count_if(cls == "C").alias("class_c_products"),
            sum_if(cls == "A", revenue).alias("rev_a"),
            sum_if(cls == "B", revenue).alias("rev_b"),
            sum_if(cls == "C", revenue).alias("rev_c"),
            F.sum(revenue).alias("rev_total"),
        )
        row = one_row(current, skus)
        avg_t = F.col("avg_turnover_raw")
        crit, total = F.col("critical_stock_items"), F.col("stock_items")
        crit_share = ratio(crit, total)
        status = band(
            [
                ((avg_t >= p.good_turnover) & (crit_share < p.good_critical_share), "GOOD"),
                ((avg_t >= p.average_turnover) & (crit_share < p.average_critical_share), "AVERAGE"),
            ],
            "NEEDS_IMPROVEMENT",
        )
        return row.select(
            "total_store_locations",
            "total_products",
            "total_inventory_units",
            "total_inventory_value_usd",
            "weekly_units_sold",
            rnd(avg_t, 2).alias("avg_turnover_ratio"),
            "fast_moving_products",
            "medium_moving_products",
            "slow_moving_products",
            "non_moving_products",
            "critical_stock_items",
            "low_stock_items",
            (crit + F.col("low_stock_items")).alias("total_alerts"),
            _fill_rate(total, crit).alias("fill_rate_pct"),
            "class_a_products",
            "class_b_products",
            "class_c_products",
            rnd(ratio("rev_a", "rev_total") * 100, 2).alias("class_a_revenue_pct"),
            rnd(ratio("rev_b", "rev_total") * 100, 2).alias("class_b_revenue_pct"),
            rnd(ratio("rev_c", "rev_total") * 100, 2).alias("class_c_revenue_pct"),
            "data_updated_date",
            status.alias("overall_status"),
        )

    return wh.memo(("executive_kpi_dashboard", p), build)


# ------------------------------------------------- shared for Q7 and Q8
def _group_summary(wh: Warehouse, p: Params, key: list[str], by_category: bool) -> DataFrame:
    """Snapshot, 90-day sales, turnover and stock counts per ``key``, all from SKU-grain tables."""
    days = p.sales_window_days
    stats = core.sku_window_stats(wh, p).filter(F.col("n") > 0)
    if by_category:
        stats = stats.join(core.categories(wh), "product_id")
    today = F.col("day_n") > 0
    sales = stats.groupBy(*key).agg(
        F.count_distinct(F.when(today, F.col("product_id"))).alias("unique_products"),
        F.sum("day_level").alias("current_inventory_units"),
        F.round(F.sum("day_net_level"), 2).alias("current_inventory_value_usd"),
        F.sum("s1").alias("units_90d"),
        F.round(F.sum("s_net_units"), 2).alias("total_revenue_90d"),
        *sku_stats.merged_days(days),
    )
    # only groups with rows on the latest day have a snapshot
    sales = sales.filter(F.col("unique_products") > 0).withColumns(
        {"days_count": sku_stats.day_count(days), "data_updated_date": wh.latest_date()}
    )
    mv, st, cls = F.col("turnover.movement_type"), F.col("stock.stock_status"), F.col("abc.abc_classification")
    rows = core.sku_analysis(wh, p)
    if by_category:
        rows = rows.withColumn("category", F.col("stock.category"))
    skus = rows.groupBy(*key).agg(
        rnd(mean(F.sum("turnover.inventory_turnover_ratio"), F.count("turnover")), 2).alias("avg_turnover"),
        count_if(mv == "FAST_MOVER").alias("fast_movers"),
        count_if(mv.isin("SLOW_MOVER", "NON_MOVER")).alias("slow_movers"),
        count_if(st == "CRITICAL").alias("critical_items"),
        count_if(st == "LOW").alias("low_items"),
        F.count(F.lit(1)).alias("total_items"),
        count_if(cls == "A").alias("class_a_count"),
        count_if(cls == "B").alias("class_b_count"),
        count_if(cls == "C").alias("class_c_count"),
        F.count("turnover").alias("_sold"),
    )
    return sales.join(skus.filter(F.col("_sold") > 0).drop("_sold"), key)


def _guard(p: Params) -> Column:
    return F.lit(1 if p.reference_nullif_one else 0)


def _per_day(total: str, days: str, p: Params) -> Column:
    # x / NULLIF(days, 1): NULL when a group has exactly one day of data
    return ratio(F.col(total), F.nullif(F.col(days), _guard(p)))


# ---------------------------------------------------------------- Q7
def store_performance(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    def build():
        s = _group_summary(wh, p, LOC, by_category=False)
        crit, total = F.col("critical_items"), F.col("total_items")
        service = ratio(total - crit, F.greatest(total, F.lit(1)))
        # one row per store location: a global rank over them is small
        return s.select(
            *LOC,
            "unique_products",
            "current_inventory_units",
            "current_inventory_value_usd",
            rnd(_per_day("units_90d", "days_count", p), 2).alias("avg_daily_sales"),
            rnd(_per_day("total_revenue_90d", "days_count", p), 2).alias("avg_daily_revenue_usd"),
            F.col("avg_turnover").alias("inventory_turnover_ratio"),
            "fast_movers",
            "slow_movers",
            "critical_items",
            "low_items",
            (crit + F.col("low_items")).alias("total_alerts"),
            _fill_rate(total, crit).alias("fill_rate_pct"),
            F.dense_rank().over(Window.orderBy(F.col("avg_turnover").desc())).alias("turnover_rank"),
            F.dense_rank().over(Window.orderBy(service.desc())).alias("service_level_rank"),
            _rating(F.col("avg_turnover"), p).alias("performance_rating"),
            "data_updated_date",
        )

    return wh.memo(("store_performance", p), build)


# ---------------------------------------------------------------- Q8
def category_performance(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    def build():
        s = _group_summary(wh, p, ["category"], by_category=True)
        crit, total = F.col("critical_items"), F.col("total_items")
        daily_units = _per_day("units_90d", "days_count", p)
        return s.select(
            "category",
            "unique_products",
            "current_inventory_units",
            "current_inventory_value_usd",
            rnd(daily_units, 2).alias("avg_daily_sales"),
            rnd(_per_day("total_revenue_90d", "days_count", p), 2).alias("avg_daily_revenue_usd"),
            F.col("total_revenue_90d").alias("total_revenue_90d_usd"),
            F.col("avg_turnover").alias("inventory_turnover_ratio"),
            "fast_movers",
            "slow_movers",
            "critical_items",
            "low_items",
            (crit + F.col("low_items")).alias("total_alerts"),
            _fill_rate(total, crit).alias("fill_rate_pct"),
            "class_a_count",
            "class_b_count",
            "class_c_count",
            rnd_int(
                ratio(F.col("current_inventory_units"), greatest_strict(daily_units, F.lit(p.min_daily_sales)))
            ).alias("days_of_supply"),
            rnd(ratio(F.col("total_revenue_90d"), F.nullif(F.col("current_inventory_value_usd"), _guard(p))), 2).alias(
                "inventory_roi_90d"
            ),
            F.dense_rank().over(Window.orderBy(F.col("avg_turnover").desc())).alias("turnover_rank"),
            F.dense_rank().over(Window.orderBy(F.col("total_revenue_90d").desc())).alias("revenue_rank"),
            _rating(F.col("avg_turnover"), p).alias("performance_rating"),
            "data_updated_date",
        )

    return wh.memo(("category_performance", p), build)


# ---------------------------------------------------------------- Q9
def seasonality_summary(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    def build():
        sa = core.seasonal_analysis(wh, p)
        imp = F.col("impact_classification")
        # one aggregate per season and category; its sums add up to the season
        cat = sa.groupBy("seasonality", "category").agg(
            F.sum("total_units_sold").alias("units"),
            F.sum("total_revenue").alias("revenue"),
            F.sum("avg_daily_sales").alias("paces"),
            F.sum("days_count").alias("days"),
            F.count_distinct("store_id", "region").alias("places"),
            count_if(imp == "HIGH_IMPACT").alias("high"),
            count_if(imp == "NORMAL_IMPACT").alias("normal"),
            count_if(imp == "LOW_IMPACT").alias("low"),
            F.count(F.lit(1)).alias("n"),
            mean(F.sum("seasonal_index"), F.count(F.lit(1))).alias("avg_seasonal_index"),
        )
        # greatest index first, ties to the first category name
        first = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(descending("avg_seasonal_index"))], "category")
        season = cat.groupBy("seasonality").agg(
            F.sum("units").alias("total_units_sold"),
            F.round(F.sum("revenue"), 2).alias("total_revenue_usd"),
            mean(F.sum("paces"), F.sum("n")).alias("avg_sales"),
            F.sum("days").alias("total_days"),
            F.sum("places").alias("category_location_count"),
            F.sum("high").alias("high_impact_count"),
            F.sum("normal").alias("normal_impact_count"),
            F.sum("low").alias("low_impact_count"),
            F.sum("n").alias("total_combinations"),
            F.min_by(F.struct("category", "avg_seasonal_index"), first).alias("top"),
        )
        # one row per season
        overall = F.avg("avg_sales").over(Window.partitionBy())
        season = season.withColumn("rel", ratio("avg_sales", overall))  # null when nothing was sold
        rel, edge = F.col("rel"), rnd("rel", 10)
        return season.select(
            "seasonality",
            "total_units_sold",
            "total_revenue_usd",
            rnd("avg_sales", 2).alias("avg_daily_sales"),
            "total_days",
            "category_location_count",
            "high_impact_count",
            "normal_impact_count",
            "low_impact_count",
            rnd(ratio("high_impact_count", "total_combinations") * 100, 2).alias("high_impact_pct"),
            rnd(rel * 100, 2).alias("seasonal_index"),
            band(
                [(edge >= p.high_impact_ratio, "HIGH_SEASON"), (edge >= p.normal_impact_ratio, "NORMAL_SEASON")],
                "LOW_SEASON",
            ).alias("season_classification"),
            F.col("top.category").alias("highest_impact_category"),
            rnd(F.col("top.avg_seasonal_index"), 6).alias("highest_impact_index"),
        )

    return wh.memo(("seasonality_summary", p), build)


# ---------------------------------------------------------------- Q10
RISK_CLASSES = ("CRITICAL_RISK", "HIGH_RISK", "MODERATE_RISK"), "LOW_RISK"
RISK_ACTIONS = ("IMMEDIATE_REORDER", "REORDER_SOON", "MONITOR_CLOSELY"), "STANDARD_REVIEW"


def risk_scores(level, reorder_point, revenue_share, movement_type, p: Params = DEFAULT) -> dict:
    """The three stockout risk factors of one SKU: stock against the reorder point, revenue share, movement."""
    cov = ratio(level, greatest_strict(reorder_point, F.lit(1).cast("bigint")))
    covered = [(cov <= edge, score) for edge, score in p.coverage_scores]
    return {
        "inventory_risk_score": band([(level == 0, p.zero_stock_score), *covered], p.covered_score),
        "revenue_impact_score": band([(revenue_share >= edge, s) for edge, s in p.share_scores], p.small_share_score),
        "demand_volatility_score": band([(movement_type == m, s) for m, s in p.movement_scores], p.non_mover_score),
    }


def weighted_score(scores, weights) -> Column:
    """Sum of integer scores times decimal weights (given as text), exact."""
    parts = [s.cast("decimal(10,0)") * F.lit(Decimal(w)) for s, w in zip(scores, weights, strict=True)]
    return reduce(lambda a, b: a + b, parts)


def risk_rating(inventory_score, revenue_score, volatility_score, p: Params = DEFAULT) -> dict:
    """Weighted composite and its class and action bands."""
    composite = weighted_score([inventory_score, revenue_score, volatility_score], p.risk_weights)

    def banded(labels, rest):
        return band([(composite >= edge, label) for edge, label in zip(p.risk_edges, labels, strict=True)], rest)

    return {
        "composite": composite,
        "risk_classification": banded(*RISK_CLASSES),
        "recommended_action": banded(*RISK_ACTIONS),
    }


def stockout_risk(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    def build():
        df = core.sku_analysis(wh, p).select(
            *SKU, "stock.category", "stock.inventory_level", "reorder.avg_daily_sales", "reorder.reorder_point",
            "reorder.safety_stock", "reorder.days_of_supply", "turnover.inventory_turnover_ratio",
            "turnover.movement_type", "abc.abc_classification", "abc.revenue_percentage",
        )
        scores = risk_scores(
            F.col("inventory_level"), F.col("reorder_point"), F.col("revenue_percentage"), F.col("movement_type"), p
        )
        scored = df.filter(F.col("avg_daily_sales") > 0).select("*", *[c.alias(k) for k, c in scores.items()])
        rating = risk_rating(
            F.col("inventory_risk_score"), F.col("revenue_impact_score"), F.col("demand_volatility_score"), p
        )
        composite, risk, action = rating["composite"], rating["risk_classification"], rating["recommended_action"]
        return scored.select(
            *SKU,
            "category",
            "inventory_level",
            F.round("avg_daily_sales", 2).alias("avg_daily_sales"),
            "reorder_point",
            "safety_stock",
            greatest_strict(F.lit(1).cast("bigint"), F.col("days_of_supply")).alias("days_of_supply"),
            F.round("inventory_turnover_ratio", 2).alias("inventory_turnover_ratio"),
            "movement_type",
            "abc_classification",
            F.round("revenue_percentage", 2).alias("revenue_percentage"),
            F.round(composite, 0).cast("bigint").alias("stockout_risk_score"),
            risk.alias("risk_classification"),
            "inventory_risk_score",
            "revenue_impact_score",
            "demand_volatility_score",
            action.alias("recommended_action"),
        )

    return wh.memo(("stockout_risk", p), build)
