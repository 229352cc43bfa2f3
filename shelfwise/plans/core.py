"""The five core analyses: stock status, reorder points, turnover, ABC, seasonality.

Each function takes a ``Warehouse`` and ``Params`` and returns a DataFrame
whose money and rate columns are exact, rounded decimals; consumers that want
doubles call ``expr.decimals_to_double`` at the very end.  Nothing here
sorts: presentation order lives in ``plans.present``.

Scale notes
-----------
* Every per-SKU aggregate is a hash aggregate with map-side partial
  aggregation; the shuffle carries one row per SKU and map task.
* Trailing windows are filters on the partitioned fact against the latest
  date (a literal recorded when the fact was written; a scalar subquery on
  a lazy fact), so only the needed months are read.
* On a written warehouse the latest row per SKU and the per-SKU window
  statistics are read from the SKU-grain tables written with the fact.
* Products are joined at product or SKU grain, never at row grain; the
  planner broadcasts the dimension when its file size allows it.
* Ranks and running sums inside a category or a location are computed over
  parts of it, so no group is one task's work: once per written version, over ranges of a sorted
  table (``windowing.range_parts``), and stored in ``sku_analysis``, which every later reader
  projects; for other policy values or a lazy warehouse lazily (``windowing.cut_groups``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.expr import (
    band,
    bitmap_count,
    day_bitmaps,
    merge_bitmaps,
    greatest_strict,
    label_of,
    mean,
    net,
    ratio,
    rnd,
    rnd_int,
)
from ..functions.params import DEFAULT, Params
from ..operators import sku_stats
from ..operators.windowing import (
    cut_groups,
    descending,
    latest_per_key,
    ntile_in_group,
    pareto_class,
    part_offsets,
    range_parts,
    share_of_total,
    within_part,
)
from ..sources.warehouse import Warehouse

SKU = list(schemas.SKU)
LOC = list(schemas.LOCATION)

# fixed labels
STOCK_STATUS = ("CRITICAL", "LOW", "NORMAL", "HIGH")
ALERT_LEVEL = {1: "CRITICAL", 2: "LOW", 3: "MODERATE"}, "ADEQUATE"
MOVEMENT_TYPE = {1: "FAST_MOVER", 2: "MEDIUM_MOVER", 3: "SLOW_MOVER"}, "NON_MOVER"
PERFORMANCE = {1: "EXCELLENT", 2: "GOOD", 3: "AVERAGE"}, "NEEDS_IMPROVEMENT"
ABC_CLASSES = ("A", "B", "C")
ABC_STRATEGIES = ("TIGHT_CONTROL", "MODERATE_CONTROL", "BASIC_CONTROL")


def categories(wh: Warehouse) -> DataFrame:
    return wh.products.select("product_id", "category")


# the policy values that the stored analysis depends on
ANALYSIS_PARAMS = (
    "critical_level", "low_level", "normal_level", "sales_window_days", "abc_window_days", "lead_time_days", "service_z",
    "fallback_cv", "min_observations", "min_daily_sales", "days_per_year", "turnover_period_days",
    "no_sales_days_of_supply", "abc_a_cutoff", "abc_b_cutoff",
)


def stored_analysis(wh: Warehouse, p: Params) -> bool:
    """Whether the table written with the version answers for these policy values."""
    same = all(getattr(p, f) == getattr(DEFAULT, f) for f in ANALYSIS_PARAMS)
    return p.read_snapshots and same and wh.analysis is not None


def _stored(wh: Warehouse, p: Params, view: str) -> DataFrame | None:
    """One view out of the stored analysis: only its columns are read."""
    if not stored_analysis(wh, p):
        return None
    return wh.analysis.filter(F.col(view).isNotNull()).select(*SKU, f"{view}.*")


def sku_analysis(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    """Per SKU the columns of its stock, reorder, turnover and abc rows, as structs (null where it has none).

    Every SKU of the other three has a stock row, so the joins from stock lose nothing.
    """
    if stored_analysis(wh, p):
        return wh.analysis

    def build():
        views = {"stock": current_stock_levels, "reorder": reorder_analysis, "turnover": inventory_turnover,
                 "abc": abc_classification}
        out = None
        for name, view in views.items():
            rows = view(wh, p)
            packed = rows.select(*SKU, F.struct(*[c for c in rows.columns if c not in SKU]).alias(name))
            out = packed if out is None else out.join(packed, SKU, "left")
        return out

    return wh.memo(("sku_analysis", p), build)


def _parts(wh: Warehouse, name: str) -> Callable[..., DataFrame]:
    """How a rank cuts its groups: written ranges while a version is being written, else lazily."""
    return partial(range_parts, path=f"{wh.rank_folder}/{name}") if wh.rank_folder else cut_groups


def _units() -> F.Column:
    return F.col("units_sold").cast("bigint")


# ---------------------------------------------------------------- Q1
LATEST_COLS = [*SKU, "date", "inventory_level", "price", "discount", "seasonality", "weather_condition"]


def latest_rows(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    """Latest fact row of every SKU.

    A written warehouse keeps this as a SKU-grain table produced with the
    fact (``sku_latest``), so readers do not rescan the whole history; a lazy
    warehouse computes it (partial top-1 per map task, then final top-1).
    """
    if p.read_snapshots and wh.sku_latest is not None:
        return wh.sku_latest.select(*LATEST_COLS)
    return latest_per_key(wh.fact.select(*LATEST_COLS), SKU, "date")


def current_stock_levels(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    """Latest row of every SKU over the whole history, with a stock band."""

    def build():
        if (stored := _stored(wh, p, "stock")) is not None:
            return stored
        df = latest_rows(wh, p).join(categories(wh), "product_id")
        lvl = F.col("inventory_level")
        status = band(
            [
                (lvl <= p.critical_level, STOCK_STATUS[0]),
                (lvl <= p.low_level, STOCK_STATUS[1]),
                (lvl <= p.normal_level, STOCK_STATUS[2]),
            ],
            STOCK_STATUS[3],
        )
        return df.select(
            *SKU,
            "category",
            "inventory_level",
            F.round("price", 2).alias("price"),
            F.round("discount", 2).alias("discount_pct"),
            F.round(net("inventory_level"), 2).alias("inventory_value"),
            status.alias("stock_status"),
            "seasonality",
            "weather_condition",
        )

    return wh.memo(("current_stock_levels", p), build)


# ---------------------------------------------------------------- Q2
def stats_windows(p: Params) -> tuple[int, int, int]:
    return p.sales_window_days, p.abc_window_days, p.kpi_window_days


def sku_window_stats(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    """Per-SKU sums over the sales window and the ABC window (one aggregate).

    Read from the table written with the fact when it was computed for the
    same windows; otherwise one scan of the longest window and one shuffle.
    A SKU without rows in a window has a zero count there and is dropped by
    the readers below.
    """

    def build():
        windows = stats_windows(p)
        if p.read_snapshots and wh.sku_stats is not None and wh.sku_stats_windows == windows:
            return wh.sku_stats
        rows = wh.trailing_days(max(windows))
        return sku_stats.window_stats(rows, wh.latest_date(), windows)

    return wh.memo(("sku_window_stats", p), build)


SALES_STATS_COLS = sku_stats.SALES_COLS


def _use_window_stats(wh: Warehouse, p: Params) -> bool:
    return p.fused_sku_stats or (p.read_snapshots and wh.sku_stats is not None)


def sales_stats(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    """Per SKU over the trailing sales window, every sum that the reorder and
    turnover analyses need.  Read from the written window statistics when
    present; otherwise one aggregate over the fact (Catalyst prunes each
    consumer's copy to the columns it uses, so two consumers in one plan
    scan twice: the written table is what shares the work)."""

    def build():
        if _use_window_stats(wh, p):
            return sku_window_stats(wh, p).filter(F.col("n") > 0).select(*SKU, *SALES_STATS_COLS)
        u = _units()
        return (
            wh.trailing_days(p.sales_window_days)
            .groupBy(*SKU)
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(u).alias("s1"),
                F.sum(u * u).alias("s2"),
                F.sum(F.col("inventory_level").cast("bigint")).alias("s_level"),
                F.sum("price").alias("s_price"),
                F.sum(net("units_sold")).alias("s_net_units"),
                F.sum(net("inventory_level")).alias("s_net_level"),
            )
        )

    return wh.memo(("sales_stats", p), build)


def abc_stats(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    """Per SKU over the trailing ABC window: rows, revenue, units, net price, level."""

    def build():
        if _use_window_stats(wh, p):
            f = sku_window_stats(wh, p).filter(F.col("abc_n") > 0)
            return f.select(
                *SKU,
                F.col("abc_n").alias("n"),
                F.col("abc_rev").alias("rev"),
                F.col("abc_units").alias("total_units_sold"),
                F.col("abc_net_price").alias("s_net_price"),
                F.col("abc_level").alias("s_level"),
            )
        return (
            wh.trailing_days(p.abc_window_days)
            .groupBy(*SKU)
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(net("units_sold")).alias("rev"),
                F.sum(_units()).alias("total_units_sold"),
                F.sum(net(F.lit(1))).alias("s_net_price"),
                F.sum(F.col("inventory_level").cast("bigint")).alias("s_level"),
            )
        )

    return wh.memo(("abc_stats", p), build)


def reorder_policy(avg, sd, p: Params = DEFAULT) -> dict:
    """Safety stock and reorder point from mean and standard deviation of
    daily sales (95 % service level, 7-day lead time by default).  The
    reorder point uses the unrounded safety term."""
    sigma = F.coalesce(sd, avg * F.lit(p.fallback_cv))
    safety_term = F.lit(p.service_z) * sigma * F.sqrt(F.lit(float(p.lead_time_days)))
    return {
        "safety_stock": greatest_strict(F.lit(0).cast("bigint"), rnd_int(safety_term)),
        "reorder_point": rnd_int(avg * p.lead_time_days + greatest_strict(F.lit(0.0), safety_term)),
    }


def coverage(level, avg, reorder_point, safety_stock, p: Params = DEFAULT) -> dict:
    """Days of supply, suggested order and coverage of the reorder point."""
    return {
        "days_of_supply": rnd_int(level / greatest_strict(avg, F.lit(p.min_daily_sales))),
        "suggested_order_qty": greatest_strict(F.lit(0).cast("bigint"), (reorder_point + safety_stock) - level),
        "coverage_ratio": ratio(level, greatest_strict(reorder_point, F.lit(1).cast("bigint"))),
    }


def reorder_analysis(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    """Safety stock, reorder point and a relative alert level per SKU."""

    def build():
        if (stored := _stored(wh, p, "reorder")) is not None:
            return stored
        n, s1, s2 = F.col("n"), F.col("s1"), F.col("s2")
        stats = sales_stats(wh, p).filter(n >= p.min_observations)
        avg = mean(s1, n)
        # population standard deviation from exact integer sums
        sd = F.sqrt((n * s2 - s1 * s1).cast("double")) / n
        stats = stats.select(*SKU, avg.alias("avg"), sd.alias("sd"))
        terms = reorder_policy(F.col("avg"), F.col("sd"), p)
        calc = stats.select(*SKU, "avg", "sd", *[c.alias(k) for k, c in terms.items()])
        stock = current_stock_levels(wh, p).select(*SKU, "category", "inventory_level")
        cover = coverage(F.col("inventory_level"), F.col("avg"), F.col("reorder_point"), F.col("safety_stock"), p)
        cov = stock.join(calc, SKU).select(
            *SKU,
            "category",
            "inventory_level",
            "avg",
            "sd",
            "safety_stock",
            "reorder_point",
            *[c.alias(k) for k, c in cover.items()],
        )
        ranked = ntile_in_group(
            cov,
            ["category"],
            [F.col("coverage_ratio"), *[F.col(c) for c in SKU]],
            "quartile_rank",
            parts=_parts(wh, "reorder"),
        )
        labels, default = ALERT_LEVEL
        return ranked.select(
            *SKU,
            "category",
            F.col("inventory_level").alias("current_stock"),
            rnd("avg", 2).alias("avg_daily_sales"),
            rnd("sd", 2).alias("std_dev_sales"),
            F.lit(p.lead_time_days).alias("lead_time_days"),
            "safety_stock",
            "reorder_point",
            "days_of_supply",
            "suggested_order_qty",
            rnd("coverage_ratio", 2).alias("coverage_ratio"),
            label_of("quartile_rank", labels, default).alias("alert_level"),
        )

    return wh.memo(("reorder_analysis", p), build)


# ---------------------------------------------------------------- Q3
def inventory_turnover(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    """Annualised turnover and movement quartiles per SKU (trailing window)."""

    def build():
        if (stored := _stored(wh, p, "turnover")) is not None:
            return stored
        agg = sales_stats(wh, p).withColumnRenamed("s1", "s_units").join(categories(wh), "product_id")
        n = F.col("n")
        avg_sales, avg_level = mean("s_units", n), mean("s_level", n)
        annual = F.col("s_units").cast("double") * F.lit(p.days_per_year) / F.lit(p.turnover_period_days)
        turnover = F.when(avg_level > 0, rnd(annual / avg_level, 2)).otherwise(F.lit(0))
        dos = F.when(avg_sales > 0, rnd_int(avg_level / avg_sales)).otherwise(F.lit(p.no_sales_days_of_supply))
        enriched = agg.select(
            *SKU,
            "category",
            rnd(avg_level, 0).alias("avg_inventory_level"),
            rnd(avg_sales, 2).alias("avg_daily_sales"),
            F.round("s_net_units", 2).alias("cogs_90_days"),
            rnd(mean("s_net_level", n), 2).alias("avg_inventory_value"),
            turnover.alias("inventory_turnover_ratio"),
            dos.cast("bigint").alias("days_of_supply"),
            rnd(mean("s_price", n), 2).alias("avg_unit_price"),
        )
        ranked = ntile_in_group(
            enriched,
            ["category"],
            [*descending("inventory_turnover_ratio"), *[F.col(c) for c in SKU]],
            "quartile_rank",
            parts=_parts(wh, "turnover"),
        )
        mv, mv_default = MOVEMENT_TYPE
        pf, pf_default = PERFORMANCE
        return ranked.select(
            *[c for c in enriched.columns],
            label_of("quartile_rank", mv, mv_default).alias("movement_type"),
            label_of("quartile_rank", pf, pf_default).alias("performance_rating"),
        )

    return wh.memo(("inventory_turnover", p), build)


# ---------------------------------------------------------------- Q4
def abc_classification(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    """Pareto classes of products inside each store location (trailing 180 days).

    A location may hold the whole catalogue, so ranks and running shares are
    taken over parts of its revenue order and the earlier parts are added.
    """

    def build():
        if (stored := _stored(wh, p, "abc")) is not None:
            return stored
        agg = abc_stats(wh, p).join(categories(wh), "product_id")
        cut = _parts(wh, "abc")
        parts = cut(agg, LOC, [*descending("rev"), F.col("product_id")], _location_rev=F.sum("rev"))
        shared = parts.withColumn("revenue_percentage", share_of_total("rev", "_location_rev"))
        before = part_offsets(shared, LOC, _rows=F.count(F.lit(1)), _share=F.sum("revenue_percentage"))
        ordered = within_part(LOC)
        running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        numbered = shared.select(
            "*",
            F.row_number().over(ordered).alias("_row"),
            F.sum("revenue_percentage").over(running).alias("_part_share"),
        )
        cum = numbered.join(before, [*LOC, "_part"]).select(
            "*",
            (F.col("_rows") + F.col("_row")).cast("int").alias("revenue_rank"),
            (F.col("_share") + F.col("_part_share")).alias("cum"),
        )
        cuts = (p.abc_a_cutoff, p.abc_b_cutoff)
        abc = pareto_class("cum", cuts, ABC_CLASSES)
        strategy = pareto_class("cum", cuts, ABC_STRATEGIES)
        return cum.select(
            *SKU,
            "category",
            F.round("rev", 2).alias("total_revenue"),
            "revenue_percentage",
            F.round("cum", 2).alias("cumulative_percentage"),
            "revenue_rank",
            abc.alias("abc_classification"),
            strategy.alias("management_strategy"),
            "total_units_sold",
            rnd(mean("s_net_price", "n"), 2).alias("avg_selling_price"),
            rnd(mean("s_level", "n"), 0).alias("avg_inventory_level"),
        )

    return wh.memo(("abc_classification", p), build)


# ---------------------------------------------------------------- Q5
SEASONAL_KEY = ["seasonality", "weather_condition", "category", "store_id", "region"]


def seasonal_analysis(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    """Sales by season x weather x category x location against its own baseline."""

    def build():
        latest = wh.latest_date()
        start = F.add_months(latest, -p.seasonal_window_months)
        span = 31 * p.seasonal_window_months + 1  # covers 12 months + 1 day
        rows = (
            wh.between(start, latest)
            .filter(F.col("seasonality").isNotNull())
            .withColumn("_day", F.datediff(F.col("date"), start))
        )
        measures = [
            F.count(F.lit(1)).alias("n"),
            F.sum(_units()).alias("total_units_sold"),
            F.sum(net("units_sold")).alias("rev"),
            F.sum(F.col("inventory_level").cast("bigint")).alias("s_level"),
            *day_bitmaps("_day", span),
        ]
        # per product first, the category joined at that grain, then merged
        # (bitmaps merge by bit_or): no row-grain join with the dimension
        by_product = [k for k in SEASONAL_KEY if k != "category"] + ["product_id"]
        groups = (
            rows.groupBy(*by_product).agg(*measures)
            .join(categories(wh), "product_id")
            .groupBy(*SEASONAL_KEY)
            .agg(
                F.sum("n").alias("n"),
                F.sum("total_units_sold").alias("total_units_sold"),
                F.sum("rev").alias("rev"),
                F.sum("s_level").alias("s_level"),
                *merge_bitmaps(span),
            )
        )
        groups = groups.withColumn("days_count", bitmap_count(span))
        avg_sales = mean("total_units_sold", "n")
        groups = groups.withColumn("avg_sales", avg_sales)
        baseline = F.avg("avg_sales").over(Window.partitionBy("category", "store_id", "region"))
        groups = groups.withColumn("baseline", baseline)
        idx = F.col("avg_sales") / greatest_strict(F.col("baseline"), F.lit(p.min_daily_sales))
        # the mean of doubles depends on their order in the last bit: compare snapped
        edge = rnd(idx, 10)
        impact = band(
            [(edge >= p.high_impact_ratio, "HIGH_IMPACT"), (edge >= p.normal_impact_ratio, "NORMAL_IMPACT")],
            "LOW_IMPACT",
        )
        return groups.select(
            *SEASONAL_KEY,
            "total_units_sold",
            F.round("rev", 2).alias("total_revenue"),
            rnd("avg_sales", 2).alias("avg_daily_sales"),
            rnd(mean("s_level", "n"), 0).alias("avg_inventory_level"),
            "days_count",
            rnd("baseline", 2).alias("category_baseline"),
            rnd(idx * 100, 2).alias("seasonal_index"),
            impact.alias("impact_classification"),
        )

    return wh.memo(("seasonal_analysis", p), build)
