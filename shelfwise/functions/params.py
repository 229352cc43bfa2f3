"""Tunable constants of the analyses.

Every threshold the reference hard-codes in its views is a field here, with
the reference value as the default, so a caller can re-run an analysis with
other policy values without touching the plans.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # --- fixed values (must equal the reference for equal results) -------
    # stock status bands on inventory_level: <=10 CRITICAL, <=50 LOW,
    # <=200 NORMAL, else HIGH
    critical_level: int = 10
    low_level: int = 50
    normal_level: int = 200
    # trailing windows, inclusive at both ends (so n + 1 calendar dates)
    sales_window_days: int = 90
    abc_window_days: int = 180
    kpi_window_days: int = 7
    seasonal_window_months: int = 12
    # reorder policy: lead time 7 days, z = 1.65 (95 % service level),
    # stddev fallback 0.3 * mean, at least 30 observed rows
    lead_time_days: int = 7
    service_z: float = 1.65
    fallback_cv: float = 0.3
    min_observations: int = 30
    # floors used in divisions
    min_daily_sales: float = 0.1
    # turnover annualisation: units * 365.0 / 90.0 / avg level
    days_per_year: float = 365.0
    turnover_period_days: float = 90.0
    # days_of_supply when nothing sold
    no_sales_days_of_supply: int = 999
    # ABC cut-offs on the cumulative revenue share (inclusive)
    abc_a_cutoff: int = 80
    abc_b_cutoff: int = 95
    # seasonal impact bands on avg / baseline
    high_impact_ratio: float = 1.2
    normal_impact_ratio: float = 0.8
    # executive status: turnover >= 4 and critical share < 0.05 GOOD,
    # turnover >= 2 and critical share < 0.10 AVERAGE
    good_turnover: int = 4
    good_critical_share: float = 0.05
    average_turnover: int = 2
    average_critical_share: float = 0.10
    # store/category rating on avg turnover: >=6, >=4, >=2
    excellent_turnover: int = 6
    # stockout risk: zero stock, coverage bands (edge, score), else the last
    zero_stock_score: int = 100
    coverage_scores: tuple = ((0.10, 90), (0.25, 70), (0.50, 40))
    covered_score: int = 10
    # revenue share bands, movement scores, and what is left
    share_scores: tuple = ((90, 100), (50, 60))
    small_share_score: int = 20
    movement_scores: tuple = (("FAST_MOVER", 80), ("MEDIUM_MOVER", 50), ("SLOW_MOVER", 20))
    non_mover_score: int = 10
    # weights of the three scores, and the classes of their weighted sum
    risk_weights: tuple = ("0.4", "0.4", "0.2")
    risk_edges: tuple = (90, 70, 50)
    kpi_service_level: float = 95.0
    # the reference divides by NULLIF(x, 1) (daily rates, ROI): a group with
    # exactly one day of data, or an inventory value of exactly 1, gives NULL.
    # False reads it as the usual NULLIF(x, 0) guard instead.
    reference_nullif_one: bool = True

    # --- execution choice (same results either way) ----------------------
    # one per-SKU aggregate over the longest trailing window, with
    # conditional sums for the shorter one (pays when a query needs both)
    fused_sku_stats: bool = False
    # read the SKU-grain tables written with the fact (latest row per SKU,
    # window statistics) instead of recomputing them from the fact
    read_snapshots: bool = True


DEFAULT = Params()
