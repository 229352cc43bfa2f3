"""Unit tests on hand-built rows: band edges, load rules, rounding, ranks, formulas."""

import datetime as dt
import math
import random
import statistics
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.functions.expr import greatest_strict, rnd
from shelfwise.operators import etl, quality
from shelfwise.operators.windowing import PARTS, cut_groups, descending, group_rank, ntile_from_rank, ntile_in_group
from shelfwise.plans import core, dashboards
from shelfwise.sources import warehouse


def staging_row(date, store, product, category, region, level, sold, price="10.00", discount="0.00",
                weather="Sunny", season="Winter"):
    return (
        date, store, product, category, region, level, sold, 0, Decimal("1.00"), Decimal(price),
        Decimal(discount), weather, "None", Decimal("1.00"), season,
    )


def wh_of(spark, rows):
    return warehouse.load(spark, spark.createDataFrame(rows, schemas.STAGING))


def test_stock_status_edges(spark):
    levels = [0, 10, 11, 50, 51, 200, 201]
    rows = [staging_row("2023-12-31", "S1", f"P{lv}", "Toys", "East", lv, 1) for lv in levels]
    got = {r.product_id: r.stock_status for r in core.current_stock_levels(wh_of(spark, rows)).collect()}
    assert got == {
        "P0": "CRITICAL", "P10": "CRITICAL", "P11": "LOW", "P50": "LOW",
        "P51": "NORMAL", "P200": "NORMAL", "P201": "HIGH",
    }


def test_latest_row_is_per_sku_over_all_history(spark):
    rows = [
        staging_row("2023-01-01", "S1", "P1", "Toys", "East", 5, 1),
        staging_row("2023-06-01", "S1", "P1", "Toys", "East", 99, 1),
        staging_row("2023-03-01", "S1", "P1", "Toys", "West", 7, 1),
    ]
    got = {(r.region, r.inventory_level) for r in core.current_stock_levels(wh_of(spark, rows)).collect()}
    assert got == {("East", 99), ("West", 7)}


def test_insert_ignore_keeps_first_and_collapses_heavy_copies(spark):
    n = 20000
    df = spark.range(n).select(
        F.lit("k").alias("key"), F.col("id").alias("ord"), (F.col("id") * 3).alias("payload")
    ).union(spark.createDataFrame([("other", 5, 1)], "key string, ord long, payload long"))
    out = {r.key: r.payload for r in etl.insert_ignore(df, ["key"], ["ord"]).collect()}
    assert out == {"k": 0, "other": 1}


def test_load_rules(spark):
    rows = [
        staging_row("2022-1-5", "S1", "P1", "Toys", "East", 1, 2),
        staging_row("2022-01-05", "S1", "P1", "Toys", "East", 9, 9),  # same key, later: ignored
        staging_row("not a date", "S1", "P1", "Toys", "East", 1, 1),  # dropped
        staging_row("2022-13-01", "S1", "P1", "Toys", "East", 1, 1),  # dropped
        staging_row("2022-01-06", "S1", "P2", "Toys", "East", 1, 1),
        staging_row("2022-01-06", "S1", "P2", "Clothing", "East", 1, 1),  # second category
    ]
    wh = wh_of(spark, rows)
    fact = wh.fact.orderBy("date", "product_id").collect()
    assert [(r.date, r.product_id, r.inventory_level) for r in fact] == [
        (dt.date(2022, 1, 5), "P1", 1),
        (dt.date(2022, 1, 6), "P2", 1),
    ]
    prods = {r.product_id: (r.category, r.product_name) for r in wh.products.collect()}
    assert prods["P2"] == ("Clothing", "Clothing Product P2")
    stores = wh.stores.collect()
    assert [(s.store_name, s.store_type) for s in stores] == [("Store S1 - East", "Retail")]


def test_null_measures_default_to_zero(spark):
    row = list(staging_row("2022-01-05", "S1", "P1", "Toys", "East", 1, 2))
    row[5], row[6], row[9] = None, None, None
    fact = wh_of(spark, [tuple(row)]).fact.collect()[0]
    assert (fact.inventory_level, fact.units_sold, fact.price) == (0, 0, Decimal("0.00"))


def test_greatest_is_null_strict(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, 1.0)], "a double, b double")
    got = [r.g for r in df.select(greatest_strict(F.col("a"), F.col("b")).alias("g")).collect()]
    assert got == [None, 2.0]


def test_rounding_is_half_up_on_printed_value(spark):
    vals = [2.675, 1.005, 0.285, 2.5, 0.125]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [float(r.r) for r in df.select(rnd("x", 2).alias("r")).collect()]
    assert got == [2.68, 1.01, 0.29, 2.5, 0.13]


def test_ntile_from_rank_matches_ntile(spark):
    rows = [(g, i) for g in range(1, 14) for i in range(g)]
    df = spark.createDataFrame(rows, "g int, i int")
    w = Window.partitionBy("g").orderBy("i")
    out = df.select(
        F.ntile(4).over(w).alias("a"),
        ntile_from_rank(F.row_number().over(w), F.count(F.lit(1)).over(Window.partitionBy("g")), 4).alias("b"),
    )
    assert out.filter("a <> b").count() == 0


def _ntile_by_window(df):
    w = Window.partitionBy("grp").orderBy(F.col("v").desc(), F.col("k"))
    return df.withColumn("t", F.ntile(4).over(w))


def test_distributed_rank_matches_window(spark):
    rnd_ = random.Random(7)
    rows = [(rnd_.choice("ABC"), rnd_.randint(0, 30) / 10.0, f"k{i:05d}") for i in range(3000)]
    rows += [("D", 1.0, "only")]
    df = spark.createDataFrame(rows, "grp string, v double, k string")
    order = [*descending("v"), F.col("k")]
    a = ntile_in_group(df, ["grp"], order, "t")
    assert sorted(a.collect()) == sorted(_ntile_by_window(df).collect())
    ranks = group_rank(df, ["grp"], order).filter("grp = 'D'").collect()
    assert [(r._rank, r._size) for r in ranks] == [(1, 1)]


def test_hot_group_of_equal_values_is_cut(spark):
    """A third of all rows in one group, all with one value: still many parts."""
    df = spark.range(9000).select(
        F.when(F.col("id") < 3000, "HOT").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("grp"),
        F.when(F.col("id") % 2 == 0, F.lit(1.5)).alias("v"),
        F.format_string("k%05d", "id").alias("k"),
    ).withColumn("v", F.when(F.col("grp") == "HOT", F.lit(0.0)).otherwise(F.col("v")))
    order = [*descending("v"), F.col("k")]
    parts = cut_groups(df, ["grp"], order).filter("grp = 'HOT'").groupBy("_part").count().collect()
    assert len(parts) > PARTS * 3 // 4 and max(r["count"] for r in parts) < 3000 / 4
    assert sorted(ntile_in_group(df, ["grp"], order, "t").collect(), key=repr) == sorted(
        _ntile_by_window(df).collect(), key=repr
    )


def test_ranks_build_without_jobs_and_never_window_a_whole_group(spark):
    lazy = warehouse.from_tpch(spark, "/root/testdata/sf0.001", materialized=False)
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        views = [core.inventory_turnover(lazy), core.reorder_analysis(lazy), core.abc_classification(lazy)]
        plans = [v._jdf.queryExecution().optimizedPlan().toString() for v in views]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    for line in "\n".join(plans).splitlines():
        if " Window [" in line and " _order#" in line.replace("(", " "):
            assert "_part" in line.split("windowspecdefinition(")[1].split("_order#")[0], line



def _reorder_fixture(spark):
    rnd_ = random.Random(3)
    rows, latest = [], dt.date(2023, 12, 31)
    expected = {}
    for p in range(6):
        units = []
        n_days = 25 + p * 3  # 25, 28, 31, 34, 37, 40 observed rows
        days = [0] + sorted(rnd_.sample(range(1, 91), n_days - 1))
        for d in days:
            u = rnd_.randint(0, 40)
            units.append(u)
            day = latest - dt.timedelta(days=d)
            rows.append(staging_row(day.isoformat(), "S1", f"P{p}", "Toys", "East", rnd_.randint(0, 300), u))
        # a row outside the 91-date window must not count
        rows.append(staging_row((latest - dt.timedelta(days=91)).isoformat(), "S1", f"P{p}", "Toys", "East", 1, 1000))
        expected[f"P{p}"] = units
    return rows, expected, latest


def _half_up(x, nd=0):
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-nd), rounding="ROUND_HALF_UP"))


def test_reorder_formulas_brute_force(spark):
    rows, units_by_p, latest = _reorder_fixture(spark)
    wh = wh_of(spark, rows)
    got = {r.product_id: r for r in core.reorder_analysis(wh).collect()}
    levels = {r.product_id: r.inventory_level for r in core.current_stock_levels(wh).collect()}
    assert set(got) == {p for p, u in units_by_p.items() if len(u) >= 30}
    for p, r in got.items():
        u = units_by_p[p]
        avg, sd = statistics.fmean(u), statistics.pstdev(u)
        term = 1.65 * sd * math.sqrt(7)
        ss = _half_up(term)
        rp = _half_up(avg * 7 + term)
        lvl = levels[p]
        assert r.safety_stock == ss and r.reorder_point == rp
        assert r.days_of_supply == _half_up(lvl / max(avg, 0.1))
        assert r.suggested_order_qty == max(0, rp + ss - lvl)
        assert float(r.coverage_ratio) == _half_up(lvl / max(rp, 1), 2)
        assert float(r.avg_daily_sales) == _half_up(avg, 2)


def test_pareto_edges(spark):
    def rows_for(region, revenues):
        return [
            staging_row("2023-12-31", "S1", f"P{i}", "Toys", region, 1, rev, price="1.00")
            for i, rev in enumerate(revenues)
        ]

    rows = rows_for("East", [80, 15, 5]) + rows_for("West", [81, 19])
    got = {(r.region, r.product_id): r.abc_classification for r in core.abc_classification(wh_of(spark, rows)).collect()}
    assert got == {
        ("East", "P0"): "A", ("East", "P1"): "B", ("East", "P2"): "C",
        ("West", "P0"): "B", ("West", "P1"): "C",
    }


def test_seasonal_band_edges_and_null_weather(spark):
    rows = [
        staging_row("2023-12-30", "S1", "P1", "Toys", "East", 1, 12, weather="Sunny", season="Winter"),
        staging_row("2023-12-31", "S1", "P1", "Toys", "East", 1, 8, weather=None, season="Winter"),
        staging_row("2023-12-29", "S1", "P1", "Toys", "East", 1, 8, weather=None, season=None),  # excluded
    ]
    got = {r.weather_condition: r for r in core.seasonal_analysis(wh_of(spark, rows)).collect()}
    assert got["Sunny"].impact_classification == "HIGH_IMPACT"
    assert got[None].impact_classification == "NORMAL_IMPACT"
    assert float(got["Sunny"].seasonal_index) == 120.0 and float(got[None].seasonal_index) == 80.0


def test_one_day_location_gives_null_daily_rates(spark):
    rows = [staging_row("2023-12-31", "S1", "P1", "Toys", "East", 5, 3)]
    wh = wh_of(spark, rows)
    st = dashboards.store_performance(wh).collect()[0]
    assert st.avg_daily_sales is None and st.avg_daily_revenue_usd is None
    cat = dashboards.category_performance(wh).collect()[0]
    assert cat.days_of_supply is None and cat.avg_daily_sales is None


def test_zero_inventory_and_zero_sales(spark):
    rows = [staging_row("2023-12-31", "S1", "P1", "Toys", "East", 0, 0)]
    wh = wh_of(spark, rows)
    t = core.inventory_turnover(wh).collect()[0]
    assert float(t.inventory_turnover_ratio) == 0.0 and t.days_of_supply == 999
    q = {r.metric: r.value for r in quality.quality_report(wh.fact, wh.products).collect()}
    assert q["Records with Zero Sales and Inventory"] == 1 and q["Total Records"] == 1


def test_nullif_one_can_be_read_as_zero_guard(spark):
    from shelfwise.functions.params import Params

    rows = [staging_row("2023-12-31", "S1", "P1", "Toys", "East", 5, 3)]
    wh = wh_of(spark, rows)
    st = dashboards.store_performance(wh, Params(reference_nullif_one=False)).collect()[0]
    assert float(st.avg_daily_sales) == 3.0


def test_distinct_days_bitmap_equals_count_distinct(spark):
    from shelfwise.functions.expr import distinct_days

    start = dt.date(2023, 1, 1)
    rnd_ = random.Random(5)
    offsets = [0, 63, 64, 127, 128, 365, 366] + [rnd_.randint(0, 366) for _ in range(400)]
    rows = [(g, start + dt.timedelta(days=o)) for i, o in enumerate(offsets) for g in (["a", "b"] if i % 3 else ["a"])]
    df = spark.createDataFrame(rows, "g string, d date").withColumn("off", F.datediff("d", F.lit(start)))
    got = df.groupBy("g").agg(distinct_days("off", 367).alias("bits"), F.count_distinct("d").alias("exact"))
    assert got.filter("bits <> exact").count() == 0 and got.count() == 2


def test_distributed_rank_on_sampled_ranges(spark):
    # enough rows that range partitioning samples instead of seeing every row
    df = spark.range(60000).select(
        (F.col("id") % 3).cast("string").alias("grp"),
        ((F.col("id") * 7919) % 1000 / 10.0).alias("v"),
        F.col("id").alias("k"),
    ).repartition(8)
    a, b = ntile_in_group(df, ["grp"], [*descending("v"), F.col("k")], "t"), _ntile_by_window(df)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_reorder_needs_30_observed_rows(spark):
    latest = dt.date(2023, 12, 31)
    rows = []
    for p, n in (("P29", 29), ("P30", 30)):
        for d in range(n):
            rows.append(staging_row((latest - dt.timedelta(days=3 * d)).isoformat(), "S1", p, "Toys", "East", 50, 5 + d % 3))
    got = {r.product_id for r in core.reorder_analysis(wh_of(spark, rows)).collect()}
    assert got == {"P30"}


def test_twelve_month_window_from_feb_29(spark):
    rows = [
        staging_row("2024-02-29", "S1", "P1", "Toys", "East", 1, 1, season="Winter"),
        staging_row("2023-02-28", "S1", "P1", "Toys", "East", 1, 1, season="Winter"),  # first day inside
        staging_row("2023-02-27", "S1", "P1", "Toys", "East", 1, 100, season="Winter"),  # outside
    ]
    got = core.seasonal_analysis(wh_of(spark, rows)).collect()
    assert len(got) == 1 and got[0].days_count == 2 and got[0].total_units_sold == 2
