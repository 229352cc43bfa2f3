"""Appends as published states, statistics carried forward, earlier dates, ranks over ranges, counted rejects."""

from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import DataFrameWriter, Window
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.functions.params import DEFAULT
from shelfwise.operators import rejects, sku_months, sku_stats
from shelfwise.operators.windowing import group_rank, range_parts
from shelfwise.plans import registry
from shelfwise.sources import feed, tpch, versions, warehouse

SF = "/root/testdata/sf0.001"
VIEWS = ["current_stock_levels", "abc_classification", "inventory_turnover", "inventory_kpis", "executive_kpi_dashboard",
         "store_performance", "category_performance"]


def state(wh) -> dict:
    """What a reader sees: fact, dimensions, SKU tables and some reports."""
    out = {"version": wh.version, "latest": wh.latest}
    for name in (*VIEWS, "fact_inventory", "dim_stores", "dim_products"):
        out[name] = sorted(map(tuple, registry.QUERIES[name](wh, DEFAULT).collect()), key=repr)
    out["stats"] = sorted(map(tuple, wh.sku_stats.select(*schemas.SKU, *sku_stats.COLUMNS, *sku_stats.block_columns(90)).collect()), key=repr)
    return out


def by_day(spark, *bounds: str):
    """Staging rows of days between consecutive bounds."""
    rows = tpch.staging_from_tpch(spark, SF).cache()
    return [rows.filter(F.col("Date").between(a, b)) for a, b in zip(bounds[::2], bounds[1::2], strict=True)]


@pytest.fixture(scope="module")
def two_loads(spark, tmp_path_factory):
    first, second = by_day(spark, "2022-01-01", "2023-09-30", "2023-09-15", "2023-11-20")
    folder = str(tmp_path_factory.mktemp("loads"))
    wh = warehouse.materialize(warehouse.load(spark, first, order=tpch.LOAD_ORDER), f"{folder}/whole")
    before = state(wh)
    after = state(warehouse.append(wh, second, order=tpch.LOAD_ORDER))
    return first, second, before, after


def test_a_crash_after_any_write_leaves_the_old_state_and_a_replay_gives_the_new(spark, tmp_dir, monkeypatch, two_loads):
    first, second, before, after = two_loads
    wh = warehouse.materialize(warehouse.load(spark, first, order=tpch.LOAD_ORDER), f"{tmp_dir}/w")
    real, real_publish = DataFrameWriter.parquet, versions.publish
    writes = []

    def crash(*args, **kwargs):
        raise RuntimeError("lost driver")

    for k in range(1, 40):
        writes.clear()

        def counted(self, path, *args, k=k, **kwargs):
            real(self, path, *args, **kwargs)
            writes.append(path)
            if len(writes) == k:
                crash()

        with monkeypatch.context() as m:
            m.setattr(DataFrameWriter, "parquet", counted)
            m.setattr(versions, "publish", crash)  # the last step of all
            with pytest.raises(RuntimeError):
                warehouse.append(wh, second, order=tpch.LOAD_ORDER)
        done = len(writes) < k
        # the folders a reader opens are the published ones: compared in full now and then
        opened = warehouse.open_written(spark, f"{tmp_dir}/w")
        assert opened.version == 0 and opened.latest == before["latest"] and opened.published == wh.published
        if done or k in (5, 8):
            assert state(opened) == before
        if done:
            break
    assert done and len(writes) >= 10 and versions.publish is real_publish
    assert state(warehouse.append(wh, second, order=tpch.LOAD_ORDER)) == after


def test_append_equals_one_load(spark, tmp_dir, two_loads):
    first, second, _, after = two_loads
    both = first.withColumn("_b", F.lit(1)).unionByName(second.withColumn("_b", F.lit(2)))
    ref = state(warehouse.materialize(warehouse.load(spark, both, order=["_b", *tpch.LOAD_ORDER]), f"{tmp_dir}/w"))
    assert {k: v for k, v in ref.items() if k != "version"} == {k: v for k, v in after.items() if k != "version"}


def test_second_writer_is_refused(spark, tmp_dir, monkeypatch):
    first, second, third = by_day(spark, "2022-01-01", "2022-12-31", "2023-01-01", "2023-01-10", "2023-01-11", "2023-01-20")
    wh = warehouse.materialize(warehouse.load(spark, first, order=tpch.LOAD_ORDER), f"{tmp_dir}/w")
    real = versions.publish

    def late(spark, location, v):
        monkeypatch.setattr(versions, "publish", real)
        warehouse.append(wh, third, order=tpch.LOAD_ORDER)  # another writer is faster
        real(spark, location, v)

    monkeypatch.setattr(versions, "publish", late)
    with pytest.raises(versions.ConcurrentWriteError):
        warehouse.append(wh, second, order=tpch.LOAD_ORDER)
    now = warehouse.open_written(spark, f"{tmp_dir}/w")
    assert now.version == 1 and now.latest == datetime.date(2023, 1, 20)
    assert now.fact.filter("date between '2023-01-01' and '2023-01-10'").count() == 0
    again = warehouse.append(wh, second, order=tpch.LOAD_ORDER)
    assert again.version == 2 and again.fact.filter("date between '2023-01-01' and '2023-01-10'").count() > 0
    assert os.listdir(f"{tmp_dir}/w/versions") and not [f for f in os.listdir(f"{tmp_dir}/w/versions") if f.startswith("_")]


def test_old_versions_stay_readable_and_compaction_keeps_the_contents(spark, tmp_dir):
    first, second = by_day(spark, "2022-01-01", "2023-05-31", "2023-06-01", "2023-06-20")
    wh = warehouse.materialize(warehouse.load(spark, first, order=tpch.LOAD_ORDER), f"{tmp_dir}/w")
    old = state(wh)
    new = state(warehouse.append(wh, second, order=tpch.LOAD_ORDER))
    small = state(warehouse.compact(wh))
    assert small.pop("version") == 2 and new.pop("version") == 1 and small == new
    assert state(warehouse.open_written(spark, f"{tmp_dir}/w", 0)) == old
    compacted = warehouse.open_written(spark, f"{tmp_dir}/w")
    assert len(compacted.published.holding(warehouse.FACT)) == 1
    day = datetime.date(2023, 4, 10)
    assert sorted(warehouse.as_of(compacted, day).sku_latest.collect()) == sorted(warehouse.as_of(wh, day).sku_latest.collect())


def test_append_of_a_day_reads_the_days_that_leave(spark, tmp_dir, monkeypatch):
    first, second = by_day(spark, "2022-01-01", "2023-06-20", "2023-06-21", "2023-06-21")
    wh = warehouse.materialize(warehouse.load(spark, first, order=tpch.LOAD_ORDER), f"{tmp_dir}/w")
    asked = []
    real = warehouse.Warehouse.between

    def watched(self, start, end):
        asked.append([spark.range(1).select(c).first()[0] for c in (start, end)])
        return real(self, start, end)

    monkeypatch.setattr(warehouse.Warehouse, "between", watched)
    out = warehouse.append(wh, second, order=tpch.LOAD_ORDER)
    one = datetime.timedelta(days=1)
    assert sorted(asked) == [[d, d] for d in (wh.latest - 180 * one, wh.latest - 90 * one, wh.latest - 7 * one)]
    fresh = sku_stats.window_stats(out.trailing_days(180), out.latest_date(), (90, 180, 7))
    assert out.sku_stats.select(*fresh.columns).exceptAll(fresh).count() == 0 == fresh.exceptAll(out.sku_stats.select(*fresh.columns)).count()


@pytest.mark.parametrize("to", ["2023-06-20", "2023-06-25", "2023-08-30", "2023-12-30"])
def test_statistics_slide_over_any_distance(spark, to):
    rows, late = by_day(spark, "2022-01-01", "2023-06-20", "2023-06-01", to)
    fact = warehouse.load(spark, rows, order=tpch.LOAD_ORDER).fact.cache()
    entering = warehouse.load(spark, late, order=tpch.LOAD_ORDER).fact.join(fact, list(schemas.INVENTORY_KEY), "left_anti").cache()
    a, b = (f.agg(F.max("date")).first()[0] for f in (fact, entering))
    b = max(a, b or a)  # the days may all be stored

    def between(start, end):
        return fact.filter(F.col("date").between(start, end))

    stats = sku_stats.window_stats(between(F.lit(a) - F.expr("interval 180 days"), F.lit(a)), F.lit(a), (90, 180, 7))
    moved = sku_stats.slide(stats, between, entering, a, b, (90, 180, 7))
    all_rows = fact.unionByName(entering).filter(F.col("date") >= F.date_sub(F.lit(b), 180))
    fresh = sku_stats.window_stats(all_rows, F.lit(b), (90, 180, 7))
    assert moved.exceptAll(fresh).count() == 0 == fresh.exceptAll(moved).count() and moved.count() > 0


def test_window_cuts():
    d = datetime.date
    assert sku_months.cuts(d(2023, 6, 20), 90) == ((202304, 202305), [(d(2023, 3, 22), d(2023, 3, 31)), (d(2023, 6, 1), d(2023, 6, 20))])
    assert sku_months.cuts(d(2023, 6, 30), 29) == ((202306, 202306), [])
    assert sku_months.cuts(d(2023, 6, 20), 7)[1] == [(d(2023, 6, 13), d(2023, 6, 20))]
    assert sku_months.cuts(d(2023, 7, 3), 7)[1] == [(d(2023, 6, 26), d(2023, 6, 30)), (d(2023, 7, 1), d(2023, 7, 3))]
    for latest in (d(2024, 2, 29) + datetime.timedelta(days=k) for k in range(70)):
        for days in (0, 1, 7, 28, 29, 30, 31, 59, 90, 180):
            (low, high), edges = sku_months.cuts(latest, days)
            covered = {a + datetime.timedelta(days=i) for a, b in edges for i in range((b - a).days + 1)}
            day = latest - datetime.timedelta(days=days)
            while day <= latest:
                assert (low <= day.year * 100 + day.month <= high) != (day in covered), (latest, days, day)
                day += datetime.timedelta(days=1)
            assert all(latest - datetime.timedelta(days=days) <= c <= latest for c in covered)


@pytest.mark.parametrize("day", ["2023-10-31", "2023-10-10", "2022-02-03", "2021-01-01"])
def test_as_of_equals_a_load_cut_there(spark, tmp_dir, day):
    wh = warehouse.from_tpch(spark, SF)
    staging = tpch.staging_from_tpch(spark, SF)
    cut = warehouse.load(spark, staging.filter(F.col("Date") <= day), order=tpch.LOAD_ORDER)
    # the dimensions carry no history: those of today
    cut = warehouse.materialize(warehouse.Warehouse(spark, wh.stores, wh.products, cut.fact), f"{tmp_dir}/cut")
    then = warehouse.as_of(wh, datetime.date.fromisoformat(day))
    names = ["inventory_kpis", "current_stock_levels", "store_performance", "seasonal_analysis"]
    for name in names if day != "2021-01-01" else names[:2]:
        a, b = (sorted(map(tuple, registry.QUERIES[name](w, DEFAULT).collect()), key=repr) for w in (then, cut))
        assert a == b, name
    if then.sku_stats is not None:
        fresh = sku_stats.window_stats(cut.fact.filter(F.col("date") >= F.date_sub(F.lit(then.latest), 180)), F.lit(then.latest), (90, 180, 7))
        assert then.sku_stats.exceptAll(fresh).count() == 0 == fresh.exceptAll(then.sku_stats).count()
        assert then.latest == cut.latest and then.fact.count() == cut.fact.count()


def test_ranks_over_ranges_equal_a_window(spark, tmp_dir):
    rows = spark.range(20_000).selectExpr("if(id % 3 = 0, 'hot', concat('g', id % 50)) as g", "(id * 7919) % 101 as v", "id")
    rows = rows.withColumn("v", F.when(F.col("id") % 17 != 0, F.col("v")))
    order = [F.col("v").isNull(), -F.col("v"), F.col("id")]

    def parts(df, group, by, **totals):
        return range_parts(df, group, by, f"{tmp_dir}/r", **totals)

    got = group_rank(rows, ["g"], order, "_rank", "_size", parts=parts).select("id", "_rank", "_size")
    w = Window.partitionBy("g")
    want = rows.select("id", F.row_number().over(w.orderBy(*order)).cast("bigint").alias("_rank"), F.count("*").over(w).alias("_size"))
    assert got.count() == 20_000 and got.exceptAll(want).count() == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert range_parts(rows, ["g"], order, f"{tmp_dir}/s").select("_part").distinct().count() > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert group_rank(rows.limit(0), ["g"], order, parts=parts).count() == 0


def test_stored_analysis_plans_no_rank(spark):
    wh = warehouse.from_tpch(spark, SF)
    for name in ("stockout_risk", "reorder_analysis", "abc_classification", "inventory_turnover", "inventory_kpis"):
        plan = registry.QUERIES[name](wh, DEFAULT)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Window" not in plan and "Exchange" not in plan, name
    for name in ("executive_kpi_dashboard", "store_performance", "category_performance"):
        plan = registry.QUERIES[name](wh, DEFAULT)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") <= 3 and "inventory_data" not in plan and "row_number" not in plan, name


HEADER = ",".join(schemas.STAGING.fieldNames())
GOOD = "2024-01-0{d},S1,P{p},Toys,North,5,1,0,1.00,2.00,0,Sunny,None,2.10,Winter"


def test_rejects_are_counted_over_all_loads(spark, tmp_dir):
    def write(name, *lines):
        with open(f"{tmp_dir}/{name}.csv", "w") as fh:
            fh.write("\n".join([HEADER, *lines]) + "\n")
        return feed.read_staging(spark, f"{tmp_dir}/{name}.csv")

    one = write("a", GOOD.format(d=1, p=1), GOOD.format(d=1, p=1), GOOD.format(d=1, p=1).replace("2024-01-01", "not a day"), GOOD.format(d=2, p=1).replace(",5,1,", ",\\N,,"),
                GOOD.format(d=3, p=1).replace("S1", "\\N"), GOOD.format(d=3, p=9).replace("Toys", "\\N"), GOOD.format(d=4, p=1).replace("Sunny", "x" * 30))
    two = write("b", GOOD.format(d=1, p=1), GOOD.format(d=5, p=2).replace("2.00", "\\N"))
    wh = warehouse.append(warehouse.materialize(warehouse.load(spark, one), f"{tmp_dir}/wh"), two)
    got = {(r["reason"], r["column_name"]): r["rows"] for r in registry.QUERIES["load_rejects"](wh, DEFAULT).collect() if r["rows"]}
    assert got == {
        ("staged", ""): 9, ("loadable", ""): 7, ("undated", "Date"): 1, ("keyless", "Store_ID"): 1,
        ("over_long", "Weather_Condition"): 1, ("defaulted", "Inventory_Level"): 1, ("defaulted", "Units_Sold"): 1,
        ("defaulted", "Price"): 1, ("orphan", "products"): 1, ("accepted", ""): 4, ("skipped", ""): 3,
    }
    bad = {r["referenced_table"]: r["violating_rows"] for r in registry.QUERIES["fk_violations"](wh, DEFAULT).filter("table_name = 'inventory_data'").collect()}
    assert bad == {"stores": 0, "products": 1}
    assert sum(r["violating_rows"] for r in registry.QUERIES["constraint_report"](wh, DEFAULT).collect()) == 1
    direct = wh.staging.agg(*rejects.counters(wh.staging)).first()
    assert direct["staged:"] == 9 and direct["defaulted:Price"] == 1


def test_one_malformed_line_is_put_aside(spark, tmp_dir):
    lines = [GOOD.format(d=1, p=1), "2024-01-01,S1", GOOD.format(d=2, p=1) + ",extra", GOOD.format(d=3, p=1).replace(",5,", ",five,"), GOOD.format(d=4, p=1)]
    with open(f"{tmp_dir}/feed.csv", "w") as fh:
        fh.write("\n".join([HEADER, *lines]) + "\n")
    wh = warehouse.load(spark, feed.read_staging(spark, f"{tmp_dir}/feed.csv", quarantine=f"{tmp_dir}/bad"))
    assert sorted(str(r["date"]) for r in wh.fact.collect()) == ["2024-01-01", "2024-01-04"]
    bad = spark.read.parquet(f"{tmp_dir}/bad").collect()
    assert sorted(r["reason"] for r in bad) == ["Inventory_Level", "fields", "fields"]
    assert all(r["file"].endswith("feed.csv") and r["block"] == 0 for r in bad) and {lines[1], lines[2]} <= {r["line"] for r in bad}
    with pytest.raises(Exception):  # noqa: B017
        feed.read_staging(spark, f"{tmp_dir}/feed.csv").collect()


def test_empty_batch_and_empty_load(spark, tmp_dir):
    rows, = by_day(spark, "2022-01-01", "2022-03-31")
    empty = warehouse.materialize(warehouse.load(spark, rows.limit(0), order=tpch.LOAD_ORDER), f"{tmp_dir}/e")
    assert empty.latest is None and empty.fact.count() == 0
    filled = warehouse.append(empty, rows, order=tpch.LOAD_ORDER)
    whole = warehouse.materialize(warehouse.load(spark, rows, order=tpch.LOAD_ORDER), f"{tmp_dir}/w")
    same = warehouse.append(whole, rows.limit(0), order=tpch.LOAD_ORDER)
    a, b, c = state(filled), state(whole), state(same)
    assert a.pop("version") == c.pop("version") == 1 and b.pop("version") == 0 and a == b == c


def test_keys_under_a_collation_fall_together(spark, tmp_dir):
    def write(name, *lines):
        with open(f"{tmp_dir}/{name}.csv", "w") as fh:
            fh.write("\n".join([HEADER, *lines]) + "\n")
        return feed.read_staging(spark, f"{tmp_dir}/{name}.csv")

    one = write("a", GOOD.format(d=1, p=1).replace("S1", "s1"), GOOD.format(d=1, p=1).replace(",5,", ",6,"), GOOD.format(d=2, p=1).replace("North", "Nórth"))
    two = write("b", GOOD.format(d=2, p=1).replace("P1", "p1"), GOOD.format(d=3, p=1).replace("North", "NORTH").replace("S1", "s1"))
    wh = warehouse.materialize(warehouse.load(spark, one, key_collation="UNICODE_CI_AI"), f"{tmp_dir}/wh")
    wh = warehouse.append(wh, two)
    got = sorted((str(r["date"]), r["store_id"], r["region"], r["product_id"], r["inventory_level"]) for r in wh.fact.collect())
    assert got == [(f"2024-01-0{d}", "S1", "North", "P1", 5) for d in (1, 2, 3)]
    assert wh.stores.count() == wh.products.count() == 1 and wh.collation == "UNICODE_CI_AI"
    plain = warehouse.load(spark, one)
    assert plain.stores.count() == 3 and plain.fact.count() == 3


def test_key_check_moves_no_keys_where_they_hold(spark):
    from shelfwise.operators import integrity

    wh = warehouse.from_tpch(spark, SF)
    keys = wh.fact.select(*schemas.INVENTORY_KEY)
    assert integrity.suspects(keys, "date", schemas.SKU).count() == 0
    some = keys.filter("product_id = 'P1' and date between '2023-01-10' and '2023-01-20'")
    doubled = keys.unionByName(some).unionByName(some.filter("store_id = 'S001'"))
    a = integrity.pk_violations([("f", integrity.suspects(doubled, "date", schemas.SKU), schemas.INVENTORY_KEY)]).first()
    b = integrity.pk_violations([("f", doubled, schemas.INVENTORY_KEY)]).first()
    assert a == b and a["duplicate_keys"] == some.count() > 0


def test_collated_rows_are_not_shuffled_by_a_key_text(spark, monkeypatch):
    from shelfwise.operators import etl

    # two spellings of a store in a third of the rows each; regions and categories that nothing changes
    store, goods = "CASE id % 3 WHEN 0 THEN 's1' WHEN 1 THEN 'S1' END AS Store_ID", "IF(id % 2 = 0, 'p1', 'P1') AS Product_ID"
    rest = ["'Toys' AS Category", "'North' AS Region", "CAST(id AS INT) AS Inventory_Level", "1 AS Units_Sold", "0 AS Units_Ordered"]
    money = [f"CAST(1 AS DECIMAL(10,2)) AS {c}" for c in ("Demand_Forecast", "Price", "Competitor_Pricing")] + ["CAST(0 AS DECIMAL(5,2)) AS Discount"]
    texts = ["'Sunny' AS Weather_Condition", "'None' AS Holiday_Promotion", "'Winter' AS Seasonality"]
    rows = spark.range(600).selectExpr("id", "'2024-01-01' AS Date", store, goods, *rest, *money, *texts)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wh = warehouse.load(spark, rows, order=["id"], key_collation="UNICODE_CI_AI")
        assert "Exchange hashpartitioning" not in wh.staging._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(etl, "FEW_SPELLINGS", 0)  # more changes than go to all tasks: the same rows by a shuffle
        shuffled = warehouse.load(spark, rows, order=["id"], key_collation="UNICODE_CI_AI").staging
        for got in (wh.staging, shuffled):
            found = {(r["Store_ID"], r["Product_ID"], r["Region"], r["Category"]): r["count"]
                     for r in got.groupBy("Store_ID", "Product_ID", "Region", "Category").count().collect()}
            assert found == {("S1", "P1", "North", "Toys"): 400, (None, "P1", "North", "Toys"): 200}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
