"""Hot keys: one SKU / one duplicate group holding a third of all rows."""

import datetime as dt
import random

from shelfwise import schemas
from shelfwise.functions.params import Params
from shelfwise.operators import etl
from shelfwise.plans import core
from shelfwise.sources import warehouse
from test_operators import staging_row


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _partial_before_exchange(plan: str, marker: str) -> bool:
    """``marker`` (a partial operator) appears below a shuffle exchange."""
    lines = plan.splitlines()
    ex = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    part = [i for i, line in enumerate(lines) if marker in line]
    return any(p > e for e in ex for p in part)


def test_dedup_and_latest_row_reduce_before_the_shuffle(spark):
    wh = warehouse.from_tpch(spark, "/root/testdata/sf0.001", materialized=False)
    assert _partial_before_exchange(_plan(wh.fact), "Partial")  # WindowGroupLimit ... Partial
    latest = core.latest_rows(wh, Params(read_snapshots=False))
    assert _partial_before_exchange(_plan(latest), "Partial")


def test_sku_aggregates_combine_map_side(spark):
    wh = warehouse.from_tpch(spark, "/root/testdata/sf0.001")
    plan = _plan(core.sales_stats(wh, Params(read_snapshots=False)))
    assert _partial_before_exchange(plan, "partial_sum")


def test_hot_sku_and_hot_duplicate_group(spark):
    rnd = random.Random(11)
    latest = dt.date(2023, 12, 31)
    rows = []
    # one SKU with a row on each of 91 days, copied 40 times per day
    for d in range(91):
        day = (latest - dt.timedelta(days=d)).isoformat()
        for copy in range(40):
            rows.append(staging_row(day, "S1", "HOT", "Toys", "East", 100 + d, 10 + (d % 7)))
    # many ordinary SKUs
    for p in range(60):
        for d in rnd.sample(range(91), 35):
            day = (latest - dt.timedelta(days=d)).isoformat()
            rows.append(staging_row(day, "S2", f"P{p}", "Toys", "West", rnd.randint(0, 300), rnd.randint(0, 40)))
    staging = spark.createDataFrame(rows, schemas.STAGING).repartition(8)
    wh = warehouse.load(spark, staging)
    fact = wh.fact
    assert fact.filter("product_id = 'HOT'").count() == 91
    hot = [r for r in core.reorder_analysis(wh).collect() if r.product_id == "HOT"][0]
    units = [10 + (d % 7) for d in range(91)]
    assert float(hot.avg_daily_sales) == round(sum(units) / 91, 2)
    assert hot.current_stock == 100  # latest date d = 0
    kept = etl.insert_ignore(
        etl.with_row_order(staging), ["Date", "Store_ID", "Region", "Product_ID"], [etl.ROW_ORDER]
    )
    assert kept.count() == fact.count()


def test_rows_of_a_large_split_are_dealt_out_before_they_are_sorted(spark):
    # a third of the rows has one key; the tasks that read them hold far more than a partition should
    rows = spark.range(0, 40_000, 1, 4).selectExpr("id", "IF(id % 3 = 0, 'hot', concat('k', id % 9000)) AS key", "sha2(string(id), 256) AS payload")
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.adaptive.enabled": "true"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        kept = etl.insert_ignore(rows, ["key"], ["id"])
        got = {r["key"]: r["id"] for r in kept.collect()}
        plan = _plan(kept).split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "_deal" not in kept.columns and "REBALANCE_PARTITIONS_BY_COL" in plan
    assert "skewed" in plan and _partial_before_exchange(plan, "Partial")
    first = {}
    for i in range(40_000):
        first.setdefault("hot" if i % 3 == 0 else f"k{i % 9000}", i)
    assert got == first
