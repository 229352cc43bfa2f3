"""Incremental current-stock snapshot equals a batch recomputation."""

import os

from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators.windowing import latest_per_key
from shelfwise.sources import warehouse
from shelfwise.streaming import current_stock

SF = "/root/testdata/sf0.001"


def test_stream_keeps_latest_rows(spark, tmp_dir):
    fact = warehouse.from_tpch(spark, SF, materialized=False).fact.cache()
    src = os.path.join(tmp_dir, "fact_in")
    snap = os.path.join(tmp_dir, "snapshot")
    ckpt = os.path.join(tmp_dir, "ckpt")
    early = fact.filter(F.col("date") < "2023-01-01")
    late = fact.filter(F.col("date") >= "2023-01-01")

    early.write.mode("append").parquet(src)
    current_stock.start(spark, src, snap, ckpt).awaitTermination()
    mid = current_stock.read_snapshot(spark, snap)
    expect_mid = latest_per_key(early, schemas.SKU, "date")
    assert mid.exceptAll(expect_mid.select(*mid.columns)).count() == 0
    assert mid.count() == expect_mid.count()

    late.write.mode("append").parquet(src)
    current_stock.start(spark, src, snap, ckpt).awaitTermination()
    final = current_stock.read_snapshot(spark, snap)
    expect = latest_per_key(fact, schemas.SKU, "date")
    assert final.count() == expect.count()
    assert final.exceptAll(expect.select(*final.columns)).count() == 0
    fact.unpersist()


def test_same_key_keeps_existing_row(spark):
    cols = schemas.INVENTORY.fieldNames()
    base = warehouse.from_tpch(spark, SF, materialized=False).fact.orderBy(*schemas.INVENTORY_KEY).limit(1)
    changed = base.withColumn("inventory_level", F.lit(-1))
    out = current_stock.merge_latest(base, changed).select(*cols).collect()
    assert out == base.select(*cols).collect()


FEED_1 = (
    "Date,Store ID,Product ID,Category,Region,Inventory Level,Units Sold,Units Ordered,Demand Forecast,"
    "Price,Discount,Weather Condition,Holiday/Promotion,Competitor Pricing,Seasonality\n"
    "2024-01-01,S001,P0001,Toys,North,50,5,1,1.00,10.00,0,Sunny,None,1.00,Winter\n"
    "2024-01-01,S001,P0002,Toys,North,60,6,1,1.00,10.00,0,Sunny,None,1.00,Winter\n"
)
FEED_2 = (
    "Date,Store ID,Product ID,Category,Region,Inventory Level,Units Sold,Units Ordered,Demand Forecast,"
    "Price,Discount,Weather Condition,Holiday/Promotion,Competitor Pricing,Seasonality\n"
    "2024-01-01,S001,P0001,Toys,North,999,9,1,1.00,10.00,0,Sunny,None,1.00,Winter\n"
    "2024-01-02,S001,P0001,Toys,North,40,7,1,1.00,10.00,0,Sunny,None,1.00,Winter\n"
    "2024-01-02,S009,P0003,Games,South,5,1,1,1.00,20.00,0,Rainy,None,1.00,Winter\n"
)


def test_feed_stream_loads_batches_idempotently(spark, tmp_dir):
    from shelfwise.plans import core
    from shelfwise.sources import feed
    from shelfwise.streaming import feed_loader

    feed_dir, loc, ckpt = (os.path.join(tmp_dir, d) for d in ("feed", "wh", "ckpt"))
    os.makedirs(feed_dir)
    seed = os.path.join(tmp_dir, "seed.csv")
    with open(seed, "w") as fh:
        fh.write(FEED_1)
    warehouse.materialize(warehouse.load(spark, feed.read_staging(spark, seed)), loc)

    for i, text in enumerate([FEED_1, FEED_2]):  # FEED_1 again: nothing new
        with open(os.path.join(feed_dir, f"day{i}.csv"), "w") as fh:
            fh.write(text)
        feed_loader.start(spark, feed_dir, loc, ckpt).awaitTermination()

    wh = warehouse.open_written(spark, loc)
    rows = {(r.date.isoformat(), r.product_id): r.inventory_level for r in wh.fact.collect()}
    assert rows == {
        ("2024-01-01", "P0001"): 50, ("2024-01-01", "P0002"): 60,
        ("2024-01-02", "P0001"): 40, ("2024-01-02", "P0003"): 5,
    }
    assert {r.product_id for r in wh.products.collect()} == {"P0001", "P0002", "P0003"}
    assert wh.stores.count() == 2 and wh.version == 2 and str(wh.latest) == "2024-01-02"
    stock = {r.product_id: r.inventory_level for r in core.current_stock_levels(wh).collect()}
    assert stock == {"P0001": 40, "P0002": 60, "P0003": 5}
