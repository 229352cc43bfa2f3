"""Loading a second batch into a written warehouse (INSERT IGNORE on an existing target)."""

import os

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.expr import decimals_to_double
from shelfwise.plans import registry
from shelfwise.sources import tpch, warehouse

SF = "/root/testdata/sf0.001"


def test_append_equals_one_load_of_both_batches(spark, tmp_dir):
    staging = tpch.staging_from_tpch(spark, SF)
    # batch 1: first half of the orders; batch 2: the rest, plus copies of
    # batch-1 rows with other measures (they must be ignored)
    first = staging.filter(F.col("l_orderkey") % 2 == 0)
    second = staging.filter(F.col("l_orderkey") % 2 == 1).unionByName(
        first.limit(50).withColumn("Inventory_Level", F.lit(-7))
    )
    wh1 = warehouse.materialize(warehouse.load(spark, first, order=tpch.LOAD_ORDER), os.path.join(tmp_dir, "inc"))
    wh2 = warehouse.append(wh1, second, order=tpch.LOAD_ORDER)
    assert wh2.version == 1

    # reference: one load where every batch-1 row precedes every batch-2 row
    both = first.withColumn("_batch", F.lit(1)).unionByName(second.withColumn("_batch", F.lit(2)))
    ref = warehouse.materialize(
        warehouse.load(spark, both, order=["_batch", *tpch.LOAD_ORDER]), os.path.join(tmp_dir, "ref")
    )
    cols = ref.fact.drop("month_key").columns
    a, b = wh2.fact.select(*cols), ref.fact.select(*cols)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    assert a.filter("inventory_level = -7").count() == 0
    for name in ["current_stock_levels", "stockout_risk", "executive_kpi_dashboard", "store_performance"]:
        x = decimals_to_double(registry.QUERIES[name](wh2, registry.DEFAULT)).collect()
        y = decimals_to_double(registry.QUERIES[name](ref, registry.DEFAULT)).collect()
        assert sorted(x) == sorted(y), name


def test_stale_handle_and_replay_after_a_crash(spark, tmp_dir, monkeypatch):
    staging = tpch.staging_from_tpch(spark, SF)
    first = staging.filter(F.col("l_orderkey") % 2 == 0)
    second = staging.filter(F.col("l_orderkey") % 2 == 1)
    wh = warehouse.materialize(warehouse.load(spark, first, order=tpch.LOAD_ORDER), os.path.join(tmp_dir, "w"))

    def crash(*args, **kwargs):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:  # the batch's folders are written, the SKU tables are not
        m.setattr(warehouse, "_derive", crash)
        with pytest.raises(RuntimeError):
            warehouse.append(wh, second, order=tpch.LOAD_ORDER)
    replayed = warehouse.append(wh, second, order=tpch.LOAD_ORDER)
    again = warehouse.append(wh, second, order=tpch.LOAD_ORDER)  # from the old handle
    assert (replayed.version, again.version) == (1, 2)
    key = ["date", "store_id", "region", "product_id"]
    assert again.fact.count() == again.fact.select(*key).distinct().count()
    for out in (replayed, again):
        latest = out.fact.groupBy("store_id", "region", "product_id").agg(F.max("date").alias("date"))
        stored = out.sku_latest.select(*latest.columns)
        assert stored.exceptAll(latest).count() == 0 and latest.exceptAll(stored).count() == 0
