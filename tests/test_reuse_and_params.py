"""Written tables are reopened for an unchanged source; stockout policy values are parameters."""

from __future__ import annotations

import shutil

import pyarrow.parquet as pq

from shelfwise.functions.params import Params
from shelfwise.plans import registry
from shelfwise.sources import tpch, warehouse

SF = "/root/testdata/sf0.001"


def test_same_source_is_reopened_and_a_changed_one_loaded(spark, tmp_dir, monkeypatch):
    for table in tpch.TABLES:
        shutil.copyfile(f"{SF}/{table}.parquet", f"{tmp_dir}/{table}.parquet")
    first = warehouse.from_tpch(spark, tmp_dir)
    monkeypatch.setattr(warehouse, "_REGISTRY", {})  # as in another application

    def no_load(*args, **kwargs):
        raise AssertionError("loaded again")

    with monkeypatch.context() as m:
        m.setattr(warehouse, "materialize", no_load)
        again = warehouse.from_tpch(spark, tmp_dir)
    assert again.location == first.location and again.fact.count() == first.fact.count()
    assert again.kpis is not None and again.staging.count() == first.staging.count()

    rows = first.fact.count()
    lines = pq.read_table(f"{SF}/lineitem.parquet")
    pq.write_table(lines.slice(0, lines.num_rows // 2), f"{tmp_dir}/lineitem.parquet")
    changed = warehouse.from_tpch(spark, tmp_dir)
    assert changed.location != first.location and 0 < changed.fact.count() < rows


def test_weights_of_the_stockout_score_change_it(spark):
    sf = "/root/testdata/sf0.01"
    p = Params(risk_weights=("1.0", "0.0", "0.0"))
    rows = registry.run("stockout_risk", spark, sf, p=p).collect()
    assert rows and all(r["stockout_risk_score"] == r["inventory_risk_score"] for r in rows)
    base = registry.run("stockout_risk", spark, sf).collect()
    assert {r["stockout_risk_score"] for r in base} != {r["stockout_risk_score"] for r in rows}
