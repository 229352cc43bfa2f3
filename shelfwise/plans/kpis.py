"""The KPI table: one row per SKU and calculation date.

The reference declares this table (with column defaults) but never fills it;
here it is filled from the core analyses, and written idempotently: a re-run
for the same calculation date replaces exactly that date's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.params import DEFAULT, Params
from ..sources.files import has_files
from ..sources.warehouse import Warehouse
from . import core

SKU = list(schemas.SKU)

# column defaults of the KPI table (fixed values)
KPI_DEFAULTS = {
    "abc_classification": "C",
    "movement_type": "SLOW_MOVER",
}


def inventory_kpis(wh: Warehouse, p: Params = DEFAULT) -> DataFrame:
    """KPIs of every SKU as of the latest date of the data.

    SKU list = every SKU with a current stock row, one row of ``core.sku_analysis`` each. Under the
    default parameters the table written with the warehouse version is read.
    """
    if wh.kpis is not None and core.stored_analysis(wh, p) and p.kpi_service_level == DEFAULT.kpi_service_level:
        return wh.kpis

    def build():
        def known(view, column, default):
            return F.coalesce(F.col(f"{view}.{column}"), F.lit(default))

        return core.sku_analysis(wh, p).select(
            *SKU,
            wh.latest_date().alias("calculation_date"),
            known("turnover", "avg_daily_sales", 0).cast("decimal(10,2)").alias("avg_daily_sales"),
            known("turnover", "inventory_turnover_ratio", 0).cast("decimal(10,2)").alias("inventory_turnover"),
            known("turnover", "days_of_supply", 0).cast("int").alias("days_of_supply"),
            known("reorder", "reorder_point", 0).cast("int").alias("reorder_point"),
            known("reorder", "safety_stock", 0).cast("int").alias("safety_stock"),
            known("abc", "abc_classification", KPI_DEFAULTS["abc_classification"]).alias("abc_classification"),
            known("turnover", "movement_type", KPI_DEFAULTS["movement_type"]).alias("movement_type"),
            F.lit(p.kpi_service_level).cast("decimal(5,2)").alias("service_level"),
        )

    return wh.memo(("inventory_kpis", p), build)


def upsert_kpis(kpis: DataFrame, path: str) -> None:
    """Insert KPI rows or replace the stored ones with their key; all other stored rows stay.

    The dates of ``kpis`` are rewritten as the union of what is stored for them and the new rows,
    of which the new one wins for a key (dynamic partition overwrite, so other dates are untouched
    and re-running a batch changes nothing). Of several new rows for one key the greatest by its
    other columns wins, however the rows were shuffled.
    """
    key = list(schemas.KPIS_KEY)
    rest = [c for c in kpis.columns if c not in key]
    rows = kpis.withColumn("_new", F.lit(1))
    if has_files(kpis.sparkSession, path):
        stored = kpis.sparkSession.read.schema(kpis.schema).parquet(path).select(*kpis.columns)
        dates = kpis.select("calculation_date").distinct()
        rows = rows.unionByName(stored.join(dates, "calculation_date", "left_semi").withColumn("_new", F.lit(0)))
    w = Window.partitionBy(*key).orderBy(F.desc("_new"), F.struct(*rest).desc())
    merged = rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_new")
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("calculation_date")
        .parquet(path)
    )
