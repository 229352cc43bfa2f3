"""The ways in and out of the warehouse as queries: feed files, a second batch, upsert, export.

Each works in a folder of its own below ``spark.checkpoint.dir`` and returns
what is stored at the end; the folder belongs to the owner of that setting.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.expr import presentation
from ..functions.params import DEFAULT
from ..sources import feed, tpch, warehouse
from . import kpis, oracle, registry, reports


def _folder(spark: SparkSession) -> str:
    return f"{warehouse.shared_root(spark)}/shelfwise/run-{uuid.uuid4().hex}"


def _fact(wh: warehouse.Warehouse) -> DataFrame:
    return presentation(wh.fact.select(*schemas.INVENTORY.fieldNames()))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written as several CSV files, read again and loaded."""
    folder = _folder(spark)
    feed.write_feed(warehouse.from_tpch(spark, sf_dir).staging, folder, tpch.LOAD_ORDER)
    return _fact(warehouse.load(spark, feed.read_staging(spark, folder)))


def append_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even orders loaded, odd orders appended twice: stored rows win and the replay adds nothing."""
    staging = warehouse.from_tpch(spark, sf_dir).staging
    even, odd = staging.filter("l_orderkey % 2 = 0"), staging.filter("l_orderkey % 2 = 1")
    first = warehouse.materialize(warehouse.load(spark, even, order=tpch.LOAD_ORDER), _folder(spark))
    warehouse.append(first, odd, order=tpch.LOAD_ORDER)
    return _fact(warehouse.append(first, odd, order=tpch.LOAD_ORDER))


def kpi_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPI rows of some stores with no safety stock, then the right rows of overlapping stores."""
    rows, folder = kpis.inventory_kpis(warehouse.from_tpch(spark, sf_dir)), _folder(spark)
    kpis.upsert_kpis(rows.filter("store_id <= 'S003'").withColumn("safety_stock", F.lit(-1)), folder)
    kpis.upsert_kpis(rows.filter("store_id >= 'S002'"), folder)
    return presentation(spark.read.schema(rows.schema).parquet(folder).select(*rows.columns))


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reorder report exported as CSV and read again."""
    name, wh = "reorder_analysis", warehouse.from_tpch(spark, sf_dir)
    path = reports.export_reports(wh, _folder(spark), [name])[0]
    schema = presentation(registry.QUERIES[name](wh, DEFAULT)).schema
    return spark.read.schema(schema).option("header", True).csv(path)


def _damaged(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    """A feed with bad dates, missing keys, missing measures, long texts and one product without a category, loaded."""
    folder, order = _folder(spark), F.col("l_orderkey")
    rows = warehouse.from_tpch(spark, sf_dir).staging.withColumns(
        {
            "Date": F.when(order % 11 == 0, F.lit("some day")).otherwise(F.col("Date").cast("string")),
            "Store_ID": F.when(order % 13 != 0, F.col("Store_ID")),
            "Units_Sold": F.when(order % 17 != 0, F.col("Units_Sold")),
            "Holiday_Promotion": F.when(order % 19 == 0, F.repeat(F.lit("sale "), 12)).otherwise(F.col("Holiday_Promotion")),
            "Category": F.when(F.col("Product_ID") != "P9", F.col("Category")),
        }
    )
    feed.write_feed(rows, f"{folder}/feed", tpch.LOAD_ORDER)
    return warehouse.materialize(warehouse.load(spark, feed.read_staging(spark, f"{folder}/feed")), f"{folder}/tables")


def damaged_feed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the load of a damaged feed turned away or filled in."""
    return registry.QUERIES["load_rejects"](_damaged(spark, sf_dir), DEFAULT)


def damaged_feed_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows of a damaged feed that break a foreign key."""
    return registry.QUERIES["fk_violations"](_damaged(spark, sf_dir), DEFAULT)


def quarantine_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with malformed lines: how many were put aside by reason, and how many rows were loaded."""
    folder, order = _folder(spark), F.col("l_orderkey")
    rows = warehouse.from_tpch(spark, sf_dir).staging
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit(feed.NULL_MARK)) for c in schemas.STAGING.fieldNames()}
    price = F.when(order % 29 == 0, F.lit("cheap")).otherwise(texts["Price"])
    line = F.concat_ws(",", *(texts | {"Price": price}).values())
    line = F.when(order % 23 == 0, F.concat(line, F.lit(",more"))).when(order % 31 == 0, F.lit("2022-01-01,S001")).otherwise(line)
    feed.write_lines(rows, line, f"{folder}/feed", tpch.LOAD_ORDER)
    wh = warehouse.load(spark, feed.read_staging(spark, f"{folder}/feed", quarantine=f"{folder}/bad", header=False))
    bad = spark.read.parquet(f"{folder}/bad").groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))
    return bad.unionByName(wh.fact.agg(F.lit("loaded").alias("reason"), F.count(F.lit(1)).alias("lines")))


def collated_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed whose keys are spelt in several ways, loaded under a collation without case and accents, in two batches."""
    order = F.col("l_orderkey")
    rows = warehouse.from_tpch(spark, sf_dir).staging.withColumns(
        {
            "Store_ID": F.when(order % 2 == 1, F.lower("Store_ID")).otherwise(F.col("Store_ID")),
            "Region": F.when(F.col("l_linenumber") == 2, F.translate(F.initcap("Region"), "ae", "\u00e1\u00e9")).otherwise(F.col("Region")),
            "Product_ID": F.when(order % 3 == 1, F.lower("Product_ID")).otherwise(F.col("Product_ID")),
        }
    )
    even, odd = rows.filter(order % 2 == 0), rows.filter(order % 2 == 1)
    first = warehouse.load(spark, even, order=tpch.LOAD_ORDER, key_collation="UNICODE_CI_AI")
    return _fact(warehouse.append(warehouse.materialize(first, _folder(spark)), odd, order=tpch.LOAD_ORDER))


_WAYS = (
    csv_roundtrip, append_two_batches, kpi_upsert, export_roundtrip, damaged_feed_rejects, damaged_feed_violations,
    quarantine_roundtrip, collated_feed,
)
QUERIES = {f.__name__: f for f in _WAYS}

_DAMAGE = oracle.staged(
    Date="CASE WHEN l_orderkey % 11 = 0 THEN 'some day' ELSE CAST(date AS VARCHAR) END",
    Store_ID="CASE WHEN l_orderkey % 13 <> 0 THEN store_id END",
    Units_Sold="CASE WHEN l_orderkey % 17 <> 0 THEN units_sold END",
    Holiday_Promotion="CASE WHEN l_orderkey % 19 = 0 THEN repeat('sale ', 12) ELSE holiday_promotion END",
    Category="CASE WHEN product_id <> 'P9' THEN category END",
)

ORACLE_SQL = {
    "csv_roundtrip": oracle.ORACLE_SQL["fact_inventory"],
    "append_two_batches": oracle.ORACLE_SQL["fact_inventory"].replace(
        "ORDER BY l_orderkey, l_linenumber", "ORDER BY l_orderkey % 2, l_orderkey, l_linenumber"
    ),
    "collated_feed": oracle.ORACLE_SQL["fact_inventory"].replace(
        "ORDER BY l_orderkey, l_linenumber", "ORDER BY l_orderkey % 2, l_orderkey, l_linenumber"
    ),
    "kpi_upsert": "SELECT * REPLACE (CASE WHEN store_id < 'S002' THEN -1 ELSE safety_stock END AS safety_stock)"
    f" FROM ({oracle.ORACLE_SQL['inventory_kpis']})",
    "export_roundtrip": oracle.ORACLE_SQL["reorder_analysis"],
    "damaged_feed_rejects": oracle.with_product_modulus("WITH" + oracle.BASE + _DAMAGE + oracle.REJECTS),
    "damaged_feed_violations": oracle.with_product_modulus(
        "WITH" + oracle.BASE + _DAMAGE + oracle.LOADABLE
        + """
        SELECT 'inventory_data' AS table_name, 'inventory_data_ibfk_1' AS constraint_name, 'stores' AS referenced_table,
               COUNT(*) AS violating_rows FROM loadable ANTI JOIN parents USING (Store_ID, Region)
        UNION ALL SELECT 'inventory_data', 'inventory_data_ibfk_2', 'products', COUNT(*)
               FROM loadable ANTI JOIN goods USING (Product_ID)
        UNION ALL SELECT 'inventory_kpis', 'inventory_kpis_ibfk_1', 'stores', 0
        UNION ALL SELECT 'inventory_kpis', 'inventory_kpis_ibfk_2', 'products', 0
        """
    ),
    "quarantine_roundtrip": oracle.with_product_modulus(
        "WITH" + oracle.BASE
        + """
        , judged AS (SELECT *, CASE WHEN l_orderkey % 23 = 0 OR l_orderkey % 31 = 0 THEN 'fields'
                                    WHEN l_orderkey % 29 = 0 THEN 'Price' END AS reason FROM src)
        SELECT reason, COUNT(*) AS lines FROM judged WHERE reason IS NOT NULL GROUP BY reason
        UNION ALL
        SELECT 'loaded', COUNT(*) FROM (SELECT DISTINCT date, store_id, region, product_id FROM judged WHERE reason IS NULL)
        """
    ),
}
