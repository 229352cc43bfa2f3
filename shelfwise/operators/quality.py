"""Data-quality and distribution reports over the loaded fact.

Each report is one pass over the fact: rows are first reduced to SKU grain
(hash aggregate, map-side combine), and the distinct counts are taken over
that small result, so no COUNT(DISTINCT) expansion runs at fact grain and a
region or store holding a third of all rows is collapsed before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.expr import count_if, mean, rnd

SKU = list(schemas.SKU)

# fixed labels of the report rows
QUALITY_METRICS = [
    ("Total Records", "total_records"),
    ("Date Range", "date_range_days"),
    ("Unique Store-Region Combinations", "locations"),
    ("Unique Products", "products"),
    ("Unique Categories", "categories"),
    ("Records with Negative Inventory", "negative_inventory"),
    ("Records with Zero Sales and Inventory", "zero_sales_and_inventory"),
]


def _per_sku(fact: DataFrame) -> DataFrame:
    lvl, units = F.col("inventory_level"), F.col("units_sold")
    return fact.groupBy(*SKU).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        count_if(lvl < 0).alias("neg"),
        count_if((units == 0) & (lvl == 0)).alias("zero"),
        F.sum(lvl.cast("bigint")).alias("s_level"),
        F.sum(units.cast("bigint")).alias("s_units"),
        F.sum("price").alias("s_price"),
    )


def quality_report(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Seven (metric, value, details) rows, from one aggregate."""
    sku = _per_sku(fact).join(products.select("product_id", "category"), "product_id", "left")
    lo, hi = F.min("min_date"), F.max("max_date")
    one = sku.agg(
        F.sum("rows").alias("total_records"),
        F.datediff(hi, lo).cast("bigint").alias("date_range_days"),
        F.concat(lo.cast("string"), F.lit(" to "), hi.cast("string")).alias("date_range"),
        F.count_distinct(F.concat("store_id", F.lit("-"), "region")).alias("locations"),
        F.count_distinct("product_id").alias("products"),
        F.count_distinct("category").alias("categories"),
        F.array_join(F.array_sort(F.collect_set("category")), ",").alias("category_list"),
        F.sum("neg").alias("negative_inventory"),
        F.sum("zero").alias("zero_sales_and_inventory"),
    )
    details = {
        "Date Range": F.col("date_range"),
        "Unique Categories": F.col("category_list"),
        "Records with Negative Inventory": F.lit("Should be 0"),
        "Records with Zero Sales and Inventory": F.lit("May indicate data quality issues"),
    }
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("metric"),
                F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("value"),
                details.get(label, F.lit("")).alias("details"),
            )
            for label, c in QUALITY_METRICS
        ]
    )
    return one.select(F.inline(rows))


def region_distribution(fact: DataFrame) -> DataFrame:
    """Per region: stores, products, rows, average level and sales."""
    sku = _per_sku(fact)
    return sku.groupBy("region").agg(
        F.count_distinct("store_id").alias("stores_count"),
        F.count_distinct("product_id").alias("products_count"),
        F.sum("rows").alias("total_records"),
        rnd(mean(F.sum("s_level"), F.sum("rows")), 2).alias("avg_inventory_level"),
        rnd(mean(F.sum("s_units"), F.sum("rows")), 2).alias("avg_units_sold"),
    )


def category_distribution(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Per category: store locations, products, rows, average price and sales."""
    sku = _per_sku(fact).join(products.select("product_id", "category"), "product_id")
    return sku.groupBy("category").agg(
        F.count_distinct(F.concat("store_id", F.lit("-"), "region")).alias("store_region_combinations"),
        F.count_distinct("product_id").alias("products_count"),
        F.sum("rows").alias("total_records"),
        rnd(mean(F.sum("s_price"), F.sum("rows")), 2).alias("avg_price"),
        rnd(mean(F.sum("s_units"), F.sum("rows")), 2).alias("avg_units_sold"),
    )
