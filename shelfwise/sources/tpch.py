"""Derive the daily inventory feed from the driver's TPC-H-style tables.

Each ``lineitem`` row becomes one staging row (same 15 columns as the CSV
feed), joined to its part (price), and to its supplier's nation's region
(the store region).  The rules are fixed values shared with the DuckDB oracle:

* date       = 2022-01-01 + (days from 1995-01-01 to l_shipdate) mod 731
* store_id   = 'S00' || (l_suppkey mod 5 + 1)
* product_id = 'P' || (l_partkey mod product_modulus)      (default 10)
* category   by l_partkey mod 10: 0-3 Clothing, 4-6 Electronics,
               7 Furniture, 8 Toys, 9 Groceries
* inventory_level = (l_orderkey*7 + l_partkey*13 + l_linenumber*31) mod 300
* units_sold = l_quantity, units_ordered = (l_orderkey*11 + l_suppkey*17) mod 120
* demand_forecast = l_quantity * 1.1, price = p_retailprice,
  discount = l_discount * 100, competitor_pricing = price * 1.02
* weather: returnflag A Sunny, N Rainy, else linestatus F Cloudy, else Snowy
* holiday_promotion: 'Promotion' if l_linenumber = 1 else 'None'
* seasonality by month: 12,1,2 Winter; 3-5 Spring; 6-8 Summer; else Autumn

Duplicate (date, store, region, product) rows are resolved by the load's
INSERT IGNORE rule in the order of ``LOAD_ORDER`` (l_quantity stands for
units_sold: all quantities are whole numbers).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import band

# fixed values of the mapping
DATE_BASE = "2022-01-01"
SHIP_BASE = "1995-01-01"
DATE_SPAN_DAYS = 731
N_STORES = 5
CATEGORY_BY_PARTKEY_MOD10 = [
    "Clothing", "Clothing", "Clothing", "Clothing",
    "Electronics", "Electronics", "Electronics",
    "Furniture", "Toys", "Groceries",
]

# Load order of staging rows (the INSERT IGNORE tie-break).
#: Tables the feed is derived from.
TABLES = ("lineitem", "part", "supplier", "nation", "region")
LOAD_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows over the cores when the scan yields fewer
    partitions than the session's parallelism (a file with one large row
    group is read by one task).  A no-op for inputs with many row groups."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # session without a local SparkContext (Spark Connect)
        return df
    return df.repartition(cores) if parts < cores else df


def season_of(date_col) -> F.Column:
    m = F.month(date_col)
    return band(
        [
            (m.isin(12, 1, 2), "Winter"),
            (m.isin(3, 4, 5), "Spring"),
            (m.isin(6, 7, 8), "Summer"),
        ],
        "Autumn",
    )


def category_of(partkey) -> F.Column:
    r = partkey % 10
    bands = [(r == i, name) for i, name in enumerate(CATEGORY_BY_PARTKEY_MOD10)]
    return band(bands[:-1], CATEGORY_BY_PARTKEY_MOD10[-1])


def staging_from_tpch(spark: SparkSession, sf_dir: str, product_modulus: int = 10) -> DataFrame:
    """Staging rows (15 feed columns, ``Date`` typed) plus the ``LOAD_ORDER``
    lineage columns."""
    li = spread(
        _read(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        )
    )
    # Each dimension is joined on its own, so the planner sizes every join
    # from that table's files: small ones are broadcast, large ones
    # (part and supplier at big scale factors) are shuffle-joined.
    rows = (
        li.join(_read(spark, sf_dir, "part").select("p_partkey", "p_retailprice"),
                F.col("l_partkey") == F.col("p_partkey"))
        .join(_read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"),
              F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"),
              F.col("s_nationkey") == F.col("n_nationkey"))
        .join(_read(spark, sf_dir, "region").select("r_regionkey", "r_name"),
              F.col("n_regionkey") == F.col("r_regionkey"))
    )
    day = F.date_add(
        F.lit(DATE_BASE).cast("date"),
        (F.datediff(F.to_date("l_shipdate"), F.lit(SHIP_BASE).cast("date")) % DATE_SPAN_DAYS).cast("int"),
    )
    price = F.col("p_retailprice").cast("decimal(10,2)")
    qty = F.col("l_quantity").cast("decimal(10,2)")
    return rows.select(
        day.alias("Date"),  # already a date: the load skips the text parse
        F.concat(F.lit("S00"), (F.col("l_suppkey") % N_STORES + 1).cast("string")).alias("Store_ID"),
        F.concat(F.lit("P"), (F.col("l_partkey") % product_modulus).cast("string")).alias("Product_ID"),
        category_of(F.col("l_partkey")).alias("Category"),
        F.col("r_name").alias("Region"),
        ((F.col("l_orderkey") * 7 + F.col("l_partkey") * 13 + F.col("l_linenumber") * 31) % 300)
        .cast("int").alias("Inventory_Level"),
        F.col("l_quantity").cast("int").alias("Units_Sold"),
        ((F.col("l_orderkey") * 11 + F.col("l_suppkey") * 17) % 120).cast("int").alias("Units_Ordered"),
        (qty * F.lit(Decimal("1.1"))).cast("decimal(10,2)").alias("Demand_Forecast"),
        price.alias("Price"),
        (F.col("l_discount").cast("decimal(5,2)") * 100).cast("decimal(5,2)").alias("Discount"),
        band(
            [
                (F.col("l_returnflag") == "A", "Sunny"),
                (F.col("l_returnflag") == "N", "Rainy"),
                (F.col("l_linestatus") == "F", "Cloudy"),
            ],
            "Snowy",
        ).alias("Weather_Condition"),
        F.when(F.col("l_linenumber") == 1, F.lit("Promotion")).otherwise(F.lit("None")).alias("Holiday_Promotion"),
        (price * F.lit(Decimal("1.02"))).cast("decimal(10,2)").alias("Competitor_Pricing"),
        season_of(day).alias("Seasonality"),
        # lineage for the INSERT IGNORE order
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
