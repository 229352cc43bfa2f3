"""Key and catalog checks of the data model, as reports with counts.

The reference relies on its database to enforce primary and foreign keys and
lists tables and constraints from the catalog.  Here the same rules are
checked by Spark jobs and always return one row per checked rule (a zero
count is a pass), so an empty result never hides a failure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def pk_violations(tables: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """Per (table, key): number of keys held by more than one row, and those rows.

    One hash aggregate per table (map-side partial counts), so a key copied
    millions of times is reduced before the shuffle.
    """
    out = None
    for name, df, key in tables:
        dup = (
            df.groupBy(*key)
            .agg(F.count(F.lit(1)).alias("c"))
            .filter(F.col("c") > 1)
            .agg(F.count(F.lit(1)).alias("duplicate_keys"), F.coalesce(F.sum("c"), F.lit(0)).alias("duplicate_rows"))
            .select(
                F.lit(name).alias("table_name"),
                F.lit(", ".join(key)).alias("key_columns"),
                F.col("duplicate_keys").cast("bigint").alias("duplicate_keys"),
                F.col("duplicate_rows").cast("bigint").alias("duplicate_rows"),
            )
        )
        out = dup if out is None else out.unionByName(dup)
    return out


def suspects(rows: DataFrame, date: str, rest: Sequence[str]) -> DataFrame:
    """Rows of the (``rest``, month) groups that hold more rows than different days.

    Only these can break a key of ``date`` and ``rest``. One row per group and task crosses the network: a
    count and a bitmap of the month's days, not the keys themselves. Where the key holds, nothing is left.
    """
    month = F.date_trunc("month", F.col(date)).alias("_month")
    days = F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth(date))))
    crowded = rows.groupBy(*rest, month).agg(F.count(F.lit(1)).alias("_rows"), days.alias("_days"))
    crowded = crowded.filter(F.col("_rows") > F.col("_days")).select(*rest, "_month")
    return rows.withColumn("_month", month).join(crowded, [*rest, "_month"], "left_semi").drop("_month")


def fk_violations(fact: DataFrame, stores: DataFrame, products: DataFrame, table: str = "inventory_data") -> DataFrame:
    """Rows of ``fact`` whose store location or product has no parent row.

    The fact is first reduced to its distinct SKUs with row counts; the
    anti-joins then run at SKU grain.
    """
    sku = fact.groupBy(*schemas.SKU).agg(F.count(F.lit(1)).alias("rows"))
    no_store = sku.join(stores.select(*schemas.STORES_KEY), list(schemas.STORES_KEY), "left_anti")
    no_product = sku.join(products.select("product_id"), ["product_id"], "left_anti")

    def summary(df, constraint, parent):
        return df.agg(
            F.lit(table).alias("table_name"),
            F.lit(constraint).alias("constraint_name"),
            F.lit(parent).alias("referenced_table"),
            F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("violating_rows"),
        )

    return summary(no_store, f"{table}_ibfk_1", "stores").unionByName(
        summary(no_product, f"{table}_ibfk_2", "products")
    )


def constraint_report(violations: DataFrame) -> DataFrame:
    """The foreign-key catalogue (one row per key column) with violation counts."""
    spark = violations.sparkSession
    catalog = spark.createDataFrame(
        schemas.FOREIGN_KEYS,
        "table_name string, column_name string, constraint_name string, "
        "referenced_table_name string, referenced_column_name string",
    )
    counts = violations.select("constraint_name", "violating_rows")
    return catalog.join(counts, "constraint_name", "left").select(
        "table_name",
        "column_name",
        "constraint_name",
        "referenced_table_name",
        "referenced_column_name",
        F.coalesce(F.col("violating_rows"), F.lit(0)).cast("bigint").alias("violating_rows"),
    )


def table_profile(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Table name, comment and exact row count for every table of the model."""
    out = None
    for name in sorted(tables):
        one = tables[name].agg(F.count(F.lit(1)).cast("bigint").alias("table_rows")).select(
            F.lit(name).alias("table_name"),
            F.lit(schemas.TABLE_COMMENTS.get(name, "")).alias("table_comment"),
            "table_rows",
        )
        out = one if out is None else out.unionByName(one)
    return out
