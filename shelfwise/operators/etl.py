"""Load step: staging rows -> store and product dimensions -> daily fact.

The reference loads a CSV into a staging table and fills three tables with
``INSERT IGNORE ... SELECT``: the first row per primary key wins, later rows
with the same key are skipped, and rows that break a foreign key are dropped.
Here each table is a DataFrame built by one shuffle on its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from .. import schemas

ROW_ORDER = "_row_order"
# where a feed row was read: file path, and where its block starts in the file
FEED_FILE, FEED_BLOCK = "_feed_file", "_feed_block"


def with_row_order(df: DataFrame) -> DataFrame:
    """Tag rows with their input order: file by name, then place in the file.

    Used as the INSERT IGNORE tie-break when the source has no ordering
    columns of its own.  Row ids grow inside a block, and blocks are told apart
    by where they start, however the planner packs files into tasks.
    """
    place = [F.col(c) for c in (FEED_FILE, FEED_BLOCK) if c in df.columns]
    order = F.struct(*place, F.monotonically_increasing_id().alias("row"))
    return df.withColumn(ROW_ORDER, order).drop(FEED_FILE, FEED_BLOCK)


KEY_TEXTS = ("Store_ID", "Region", "Product_ID", "Category")


#: Changed spellings of a column up to which they go to all tasks (about 10 MB).
FEW_SPELLINGS = 100_000


def other_spellings(staging: DataFrame, collation: str, known: DataFrame | None = None) -> DataFrame:
    """(name, spelt, stands): key texts by column that are equal under ``collation`` (e.g. UNICODE_CI_AI) to another, which stands for them.

    The spelling in ``known``, rows with the same columns that are stored already, stands for its equals;
    of new ones the first in binary order. One pass over the rows groups the different spellings of all
    columns (a partial aggregate).
    """

    def texts(rows, rank):
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("spelt")) for c in KEY_TEXTS]))
        return rows.select(each.alias("text")).select("text.*", F.lit(rank).alias("rank"))

    spelt = texts(staging, 1) if known is None else texts(staging, 1).unionByName(texts(known, 0))
    each = spelt.filter(F.col("spelt").isNotNull()).groupBy("name", "spelt").agg(F.min("rank").alias("rank"))
    alike = each.groupBy("name", F.collate("spelt", collation).alias("alike")).agg(
        F.min(F.struct("rank", "spelt"))["spelt"].alias("stands"), F.collect_list("spelt").alias("all")
    )
    pairs = alike.filter(F.size("all") > 1).select("name", F.explode("all").alias("spelt"), "stands")
    return pairs.filter("spelt <> stands")


def one_spelling(staging: DataFrame, changes: DataFrame) -> DataFrame:
    """Staging rows in which the spellings that ``changes`` names (written ``other_spellings``) are replaced.

    So keys fall together in every later dedup, join and group, which all stay binary. A column has few
    different texts, so rows shuffled by one would gather in as few tasks: a column without changes
    is not joined, and up to ``FEW_SPELLINGS`` changes go to the rows, which stay where they are.
    """
    found = {r["name"]: r["count"] for r in changes.groupBy("name").count().collect()}
    out = staging
    for name in sorted(found, key=KEY_TEXTS.index):
        one = changes.filter(F.col("name") == name).select(F.col("spelt").alias(name), F.col("stands").alias("_stands"))
        one = F.broadcast(one) if found[name] <= FEW_SPELLINGS else one
        out = out.join(one, name, "left").withColumn(name, F.coalesce("_stands", name)).drop("_stands")
    return out.select(*staging.columns)


def insert_ignore(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per ``key`` under ``order``; drop the others.

    ``row_number() == 1`` plans as a partial ``WindowGroupLimit`` before the
    shuffle and a final one after it, so a key with millions of copies is cut
    down to one row per map task before anything moves to its key: heavy duplicate
    groups do not skew the shuffle.

    The partial step sorts all rows of its task. A split of a well compressed file holds
    millions, so the rows are dealt out before, by a digest of the key: a REBALANCE, whose parts
    are of about the advisory partition size. Copies of a key mostly meet there; a part that one
    key makes too large is split, which it could not be if it were dealt by the key itself.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    dealt = df.withColumn("_deal", F.xxhash64(*key)).hint("rebalance", "_deal")
    return dealt.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn", "_deal")


def build_stores(staging: DataFrame) -> DataFrame:
    """Distinct (store_id, region) with a generated name; type 'Retail'."""
    return (
        staging.select(F.col("Store_ID").alias("store_id"), F.col("Region").alias("region"))
        .filter(F.col("store_id").isNotNull() & F.col("region").isNotNull())
        .distinct()
        .select(
            "store_id",
            "region",
            F.concat(F.lit("Store "), F.col("store_id"), F.lit(" - "), F.col("region")).alias("store_name"),
            F.lit("Retail").alias("store_type"),
        )
    )


def build_products(staging: DataFrame) -> DataFrame:
    """One row per product_id.

    The reference inserts distinct (product, category) pairs ordered by
    category, so a product listed under two categories keeps the
    alphabetically first one: that is ``min(category)``.  A hash aggregate
    with map-side combine, output size = number of products.
    """
    return (
        staging.filter(F.col("Product_ID").isNotNull() & F.col("Category").isNotNull())
        .groupBy(F.col("Product_ID").alias("product_id"))
        .agg(F.min("Category").alias("category"))
        .select(
            "product_id",
            "category",
            F.concat(F.col("category"), F.lit(" Product "), F.col("product_id")).alias("product_name"),
        )
    )


def parse_staging(staging: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rename, parse the date and apply the fact table's NOT NULL defaults.

    Dates that do not parse (``%Y-%m-%d``, one or two digit month/day) become
    NULL and the row is dropped, as the reference's ``WHERE STR_TO_DATE(..)
    IS NOT NULL`` does.  NULL measures become 0 (NOT NULL DEFAULT 0).
    """
    if isinstance(staging.schema["Date"].dataType, DateType):
        cols = [F.col("Date").alias("date")]  # typed feed
    else:
        cols = [F.try_to_date(F.col("Date"), "yyyy-M-d").alias("date")]
    for src, dst in schemas.STAGING_TO_FACT.items():
        c = F.col(src)
        if dst in ("inventory_level", "units_sold", "units_ordered"):
            c = F.coalesce(c, F.lit(0))
        elif dst in ("demand_forecast", "price"):
            c = F.coalesce(c, F.lit(0).cast(schemas.MONEY))
        elif dst == "discount":
            c = F.coalesce(c, F.lit(0).cast(schemas.PERCENT))
        cols.append(c.cast(schemas.INVENTORY[dst].dataType).alias(dst))
    out = staging.select(*cols, *keep)
    return out.filter(
        F.col("date").isNotNull()
        & F.col("store_id").isNotNull()
        & F.col("region").isNotNull()
        & F.col("product_id").isNotNull()
    )


def build_inventory(
    staging: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Daily fact: parse, dedup on (date, store_id, region, product_id), FK filter.

    ``order`` names staging columns giving the load order of duplicate rows;
    default is the input order.  Because the foreign-key columns are part of
    the primary key, all copies of a key pass or fail the FK check together,
    so the check runs after the dedup, on one row per key.  The dimension
    sides are small tables; the planner broadcasts them when their size
    (known from their files once written) is under the broadcast threshold.
    """
    if order is None:
        staging = with_row_order(staging)
        order = [ROW_ORDER]
    parsed = parse_staging(staging, keep=order)
    fact = insert_ignore(parsed, schemas.INVENTORY_KEY, order).drop(*order)
    fact = fact.join(stores.select(*schemas.STORES_KEY), list(schemas.STORES_KEY), "left_semi")
    fact = fact.join(products.select("product_id"), ["product_id"], "left_semi")
    return fact.select(*schemas.INVENTORY.fieldNames())
