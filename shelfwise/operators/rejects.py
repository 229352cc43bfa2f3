"""What a load turns away or fills in, counted in the pass that writes the staging rows.

One line per rule and column: rows without a usable date, without a part of the key, values longer
than the model allows, missing measures that become 0, rows without a parent, duplicates of a key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from .. import schemas
from ..functions.expr import count_if

LOG_SCHEMA = StructType(
    [StructField("reason", StringType()), StructField("column_name", StringType()), StructField("rows", LongType())]
)
KEY_COLUMNS = ("Store_ID", "Region", "Product_ID")
MEASURES = ("Inventory_Level", "Units_Sold", "Units_Ordered", "Demand_Forecast", "Price", "Discount")


def _usable_date(staging: DataFrame) -> Column:
    date = F.col("Date")
    typed = isinstance(staging.schema["Date"].dataType, DateType)
    return date.isNotNull() if typed else F.try_to_date(date, "yyyy-M-d").isNotNull()


def _rules(staging: DataFrame) -> dict[tuple[str, str], Column]:
    dated = _usable_date(staging)
    keyed = F.lit(True)
    for c in KEY_COLUMNS:
        keyed = keyed & F.col(c).isNotNull()
    return {
        ("staged", ""): F.lit(True),
        ("loadable", ""): dated & keyed,
        ("undated", "Date"): ~dated,
        **{("keyless", c): F.col(c).isNull() for c in KEY_COLUMNS},
        **{("over_long", c): F.length(F.col(c).cast("string")) > n for c, n in schemas.TEXT_LIMITS.items()},
        # only rows that are loaded get a default
        **{("defaulted", c): dated & keyed & F.col(c).isNull() for c in MEASURES},
    }


def counters(staging: DataFrame) -> list[Column]:
    """One count per rule, for ``DataFrame.observe`` or an aggregate over the staging rows."""
    return [count_if(F.coalesce(c, F.lit(False))).alias(f"{r}:{col}") for (r, col), c in _rules(staging).items()]


def orphan_rows(violations: DataFrame) -> dict[str, int]:
    """Rows without a parent by referenced table, from ``integrity.fk_violations`` over the loadable rows."""
    return {r["referenced_table"]: r["violating_rows"] for r in violations.collect()}


def lines(counts: Mapping[str, int], orphans: Mapping[str, int], accepted: int) -> list[tuple[str, str, int]]:
    """The log of one load. ``skipped`` are the loadable rows that were not stored: an earlier row has
    their key, or they have no parent row (``orphan``; a row can lack both parents)."""
    found = [(*k.split(":", 1), int(v or 0)) for k, v in counts.items()]
    loadable = int(counts["loadable:"] or 0)
    found += [("orphan", t, int(n)) for t, n in sorted(orphans.items())]
    return [*found, ("accepted", "", accepted), ("skipped", "", loadable - accepted)]


def load_rejects(log: DataFrame) -> DataFrame:
    """(reason, column_name, rows) over all loads of a warehouse."""
    return log.groupBy("reason", "column_name").agg(F.sum("rows").alias("rows"))
