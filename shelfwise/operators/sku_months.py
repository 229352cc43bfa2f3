"""Counts, sums and the last row per SKU and calendar month.

Every load and append writes these for its own rows; the rows of several parts add up. A trailing
window at any date is the sum of its whole months plus the fact rows of the months it cuts, and the
latest row of a SKU is the last row of its last month, so a question about an earlier date
reads one row per SKU and month instead of the history.
"""

from __future__ import annotations

import calendar
import datetime
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructField, StructType

from .. import schemas
from . import sku_stats

SKU = list(schemas.SKU)
ROW = StructType([f for f in schemas.INVENTORY.fields if f.name not in SKU])
# the sums once each; those of the other windows add up the same values
SUMS = ["s1", "s2", "s_level", "s_price", "s_net_units", "s_net_level", "abc_net_price"]
SAME = {"abc_rev": "s_net_units", "abc_units": "s1", "abc_level": "s_level", "week_level": "s_level",
        "week_net_level": "s_net_level", "week_units": "s1", "day_level": "s_level", "day_net_level": "s_net_level"}
_LONG = ("s1", "s2", "s_level")
SCHEMA = StructType(
    [StructField(c, StringType()) for c in SKU]
    + [StructField("month_key", IntegerType()), StructField("rows", LongType()), StructField("days", LongType())]
    + [StructField("last", ROW)]
    + [StructField(c, LongType() if c in _LONG else DecimalType(38, 10)) for c in SUMS]
)


def sums(rows: DataFrame, month_key: str) -> DataFrame:
    """One row per SKU and month of the fact rows (partial aggregates before the shuffle)."""
    kinds = {f.name: f.dataType for f in SCHEMA.fields}
    measures = sku_stats.measures()
    what = [F.sum(measures[c]).cast(kinds[c]).alias(c) for c in SUMS]
    days = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth("date") - 1)).alias("days")
    last = F.max_by(F.struct(*[F.col(f.name) for f in ROW.fields]), F.col("date")).alias("last")
    grouped = rows.groupBy(*SKU, month_key).agg(F.count(F.lit(1)).alias("rows"), days, last, *what)
    return grouped.select(*[f.name for f in SCHEMA.fields])


def merged(months: DataFrame) -> DataFrame:
    """One row per SKU and month of the rows of several parts."""
    kinds = {f.name: f.dataType for f in SCHEMA.fields}
    total = [F.sum(c).cast(kinds[c]).alias(c) for c in ("rows", *SUMS)]
    last, days = F.max_by("last", F.col("last.date")).alias("last"), F.bit_or("days").alias("days")
    grouped = months.groupBy(*SKU, "month_key").agg(last, days, *total)
    return grouped.select(*[f.name for f in SCHEMA.fields])


def _first(day: datetime.date) -> datetime.date:
    return day.replace(day=1)


def _end(day: datetime.date) -> datetime.date:
    return day.replace(day=calendar.monthrange(day.year, day.month)[1])


def cuts(latest: datetime.date, days: int) -> tuple[tuple[int, int], list[tuple[datetime.date, datetime.date]]]:
    """(first and last whole month of the window as yyyymm, the cut months' days inside it)."""
    start, edges = latest - datetime.timedelta(days=days), []
    low = _first(start)
    if start != low:
        edges.append((start, min(_end(start), latest)))
        low = _end(start) + datetime.timedelta(days=1)
    high = _first(latest)
    if latest != _end(latest):
        if not edges or edges[-1][1] != latest:  # else both ends lie in one month
            edges.append((max(start, high), latest))
        high -= datetime.timedelta(days=1)
    return (low.year * 100 + low.month, high.year * 100 + high.month), edges


def _in_block(days: Column, start: Column) -> Column:
    """A month's day bitmap as seen from the first day of a block of 64 that lies ``start`` days after the month's."""
    up = F.call_function("shiftleft", days, (-start).cast("int"))
    down = F.call_function("shiftrightunsigned", days, start.cast("int"))
    return F.when((start > -64) & (start <= 0), up).when((start > 0) & (start < 64), down).otherwise(F.lit(0).cast("bigint"))


def window_stats(
    months: DataFrame, between: Callable[[Column, Column], DataFrame], latest: datetime.date, windows: Sequence[int],
    month_key: str,
) -> DataFrame:
    """``sku_stats.window_stats`` at ``latest`` from ``months`` and the fact's cut months (``between``)."""
    inside, parts = {}, []
    for count, days in sku_stats.all_windows(windows).items():
        (low, high), edges = cuts(latest, days)
        inside[count] = F.col(month_key).between(low, high)
        for a, b in edges:
            days_of = (F.lit(latest), windows[0]) if count == "n" else None
            parts.append((sku_stats.conditional_sums(between(F.lit(a), F.lit(b)), {count: F.lit(True)}, days_of), 1))
    columns = {c: F.sum(F.when(inside[by], F.col(SAME.get(c, c)))).alias(c) for c, by in sku_stats.COUNTED_BY.items()}
    columns |= {n: F.coalesce(F.sum(F.when(w, F.col("rows"))), F.lit(0)).alias(n) for n, w in inside.items()}
    key = F.col(month_key)
    first_day = F.unix_date(F.make_date(F.floor(key / 100).cast("int"), (key % 100).cast("int"), F.lit(1)))
    block = sku_stats.first_block(F.lit(latest), windows[0])
    bitmaps = []
    for k, c in enumerate(sku_stats.block_columns(windows[0])):
        seen = _in_block(F.col("days"), (block + k) * sku_stats.BLOCK - first_day)
        bitmaps.append(F.bit_or(F.when(inside["n"], seen).otherwise(F.lit(0).cast("bigint"))).alias(c))
    used = months.filter(reduce(lambda a, b: a | b, inside.values()))
    whole = used.groupBy(*SKU).agg(*[columns[c] for c in sku_stats.COLUMNS], *bitmaps)
    like = sku_stats.window_stats(between(F.lit(latest), F.lit(latest)), F.lit(latest), windows)
    return sku_stats.added([(whole, 1), *parts], like, latest, windows[0])
