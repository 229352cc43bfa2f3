"""Per-SKU statistics over the trailing windows, in one aggregate or carried forward.

``window_stats``: one scan of the longest window and one shuffle (map-side partial sums, one
row per SKU and map task crosses the network); the shorter windows' sums are conditional. Used lazily
by the analyses, and written once per load as a SKU-grain table next to the fact.

The windows, each with a count of its rows: sales (``n``), ABC (``abc_n``), the week of the executive row
(``week_n``) and the latest day alone (``day_n``). All columns but the bitmaps of the sales window's days are counts
and sums, so they can be carried from one latest date to another: ``slide`` adds the rows that
enter the windows and takes away the days that leave them. The bitmaps are kept by blocks of 64 days
counted from a fixed day, so they need no shift, and days that left are masked out.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.expr import count_if, net

SKU = list(schemas.SKU)
SALES_COLS = ["n", "s1", "s2", "s_level", "s_price", "s_net_units", "s_net_level"]
ABC_COLS = ["abc_n", "abc_rev", "abc_units", "abc_net_price", "abc_level"]
WEEK_COLS = ["week_n", "week_level", "week_net_level", "week_units"]
DAY_COLS = ["day_n", "day_level", "day_net_level"]
COUNTS = ("n", "abc_n", "week_n", "day_n")
COLUMNS = [*SALES_COLS, *ABC_COLS, *WEEK_COLS, *DAY_COLS]
# every sum, by the column that counts its rows
COUNTED_BY = {c: cols[0] for cols in (SALES_COLS, ABC_COLS, WEEK_COLS, DAY_COLS) for c in cols[1:]}
BLOCK = 64


def all_windows(windows: Sequence[int]) -> dict[str, int]:
    """Days before the latest date by counting column, of (sales, ABC, week) windows."""
    return dict(zip(COUNTS, (*windows, 0), strict=True))


def block_columns(sales_days: int) -> list[str]:
    """Names of the bitmaps: as many blocks as a window of ``sales_days`` + 1 days can touch."""
    return [f"days{k}" for k in range((sales_days + BLOCK - 1) // BLOCK + 1)]


def first_block(latest: Column, sales_days: int) -> Column:
    return F.floor(F.unix_date(F.date_sub(latest, sales_days)) / BLOCK)


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at.cast("int"))


def day_count(sales_days: int) -> Column:
    """Number of different days in bitmaps merged by ``merged_days``."""
    return reduce(lambda a, b: a + b, [F.bit_count(F.col(c)).cast("bigint") for c in block_columns(sales_days)])


def merged_days(sales_days: int) -> list[Column]:
    return [F.bit_or(c).alias(c) for c in block_columns(sales_days)]


def measures() -> dict[str, Column]:
    """What each summed column adds up, per fact row."""
    u, lvl = F.col("units_sold").cast("bigint"), F.col("inventory_level").cast("bigint")
    return {
        "s1": u,
        "s2": u * u,
        "s_level": lvl,
        "s_price": F.col("price"),
        "s_net_units": net("units_sold"),
        "s_net_level": net("inventory_level"),
        "abc_rev": net("units_sold"),
        "abc_units": u,
        "abc_net_price": net(F.lit(1)),
        "abc_level": lvl,
        "week_level": lvl,
        "week_net_level": net("inventory_level"),
        "week_units": u,
        "day_level": lvl,
        "day_net_level": net("inventory_level"),
    }


def conditional_sums(
    rows: DataFrame, inside: Mapping[str, Column], days_of: tuple[Column, int] | None = None
) -> DataFrame:
    """Counts and sums per SKU, each over the rows inside its window (none where not given).

    ``days_of``, a (latest date, sales days) pair, adds the bitmaps of the days of the rows in the sales window.
    Conditions are projected before the aggregate, so the latest date may be a subquery over a lazy load.
    """
    rows = rows.withColumns({f"_{c}": inside.get(c, F.lit(False)) for c in COUNTS})
    sums = {name: F.sum(F.when(F.col(f"_{COUNTED_BY[name]}"), x)) for name, x in measures().items()}
    columns = {c: count_if(F.col(f"_{c}")) for c in COUNTS} | sums
    bitmaps = []
    if days_of is not None:
        day = F.unix_date("date")
        rows = rows.withColumns({"_block": F.floor(day / BLOCK) - first_block(*days_of), "_bit": _bit(day % BLOCK)})
        for k, name in enumerate(block_columns(days_of[1])):
            here = F.when(F.col("_n") & (F.col("_block") == k), F.col("_bit")).otherwise(F.lit(0).cast("bigint"))
            bitmaps.append(F.bit_or(here).alias(name))
    return rows.groupBy(*SKU).agg(*[columns[c].alias(c) for c in COLUMNS], *bitmaps)


def window_stats(rows: DataFrame, latest: Column, windows: Sequence[int]) -> DataFrame:
    """``rows`` must already be restricted to the longest trailing window."""
    inside = {c: F.col("date") >= F.date_sub(latest, days) for c, days in all_windows(windows).items()}
    return conditional_sums(rows, inside, (latest, windows[0]))


def added(parts: Sequence[tuple[DataFrame, int]], like: DataFrame, latest: datetime.date, sales_days: int) -> DataFrame:
    """Signed sum of several statistics tables, as one aggregate of them all would have it.

    A SKU without rows in a window has null sums there, and one without rows in any no row.
    ``like`` gives the column types (sums of decimals widen with each aggregate). Bitmaps, for blocks of
    the window that ends with ``latest``, are merged where a table has them and cut to the window.
    """
    blocks = block_columns(sales_days)
    kinds = {f.name: f.dataType for f in like.schema.fields}

    def signed(t: DataFrame, sign: int) -> DataFrame:
        values = [(F.col(c) if sign > 0 else -F.col(c)).cast(kinds[c]).alias(c) for c in COLUMNS]
        days = [(F.col(c) if c in t.columns else F.lit(0).cast("bigint")).alias(c) for c in blocks]
        return t.select(*SKU, *values, *days)

    rows = reduce(DataFrame.unionByName, [signed(t, sign) for t, sign in parts])
    sums = [F.sum(c).cast(kinds[c]).alias(c) for c in COLUMNS]
    total = rows.groupBy(*SKU).agg(*sums, *[F.bit_or(c).alias(c) for c in blocks])
    shown = [F.when(F.col(COUNTED_BY[c]) > 0, F.col(c)).alias(c) if c in COUNTED_BY else F.col(c) for c in COLUMNS]
    epoch = datetime.date(1970, 1, 1)
    start, end = (latest - epoch).days - sales_days, (latest - epoch).days
    cut = []
    for k, c in enumerate(blocks):
        low = (start // BLOCK + k) * BLOCK
        mask = sum(1 << (d - low) for d in range(max(start, low), min(end, low + BLOCK - 1) + 1))
        cut.append(F.col(c).bitwiseAND(F.lit(mask - (1 << 64) if mask >= 1 << 63 else mask).cast("bigint")).alias(c))
    return total.filter((F.col("n") > 0) | (F.col("abc_n") > 0)).select(*SKU, *shown, *cut)


def slide(
    stats: DataFrame, between: Callable[[Column, Column], DataFrame], entering: DataFrame,
    before: datetime.date, after: datetime.date, windows: Sequence[int],
) -> DataFrame:
    """``stats`` of the windows that end with ``before``, moved to ``after`` with the rows ``entering`` the fact.

    ``between(start, end)`` reads the fact as it was. Of it only the days are read that leave a
    window: none when the latest date stays, one day per window when it moves by one. The columns of the
    old latest day are dropped unread, since all of it leaves.
    """
    longest = entering.filter(F.col("date") >= F.date_sub(F.lit(after), max(windows)))
    new = window_stats(longest, F.lit(after), windows)
    moved = (after - before).days
    blocks = block_columns(windows[0])
    epoch = datetime.date(1970, 1, 1)
    first, then = (((d - epoch).days - windows[0]) // BLOCK for d in (before, after))
    kept = {c: F.col(f"days{k + then - first}") if k + then - first < len(blocks) else F.lit(0).cast("bigint") for k, c in enumerate(blocks)}
    old = stats.select(*SKU, *COLUMNS, *[x.alias(c) for c, x in kept.items()])
    parts = [(new, 1)]
    if moved > 0:
        old = old.withColumns({c: F.lit(0).cast(stats.schema[c].dataType) for c in DAY_COLS})
        for count, days in all_windows(windows).items():
            if days:
                start = before - datetime.timedelta(days=days)
                end = min(before, start + datetime.timedelta(days=moved - 1))
                parts.append((conditional_sums(between(F.lit(start), F.lit(end)), {count: F.lit(True)}), -1))
    return added([(old, 1), *parts], stats, after, windows[0])
