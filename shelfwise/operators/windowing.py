"""Reusable window-style operators: latest row per key, quartiles, running share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# parts into which the order of one group is cut, so that no group is one task
PARTS = 32


def latest_per_key(df: DataFrame, key: Sequence[str], time_col: str = "date") -> DataFrame:
    """The row with the greatest ``time_col`` for every key.

    Planned as partial WindowGroupLimit (top-1 per key inside each map task)
    -> shuffle on key -> final top-1: only one row per key and task crosses
    the network, however many rows a key has.  (key, time) must be unique,
    as the fact's primary key guarantees, for the result to be deterministic.
    """
    w = Window.partitionBy(*key).orderBy(F.col(time_col).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def ntile_from_rank(rank, size, n: int = 4) -> Column:
    """NTILE(n) from a 1-based rank and the group size, without a window.

    Standard NTILE: the first (size mod n) tiles hold one row more.
    """
    rank, size = F.col(rank) if isinstance(rank, str) else rank, F.col(size) if isinstance(size, str) else size
    q = F.floor(size / n)
    r = size % n
    big = r * (q + 1)
    return (
        F.when(rank <= big, F.ceil(rank / (q + 1)))
        .otherwise(r + F.ceil(F.try_divide(rank - big, q)))
        .cast("int")
    )


def descending(value: Column | str) -> list[Column]:
    """Ascending sort keys that put the greatest ``value`` first and nulls last."""
    v = F.col(value) if isinstance(value, str) else value
    return [v.isNull(), -v]


def cut_groups(df: DataFrame, group: Sequence[str], order: Sequence[Column], **totals: Column) -> DataFrame:
    """Add ``_order`` (the sort keys), ``_part`` (0..PARTS, increasing in ``_order``) and group totals.

    A window partitioned by a low-cardinality key (a category holding a third
    of all SKUs) would put the whole group into one task.  Here each group's
    order is cut at up to PARTS of its own keys: rows fall into PARTS classes
    by hash and each class names the key with its smallest second hash.  The
    cuts depend on the rows alone, so every use of the plan finds the same
    ones; they are whole sort keys, so rows with equal values are split too.
    ``totals`` are sums or counts per group, found in the same pass.

    ``order`` are ascending keys, nulls first, unique in a group; group
    columns are not null.  Rows look their cuts up by (group, class): a hot
    group spreads over PARTS tasks, and the cuts are a few rows per group.
    """
    keyed = df.withColumn("_order", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]))
    keyed = keyed.withColumn("_class", F.pmod(F.xxhash64("_order"), F.lit(PARTS)).cast("int"))
    picks = keyed.groupBy(*group, "_class").agg(
        F.min_by("_order", F.xxhash64("_order", F.lit(PARTS))).alias("_cut"), *[c.alias(k) for k, c in totals.items()]
    )
    cuts = picks.groupBy(*group).agg(
        F.array_sort(F.collect_list("_cut")).alias("_cuts"), *[F.sum(k).alias(k) for k in totals]
    )
    cuts = cuts.withColumn("_class", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    part = F.size(F.filter("_cuts", lambda c: c < F.col("_order")))
    return keyed.join(cuts, [*group, "_class"]).withColumn("_part", part).drop("_cuts", "_class")


def range_parts(df: DataFrame, group: Sequence[str], order: Sequence[Column], path: str, **totals: Column) -> DataFrame:
    """As ``cut_groups``, for rows that are written once: the parts are ranges of one sorted table.

    Spark deals the rows by ranges of (group, order) whose bounds it samples, as many as the session has
    shuffle partitions, merged by adaptive execution to its advisory size; so the number of parts
    follows the data and a large group spans many. The rows are written to ``path`` with the number
    of their range, which makes the parts the same for every later reader. Totals per group are added
    up from one row per group and part.
    """
    keyed = df.withColumn("_order", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]))
    placed = keyed.repartitionByRange(*group, "_order").withColumn("_part", F.spark_partition_id())
    placed.write.mode("overwrite").parquet(path)
    rows = df.sparkSession.read.schema(placed.schema).parquet(path)
    if not totals:
        return rows
    whole = Window.partitionBy(*group)
    per_part = rows.groupBy(*group, "_part").agg(*[c.alias(k) for k, c in totals.items()])
    sums = per_part.select(*group, "_part", *[F.sum(k).over(whole).alias(k) for k in totals])
    return rows.join(sums, [*group, "_part"])


def part_offsets(cut: DataFrame, group: Sequence[str], **sums: Column) -> DataFrame:
    """(group, _part, one column per sum): each sum over the earlier parts of the group.

    The window runs over one row per part of a group.
    """
    per_part = cut.groupBy(*group, "_part").agg(*[c.alias(k) for k, c in sums.items()])
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(*group, "_part", *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(k) for k in sums])


def within_part(group: Sequence[str]):
    """Window over one part of a group in the cut order."""
    return Window.partitionBy(*group, "_part").orderBy("_order")


def group_rank(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], rank_col: str = "_rank", size_col: str = "_size",
    parts: Callable[..., DataFrame] = cut_groups,
) -> DataFrame:
    """1-based rank inside ``group`` under ``order`` and the group's size.

    Rows are numbered inside a part (``parts``: ``cut_groups``, which is lazy, or ``range_parts``
    with its path), the rows of earlier parts are added.
    """
    cut = parts(df, group, order, **{size_col: F.count(F.lit(1))})
    before = part_offsets(cut, group, _before=F.count(F.lit(1)))
    out = cut.withColumn("_row", F.row_number().over(within_part(group))).join(before, [*group, "_part"])
    return out.withColumn(rank_col, F.col("_before") + F.col("_row")).drop("_part", "_order", "_row", "_before")


def ntile_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], out_col: str, n: int = 4,
    parts: Callable[..., DataFrame] = cut_groups,
) -> DataFrame:
    """Add NTILE(n) over (PARTITION BY group ORDER BY order) as ``out_col``."""
    ranked = group_rank(df, group, order, parts=parts)
    return ranked.withColumn(out_col, ntile_from_rank("_rank", "_size", n)).drop("_rank", "_size")


def share_of_total(value, total, scale: int = 2) -> Column:
    """100 * value / total, rounded half-up (decimal)."""
    from ..functions.expr import ratio, rnd

    return rnd(ratio(value, total) * 100, scale)


def pareto_class(cumulative, cutoffs=(80, 95), labels=("A", "B", "C")) -> Column:
    """ABC class from an inclusive cumulative share: <= first cut-off the
    first label, <= second the second, else the last."""
    from ..functions.expr import band

    c = F.col(cumulative) if isinstance(cumulative, str) else cumulative
    return band([(c <= cut, lab) for cut, lab in zip(cutoffs, labels)], labels[-1])
