"""Column-expression helpers shared by every analysis.

All helpers return native Catalyst expressions (no UDFs), so they stay inside
whole-stage codegen.

Numeric policy
--------------
* Money is exact: ``net()`` multiplies decimals only, so sums over any number
  of rows and any partition order give the same value.
* ``rnd()`` rounds half-up.  A double is first snapped to ``decimal(38,10)``
  so that a value printed as ``2.675`` rounds to ``2.68`` whichever engine or
  partial-sum order produced the last bit of it.
* ``div()`` gives NULL on a zero or NULL divisor (the reference's database
  returns NULL for ``x / 0``; Spark under ANSI would raise).
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType

_SNAP = DecimalType(38, 10)
_CENT = Decimal("0.01")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def net(quantity, price="price", discount="discount") -> Column:
    """quantity * price * (1 - discount / 100), as an exact decimal."""
    return col(quantity) * col(price) * (F.lit(1) - col(discount) * F.lit(_CENT))


def rnd(c, scale: int = 2) -> Column:
    """Half-up rounding that gives equal results for equal decimal values."""
    c = col(c)
    return F.round(c.cast(_SNAP), scale)


def rnd_int(c) -> Column:
    """Round to a whole number and type it as bigint."""
    return rnd(c, 0).cast("bigint")


def as_double(c) -> Column:
    return col(c).cast(DoubleType())


def ratio(num, den) -> Column:
    """num / den in double precision, NULL when den is 0 or NULL."""
    return F.try_divide(as_double(num), as_double(den))


def mean(total, count) -> Column:
    """An average from an exact sum and a row count (double)."""
    return ratio(total, count)


def greatest_strict(*cols) -> Column:
    """GREATEST that is NULL as soon as one argument is NULL."""
    cols = [col(c) if not isinstance(c, (int, float, Decimal)) else F.lit(c) for c in cols]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cols])
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cols))


def band(bands, default) -> Column:
    """Ordered CASE: ``bands`` is a list of (condition, label)."""
    expr = None
    for cond, label in bands:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def label_of(c, mapping: dict, default) -> Column:
    """Simple CASE x WHEN k THEN v ... ELSE default."""
    c = col(c)
    return band([(c == k, v) for k, v in mapping.items()], default)


def count_if(cond) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def sum_if(cond, value) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def decimals_to_double(df):
    """Final presentation: exact decimals become doubles for the consumer."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            out.append(F.col(f.name).cast(DoubleType()).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def presentation(df):
    """Report form: decimals as doubles, dates as ISO text (yyyy-MM-dd), so a
    report reads the same through any client (Spark rows, pandas, CSV)."""
    out = []
    for f in decimals_to_double(df).schema.fields:
        if isinstance(f.dataType, DateType):
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        else:
            out.append(F.col(f.name))
    return decimals_to_double(df).select(*out)


def day_bitmaps(offset_col, span_days: int, prefix: str = "_days") -> list[Column]:
    """Aggregates: one bitmap per 64-day block of day offsets in [0, span_days).

    ``offset_col`` is the day number inside the window (computed in a
    projection before the aggregate, e.g. ``datediff(date, start)``).  The
    buffers are primitive longs, so partial aggregation collapses every
    group map-side, and bitmaps of sub-groups merge with ``bit_or``.
    """
    offset = col(offset_col)
    return [
        F.bit_or(
            F.when(
                F.floor(offset / 64) == k,
                F.call_function("shiftleft", F.lit(1).cast("bigint"), (offset % 64).cast("int")),
            ).otherwise(F.lit(0).cast("bigint"))
        ).alias(f"{prefix}{k}")
        for k in range((span_days + 63) // 64)
    ]


def merge_bitmaps(span_days: int, prefix: str = "_days") -> list[Column]:
    """Aggregates merging the bitmaps of ``day_bitmaps`` over a coarser key."""
    return [F.bit_or(f"{prefix}{k}").alias(f"{prefix}{k}") for k in range((span_days + 63) // 64)]


def bitmap_count(span_days: int, prefix: str = "_days") -> Column:
    """Number of days set in the bitmap columns."""
    parts = [F.bit_count(F.col(f"{prefix}{k}")).cast("bigint") for k in range((span_days + 63) // 64)]
    return reduce(lambda a, b: a + b, parts)


def distinct_days(offset_col, span_days: int) -> Column:
    """Exact COUNT(DISTINCT day) in one aggregate (sum of the blocks' bit counts)."""
    parts = [F.bit_count(b).cast("bigint") for b in day_bitmaps(offset_col, span_days)]
    return reduce(lambda a, b: a + b, parts)
