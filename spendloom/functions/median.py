"""Exact median of a column of any size.

Spark's own exact percentile keeps every distinct value of a group in one task's
memory.  Here each pass counts values in at most ``BINS`` equal ranges (a partial
aggregation with a tiny shuffle) and keeps only the range that holds the wanted
rank, until what is left is checked to be small.
"""

from __future__ import annotations

from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 1 << 16
SMALL = 1_000_000


def _running_count(counts: DataFrame, key: str) -> DataFrame:
    """Running count over a frame whose row count is already bounded."""
    return counts.withColumn(
        "upto", F.sum("n").over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    )


def _from_rank(counts: DataFrame, key: str, rank: int) -> list:
    """The row that holds the rank and the one after it."""
    return _running_count(counts, key).where(F.col("upto") >= rank).orderBy(key).take(2)


def _number(value: int, like: T.DataType) -> Column:
    return F.lit(Decimal(value)).cast(like)


def _values_at(
    values: DataFrame, rank: int, low: int, high: int, rows: int, bins: int, small: int
) -> tuple[int, int]:
    """Ticks at the 1-based ranks ``rank`` and ``rank + 1``."""
    kind = values.schema["tick"].dataType
    below = 0

    def between(first: int, last: int) -> DataFrame:
        return values.where(F.col("tick").between(_number(first, kind), _number(last, kind)))

    top = high
    while rows > small and low < high:
        width = -(-(high - low + 1) // bins)
        bin_of = F.call_function("div", F.col("tick") - _number(low, kind), _number(width, kind))
        counts = between(low, high).groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        hit = _from_rank(counts, "bin", rank - below)[0]
        below += hit["upto"] - hit["n"]
        rows = hit["n"]
        low += hit["bin"] * width
        high = min(high, low + width - 1)
    if low == high:
        tick, upto, following = low, below + rows, []
    else:
        counts = between(low, high).groupBy("tick").agg(F.count(F.lit(1)).alias("n"))
        hit, *following = _from_rank(counts, "tick", rank - below)
        tick, upto = int(hit["tick"]), below + hit["upto"]
    if upto > rank or tick == top:
        return tick, tick
    if following:
        return tick, int(following[0]["tick"])
    return tick, int(between(tick + 1, top).agg(F.min("tick")).first()[0])


def exact_median(df: DataFrame, column: str, bins: int = BINS, small: int = SMALL):
    """Median of the non-NULL values of a decimal column (None when there are none)."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.DecimalType):
        raise TypeError(f"{column} must be a decimal column, not {kind.simpleString()}")
    # Whole ticks of the column's own scale; in a long whenever they must fit.
    fits = kind.precision <= 18
    whole = T.LongType() if fits else T.DecimalType(38, 0)
    power = F.lit(10**kind.scale).cast(T.DecimalType(kind.scale + 1, 0))
    exact = F.col(column) if fits else F.col(column).cast(T.DecimalType(38, kind.scale))
    ticks = (exact * power).cast(whole)
    values = df.select(ticks.alias("tick")).where(F.col("tick").isNotNull())
    bounds = values.agg(
        F.min("tick").alias("low"), F.max("tick").alias("high"), F.count(F.lit(1)).alias("n")
    ).first()
    total = bounds["n"]
    if not total:
        return None
    low, high = int(bounds["low"]), int(bounds["high"])
    lower, upper = _values_at(values, (total + 1) // 2, low, high, total, bins, small)
    if total % 2:
        upper = lower
    with localcontext(prec=60):
        return Decimal(lower + upper).scaleb(-kind.scale) / 2
