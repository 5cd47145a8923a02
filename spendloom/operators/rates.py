"""Costs in one currency by the rate of their day, or the last one before it.

Rates are published on some days only.  Costs are summed by currency and day, put next to the rates, and the
last rate is carried on, within a month first; what a month ends with is handed to the next ones over one row
for each currency and month.  So a window holds the days of a month or the months of a currency, never a
currency's lines, and no pair of a cost and a rate is formed that isn't used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RATE = "decimal(18,8)"


def rates_as_of(days: DataFrame, rates: DataFrame, oldest: int | None = None) -> DataFrame:
    """Rows (currency, date, ...), one for each currency and day, with ``rate`` and ``rate_date``.

    The rate is the last one of (currency, date, rate) on that day or before; of several of one day the
    largest.  It is null before a currency's first rate and, with ``oldest``, when it is more days old.
    Rows with a null currency or date get none.
    """
    given = rates.where("currency IS NOT NULL AND date IS NOT NULL AND rate IS NOT NULL")
    given = given.groupBy("currency", F.to_date("date").alias("date")).agg(F.max(F.col("rate").cast(RATE)).alias("rate"))
    own = given.select("currency", "date", F.struct("date", "rate").alias("known"))
    asked = days.withColumns({"asked": F.lit(True), "known": F.lit(None).cast(own.schema["known"].dataType)})
    both = asked.unionByName(own, allowMissingColumns=True).withColumn("month", F.trunc("date", "month"))
    ends = both.groupBy("currency", "month").agg(F.max("known").alias("end"))  # the struct's first field is the date
    months = Window.partitionBy("currency").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    opened = ends.select(F.col("currency").alias("_currency"), F.col("month").alias("_month"), F.max("end").over(months).alias("opening"))
    # A rate of the day itself counts for that day.
    inside = Window.partitionBy("currency", "month").orderBy("date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("carried", F.max("known").over(inside)).where("asked")
    joined = carried.join(opened, (F.col("currency") == F.col("_currency")) & (F.col("month") == F.col("_month")), "left")
    found = F.coalesce("carried", "opening")
    if oldest is not None:
        found = F.when(F.datediff("date", found["date"]) <= oldest, found)
    return joined.withColumns({"rate": found["rate"], "rate_date": found["date"]}).drop("asked", "known", "month", "carried", "opening", "_currency", "_month")


def daily_costs_as_of(lines: DataFrame, rates: DataFrame, cost: str, ts: str, to: str = "USD", oldest: int | None = None) -> DataFrame:
    """(currency, date, line_items, cost, rate, rate_date, converted_cost): each day's cost in the currency ``to``."""
    days = lines.groupBy("currency", F.to_date(ts).alias("date")).agg(
        F.count(F.lit(1)).alias("line_items"), F.sum(F.col(cost).cast("decimal(20,6)")).cast("decimal(20,6)").alias("cost")
    )
    dated = rates_as_of(days, rates, oldest)
    rate = F.when(F.col("currency") == to, F.lit(1).cast(RATE)).otherwise(F.col("rate"))
    return dated.withColumn("rate", rate).withColumn("converted_cost", (F.col("cost") * F.col("rate")).cast("decimal(38,10)"))
