"""How much of the use of a service its commitments cover, by sweeping over time.

Use and commitments are intervals with an amount.  At each moment the covered amount is the smaller of the
two sums, which no join of single intervals gives.  Each interval becomes a signed amount at its start and
at its end; in order of time, running sums give both levels, and a level lasts until the next moment.

Intervals are cut at the bounds of days first.  A day's moments are then a window of their own, whatever the
length of the intervals, and amounts of one moment are summed before they are sorted, so a key that holds most of
the rows has at most a row for each second of a day in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

AMOUNT = "decimal(28,6)"
HOURS = "decimal(38,6)"
_DAY = "INTERVAL '1' DAY"


def _moments(intervals: DataFrame, key: str, level: str) -> DataFrame:
    """(key, day, at, amount): the signed amounts of intervals (key, start, end, amount), cut at days."""
    sound = intervals.where("start < end AND amount IS NOT NULL").select(F.col(key).alias("key"), "start", "end", F.col("amount").cast(AMOUNT).alias("amount"))
    first, last = F.date_trunc("day", "start"), F.date_trunc("day", F.col("end") - F.expr("INTERVAL '1' MICROSECOND"))
    days = sound.withColumn("day", F.explode(F.sequence(first, last, F.expr(_DAY))))
    signs = F.array(
        F.struct(F.greatest("start", "day").alias("at"), F.col("amount").alias("amount")),
        F.struct(F.least("end", F.col("day") + F.expr(_DAY)).alias("at"), (-F.col("amount")).alias("amount")),
    )
    moved = days.select("key", "day", F.explode(signs).alias("step")).select("key", "day", "step.at", F.col("step.amount").alias(level))
    return moved.withColumn("committed" if level == "used" else "used", F.lit(0).cast(AMOUNT))


def commitment_coverage(use: DataFrame, commitments: DataFrame, key: str) -> DataFrame:
    """(key, date, used_hours, committed_hours, covered_hours) for each key and day with either.

    Both inputs are intervals (key, start, end, amount), the end not included.  Intervals without a length or
    an amount, or with a null bound, count for nothing; a null key is a key of its own.
    """
    both = _moments(use, key, "used").unionByName(_moments(commitments, key, "committed"))
    moments = both.groupBy("key", "day", "at").agg(F.sum("used").alias("used"), F.sum("committed").alias("committed"))
    inside = Window.partitionBy("key", "day").orderBy("at")
    levels = moments.select(
        "key",
        "day",
        F.sum("used").over(inside).alias("used"),
        F.sum("committed").over(inside).alias("committed"),
        (F.unix_micros(F.lead("at").over(inside)) - F.unix_micros("at")).alias("lasting"),
    )
    lasting = F.col("lasting").cast("decimal(18,0)")

    def hours(level) -> F.Column:
        return (F.sum(level.cast("decimal(20,6)") * lasting) / F.lit(3_600_000_000)).cast(HOURS)

    return levels.groupBy(F.col("key").alias(key), F.to_date("day").alias("date")).agg(
        F.coalesce(hours(F.col("used")), F.lit(0)).alias("used_hours"),
        F.coalesce(hours(F.col("committed")), F.lit(0)).alias("committed_hours"),
        F.coalesce(hours(F.least("used", "committed")), F.lit(0)).alias("covered_hours"),
    )
