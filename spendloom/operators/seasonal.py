"""Smoothed daily costs with weekly factors, their forecast and their anomalies.

Lines are summed by key and day.  A key's days, one number for each calendar day, are folded in order: the level
and the weekday's factor each take up a part of the day's error.  How far errors usually lie from their median
(median absolute deviation) tells which are out of line, whatever single days did.
An array holds a key's days, thousands at most, never its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.functions.scalars import amount_of

WEEK = 7
LEVEL_PART = 0.25
FACTOR_PART = 0.125
SIGMA = 1.4826  # standard deviations of a normal distribution in one median absolute deviation
_STATE = "struct<level:double,factors:array<double>,told:array<double>>"


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def median_of(values: Column) -> Column:
    """The median of an array of numbers, null when it is empty."""
    ordered, n = F.array_sort(values), F.size(values)
    middle = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return F.when(n > 0, (F.get(ordered, middle[0]) + F.get(ordered, middle[1])) / 2.0)


def _folded(costs: Column) -> Column:
    """The state after all days but the first week, which gives the first level and factors."""
    first = F.slice(costs, 1, WEEK)
    level = F.aggregate(first, F.lit(0.0), lambda a, x: a + x) / float(WEEK)
    start = F.struct(level.alias("level"), F.transform(first, lambda x: x - level).alias("factors"), F.array().cast("array<double>").alias("told")).cast(_STATE)
    # Each day is folded with its place: the weekday's factor is at the place modulo 7.
    days = F.transform(F.slice(costs, WEEK + 1, F.greatest(F.size(costs) - WEEK, F.lit(0))), lambda x, i: F.struct(x.alias("cost"), (i % WEEK).alias("at")))

    def step(state: Column, day: Column) -> Column:
        told = state["level"] + F.get(state["factors"], day["at"])
        error = day["cost"] - told
        factors = F.transform(state["factors"], lambda f, i: F.when(i == day["at"], f + error * FACTOR_PART).otherwise(f))
        return F.struct((state["level"] + error * LEVEL_PART).alias("level"), factors.alias("factors"), F.concat(state["told"], F.array(told)).alias("told")).cast(_STATE)

    return F.aggregate(days, start, step)


def smoothed_days(lines: DataFrame, key: str, cost: str, ts: str) -> DataFrame:
    """(key, first_date, costs, told, level, factors, centre, spread), one row for each key.

    ``costs`` has a number for each day from the key's first to its last one, days without lines are 0;
    ``told`` those foretold from the eighth day on; ``centre`` and ``spread`` are the median error and the
    errors' median absolute deviation.  With fewer than two weeks of days, all from ``told`` on are null.
    Lines without a time have no day and are left out; null costs are 0.
    """
    daily = lines.where(F.col(ts).isNotNull()).groupBy(F.col(key), F.to_date(ts).alias("date")).agg(
        F.coalesce(F.sum(amount_of(lines, cost)).cast("double"), F.lit(0.0)).alias("cost")
    )
    spans = daily.groupBy(key).agg(F.min("date").alias("first"), F.max("date").alias("last"))
    every = spans.select(key, F.explode(F.sequence("first", "last")).alias("date"), F.lit(0.0).alias("cost"))
    dense = daily.unionByName(every).groupBy(key, "date").agg(F.sum("cost").alias("cost"))
    entries = F.array_sort(F.collect_list(F.struct("date", "cost")))
    held = dense.groupBy(key).agg(F.min("date").alias("first_date"), entries.alias("days"))

    def told(costs: Column) -> Column:
        def with_errors(state: Column, errors: Column) -> Column:
            def with_centre(centre: Column) -> Column:
                spread = median_of(F.transform(errors, lambda e: F.abs(e - centre)))
                return F.struct(costs.alias("costs"), state["told"].alias("told"), state["level"].alias("level"), state["factors"].alias("factors"), centre.alias("centre"), spread.alias("spread"))

            return _let(median_of(errors), with_centre)

        def with_state(state: Column) -> Column:
            return _let(F.transform(state["told"], lambda x, i: F.get(costs, i + WEEK) - x), lambda errors: with_errors(state, errors))

        return _let(F.when(F.size(costs) >= 2 * WEEK, _folded(costs)), with_state)

    return held.select(key, "first_date", _let(F.col("days.cost"), told).alias("smooth")).select(key, "first_date", "smooth.*")


def seasonal_forecast(lines: DataFrame, key: str, cost: str, ts: str, days: int = WEEK, sigmas: float = 3.0) -> DataFrame:
    """(key, date, forecast, low, high) of the ``days`` after each key's last one.

    A key with fewer than two weeks of days has one row, of null date and figures.
    """
    smooth = smoothed_days(lines, key, cost, ts)
    n, width = F.size("costs"), F.col("spread") * (sigmas * SIGMA)
    following = F.when(F.col("level").isNotNull(), F.sequence(F.lit(0), F.lit(days - 1)))
    each = smooth.select(key, F.explode_outer(following).alias("ahead"), (n % WEEK).alias("at"), n.alias("n"), "first_date", "level", "factors", width.alias("width"))
    forecast = F.col("level") + F.get("factors", ((F.col("at") + F.col("ahead")) % WEEK).cast("int"))
    return each.select(key, F.date_add("first_date", F.col("n") + F.col("ahead")).alias("date"), forecast.alias("forecast"), (forecast - F.col("width")).alias("low"), (forecast + F.col("width")).alias("high"))


def seasonal_anomalies(lines: DataFrame, key: str, cost: str, ts: str, sigmas: float = 3.0) -> DataFrame:
    """(key, date, cost, expected) of the days whose error lies beyond ``sigmas`` of the key's usual ones."""
    smooth = smoothed_days(lines, key, cost, ts)
    days = F.transform("told", lambda x, i: F.struct(F.date_add("first_date", i + WEEK).alias("date"), F.get("costs", i + WEEK).alias("cost"), x.alias("expected")))
    limit = F.col("spread") * (sigmas * SIGMA)
    # Filtered inside the array: a filter of rows would be pushed down, with the whole fold repeated in it.
    beyond = F.filter(days, lambda d: F.abs(d["cost"] - d["expected"] - F.col("centre")) > limit)
    each = smooth.select(key, F.explode_outer(beyond).alias("day"))
    return each.where("day IS NOT NULL").select(key, "day.*")
