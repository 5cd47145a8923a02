"""Allocation, currencies, marts, reconciliation, budgets, anomalies and forecasts.

Lines are summed to a few rows per period first; windows and joins run on those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendloom.functions.scalars import AMOUNT, TAGS, amount_of

UNALLOCATED = "unallocated"


# ---- allocation to owners --------------------------------------------------------
def _owner_costs(lines: DataFrame, owner: str, cost: str, period: str) -> DataFrame:
    owned = F.when(F.col(owner) != "", F.col(owner))
    return lines.groupBy(F.col(period).alias("billing_period"), owned.alias("owner")).agg(
        F.sum(amount_of(lines, cost)).cast(AMOUNT).alias("cost")
    )


def allocate_direct(
    lines: DataFrame, owner: str, cost: str, period: str = "billing_period"
) -> DataFrame:
    """Cost per owner tag; lines without one are ``unallocated``."""
    return _owner_costs(lines, owner, cost, period).select(
        "billing_period", F.coalesce("owner", F.lit(UNALLOCATED)).alias("owner"), "cost"
    )


def allocate_proportional(
    lines: DataFrame, owner: str, cost: str, period: str = "billing_period"
) -> DataFrame:
    """Each owner's own cost plus their share of the period's unowned cost.

    A period without owned cost keeps its unowned cost as ``unallocated``.
    """
    by_owner = _owner_costs(lines, owner, cost, period)
    owned = F.col("owner").isNotNull()
    totals = by_owner.groupBy("billing_period").agg(
        F.coalesce(F.sum(F.when(owned, F.col("cost"))), F.lit(0)).cast(AMOUNT).alias("owned_total"),
        F.coalesce(F.sum(F.when(~owned, F.col("cost"))), F.lit(0)).cast(AMOUNT).alias("shared_total"),
    )
    total, shared = F.col("owned_total"), F.col("shared_total")
    share = (F.col("cost").cast("double") / F.nullif(total, F.lit(0)).cast("double")) * shared.cast(
        "double"
    )
    return (
        by_owner.join(totals, "billing_period")
        .where(owned | (total == 0))
        .select(
            "billing_period",
            F.coalesce("owner", F.lit(UNALLOCATED)).alias("owner"),
            F.col("cost").alias("own_cost"),
            F.when(owned, F.coalesce(share, F.lit(0.0))).otherwise(0.0).alias("shared_cost"),
        )
        .withColumn("allocated_cost", F.col("own_cost").cast("double") + F.col("shared_cost"))
    )


def allocate_by_weights(
    lines: DataFrame, weights: DataFrame, cost: str, period: str = "billing_period"
) -> DataFrame:
    """The whole cost of each period split by weights (billing_period, owner, weight).

    A period without weights stays whole as ``unallocated``.
    """
    totals = lines.groupBy(F.col(period).alias("billing_period")).agg(
        F.sum(amount_of(lines, cost)).cast(AMOUNT).alias("period_cost")
    )
    per_owner = weights.groupBy("billing_period", "owner").agg(F.sum("weight").alias("weight"))
    all_weight = per_owner.groupBy("billing_period").agg(F.sum("weight").alias("all_weight"))
    whole = F.col("period_cost").cast("double")
    part = F.col("weight").cast("double") / F.nullif(F.col("all_weight"), F.lit(0)).cast("double")
    return (
        totals.join(per_owner, "billing_period", "left")
        .join(all_weight, "billing_period", "left")
        .select(
            "billing_period",
            F.coalesce("owner", F.lit(UNALLOCATED)).alias("owner"),
            F.when(F.col("owner").isNull(), whole).otherwise(whole * part).alias("allocated_cost"),
        )
    )


# ---- tags ------------------------------------------------------------------------
def inherited_tags(resource_tags: Column, account_tags: Column) -> Column:
    """The account's tags, overridden by the resource's own."""
    none = F.create_map().cast(TAGS)
    own = F.coalesce(resource_tags, none)
    handed_down = F.map_filter(
        F.coalesce(account_tags, none), lambda key, _: ~F.map_contains_key(own, key)
    )
    return F.map_concat(handed_down, own)


def normalised_tags(tags: Column) -> Column:
    """Tag names trimmed and lower-cased; of names that become equal the first in order stays."""
    entries = F.transform(
        F.array_sort(F.map_entries(tags)),
        lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value")),
    )
    first = F.filter(
        entries, lambda e, i: ~F.exists(F.slice(entries, 1, i), lambda other: other["key"] == e["key"])
    )
    return F.map_from_entries(first)


# ---- currencies ------------------------------------------------------------------
def in_currency(
    lines: DataFrame, rates: DataFrame, cost: str, to: str = "USD", scale: int | None = 6
) -> DataFrame:
    """Add ``converted_cost`` by (currency, billing_period) rates; NULL without a rate.

    The whole cost is multiplied; the result of each line is rounded to ``scale`` decimals.  Totals
    are to be built with ``scale=None``, which keeps eleven decimals, more than any loaded cost has.
    """
    unique = rates.groupBy(
        F.col("currency").alias("_currency"), F.col("billing_period").alias("_period")
    ).agg(F.max("rate").alias("_rate"))
    on = (lines["currency"] == F.col("_currency")) & (lines["billing_period"] == F.col("_period"))
    rate = F.when(F.col("currency") == to, F.lit(1).cast("decimal(18,8)")).otherwise(
        F.col("_rate").cast("decimal(18,8)")
    )
    # Two digits less than an amount: the product then keeps eleven decimals.
    value = amount_of(lines, cost).cast("decimal(26,10)") * rate
    result = value if scale is None else F.round(value, scale).cast(f"decimal(28,{scale})")
    return (
        lines.join(unique, on, "left")
        .withColumn("converted_cost", result)
        .drop("_currency", "_period", "_rate")
    )


# ---- marts -----------------------------------------------------------------------
MART_KEYS = ("billing_period", "service_name", "account_id", "charge_category")


def monthly_mart(unified: DataFrame, source_columns: tuple[str, ...] = ()) -> DataFrame:
    """Summary per period, service, account and charge category (and kept source columns)."""
    return unified.groupBy(*MART_KEYS, *source_columns).agg(
        F.count(F.lit(1)).alias("line_items"),
        F.sum(amount_of(unified, "usage_quantity")).alias("usage_quantity"),
        F.sum(amount_of(unified, "billed_cost")).alias("billed_cost"),
        F.sum(amount_of(unified, "effective_cost")).alias("effective_cost"),
    )


def write_mart(mart: DataFrame, path: str) -> None:
    """Write a mart partitioned by month.

    Range partitions keep a small month in one file and split a large one.
    """
    ranged = mart.repartitionByRange("billing_period", "service_name", "account_id")
    ranged.write.partitionBy("billing_period").mode("errorifexists").parquet(path)


def reconciliation(raw: DataFrame, focus: DataFrame, raw_cost: str, focus_cost: str) -> DataFrame:
    """Raw and mapped totals per period side by side, and their difference."""
    left = raw.groupBy("billing_period").agg(
        F.count(F.lit(1)).alias("raw_rows"), F.sum(amount_of(raw, raw_cost)).alias("raw_cost")
    )
    right = focus.groupBy("billing_period").agg(
        F.count(F.lit(1)).alias("focus_rows"), F.sum(amount_of(focus, focus_cost)).alias("focus_cost")
    )
    zero = F.lit(0)
    joined = left.join(right, "billing_period", "full_outer").select(
        "billing_period",
        F.coalesce("raw_rows", zero.cast("long")).alias("raw_rows"),
        F.coalesce("focus_rows", zero.cast("long")).alias("focus_rows"),
        F.coalesce(F.col("raw_cost").cast(AMOUNT), zero.cast(AMOUNT)).alias("raw_cost"),
        F.coalesce(F.col("focus_cost").cast(AMOUNT), zero.cast(AMOUNT)).alias("focus_cost"),
    )
    difference = (F.col("focus_cost") - F.col("raw_cost")).alias("difference")
    agrees = (F.col("raw_rows") == F.col("focus_rows")) & (F.col("raw_cost") == F.col("focus_cost"))
    return joined.select("*", difference, agrees.alias("reconciled"))


def _share(cost: Column, total: Column) -> Column:
    return cost.cast("double") / F.nullif(total, F.lit(0)).cast("double")


def chargeback(lines: DataFrame, cost_centre: Column, cost: str) -> DataFrame:
    """Cost per cost centre and period with its share of the period (showback)."""
    centre = F.when(cost_centre != "", cost_centre)
    costs = lines.groupBy(
        "billing_period", F.coalesce(centre, F.lit(UNALLOCATED)).alias("cost_centre")
    ).agg(F.sum(amount_of(lines, cost)).cast(AMOUNT).alias("cost"))
    # Summed again from the same exchange; a period may have any number of centres.
    totals = costs.groupBy("billing_period").agg(F.sum("cost").cast(AMOUNT).alias("_total"))
    share = _share(F.col("cost"), F.col("_total"))
    return costs.join(totals, "billing_period").withColumn("share", share).drop("_total")


def commitment_share(lines: DataFrame, commitment: Column, cost: str) -> DataFrame:
    """Cost per commitment category and period with its share of the period."""
    costs = lines.groupBy("billing_period", commitment.alias("commitment")).agg(
        F.count(F.lit(1)).alias("line_items"), F.sum(amount_of(lines, cost)).cast(AMOUNT).alias("cost")
    )
    # A window over a handful of categories per period.
    total = F.sum("cost").over(Window.partitionBy("billing_period"))
    return costs.withColumn("share", _share(F.col("cost"), total))


# ---- budgets, anomalies, forecasts -------------------------------------------------
def budget_breaches(
    lines: DataFrame, budgets: DataFrame, key: str, cost: str, alert_at: float = 1.0
) -> DataFrame:
    """Periods in which a key's cost reached ``alert_at`` of its budget (key, budget)."""
    spent = lines.groupBy("billing_period", key).agg(
        F.sum(amount_of(lines, cost)).cast(AMOUNT).alias("cost")
    )
    limits = budgets.groupBy(key).agg(F.min("budget").cast(AMOUNT).alias("budget"))
    return (
        spent.join(limits, key)
        .where(F.col("cost") >= F.col("budget") * F.lit(alert_at).cast("decimal(6,4)"))
        .select("billing_period", key, "cost", "budget")
    )


def daily_anomalies(
    lines: DataFrame, key: str, cost: str, ts: str, days: int = 30, sigmas: float = 3.0
) -> DataFrame:
    """Days whose cost lies beyond ``sigmas`` of the key's previous ``days`` cost days.

    The window runs over one row per key and day, not over the lines.
    """
    daily = lines.groupBy(F.col(key), F.to_date(ts).alias("date")).agg(
        F.sum(amount_of(lines, cost)).cast("double").alias("cost")
    )
    before = Window.partitionBy(key).orderBy("date").rowsBetween(-days, -1)
    scored = daily.select(
        "*",
        F.count("cost").over(before).alias("seen"),
        F.avg("cost").over(before).alias("mean"),
        F.stddev_samp("cost").over(before).alias("deviation"),
    )
    beyond = F.abs(F.col("cost") - F.col("mean")) > F.col("deviation") * sigmas
    return scored.where((F.col("seen") == days) & (F.col("deviation") > 0) & beyond)


def cost_forecast(lines: DataFrame, key: str, cost: str, ts: str) -> DataFrame:
    """Linear trend of each key's monthly cost and its value for the month after the last."""
    # Months since January 2000: small numbers keep the regression exact.
    month = (F.year(ts) - 2000) * 12 + F.month(ts)
    monthly = lines.groupBy(F.col(key), month.cast("long").alias("month_no")).agg(
        F.sum(amount_of(lines, cost)).cast("double").alias("cost")
    )
    return (
        monthly.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("months"),
            F.max("month_no").alias("last_month"),
            F.regr_slope("cost", "month_no").alias("slope"),
            F.regr_intercept("cost", "month_no").alias("intercept"),
        )
        .withColumn("next_cost", F.col("intercept") + F.col("slope") * (F.col("last_month") + 1))
    )
