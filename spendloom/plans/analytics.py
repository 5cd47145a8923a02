"""The cost questions users ask, over one frame of canonical line items.

Every report is a scan, a partial aggregation and a small final one.  Amount
columns may be text or numbers.  Sums round each line first where the report is
defined that way; pass ``scale=None`` for the exact sum of the stored amounts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.functions.median import exact_median
from spendloom.functions.scalars import amount_of, has_amount, month_start

COST = "line_item_unblended_cost"
BLENDED = "line_item_blended_cost"
USAGE = "line_item_usage_amount"
SERVICE = "product_product_name"
START = "line_item_usage_start_date"


def _summed(lines: DataFrame, name: str, scale: int | None) -> Column:
    return F.sum(amount_of(lines, name, scale))


def monthly_cost(
    lines: DataFrame, month: str = "bill_billing_period_start_date", scale: int | None = 2
) -> DataFrame:
    """Cost per calendar month, oldest first."""
    return (
        lines.where(has_amount(lines, COST))
        .groupBy(month_start(F.col(month)).alias("month"))
        .agg(_summed(lines, COST, scale).alias("total_cost"))
        .orderBy("month")
    )


def top_services(lines: DataFrame, n: int = 10, scale: int | None = 2) -> DataFrame:
    """Services with the highest cost."""
    return (
        lines.where(has_amount(lines, COST) & F.col(SERVICE).isNotNull())
        .groupBy(F.col(SERVICE).alias("service"))
        .agg(_summed(lines, COST, scale).alias("cost"))
        .orderBy(F.desc("cost"), "service")
        .limit(n)
    )


def daily_cost(lines: DataFrame, scale: int | None = 2) -> DataFrame:
    """Cost per day of usage start."""
    return (
        lines.where(has_amount(lines, COST))
        .groupBy(F.to_date(START).alias("date"))
        .agg(_summed(lines, COST, scale).alias("daily_cost"))
        .orderBy("date")
    )


def usage_type_cost(lines: DataFrame, scale: int | None = 2) -> DataFrame:
    """Line items and cost per usage type, positive totals only."""
    return (
        lines.where(has_amount(lines, COST))
        .groupBy(F.col("line_item_usage_type").alias("usage_type"))
        .agg(F.count(F.lit(1)).alias("line_items"), _summed(lines, COST, scale).alias("total_cost"))
        .where(F.col("total_cost") > 0)
        .orderBy(F.desc("total_cost"), "usage_type")
    )


def resource_usage(lines: DataFrame, service: str, scale: int | None = 2) -> DataFrame:
    """Hours and cost of every resource of one service."""
    resource = F.col("line_item_resource_id")
    return (
        lines.where((F.col(SERVICE) == service) & resource.isNotNull())
        .groupBy(resource.alias("resource_id"), F.col("line_item_usage_type").alias("usage_type"))
        .agg(_summed(lines, USAGE, scale).alias("hours"), _summed(lines, COST, scale).alias("cost"))
        .orderBy(F.desc("cost"), "resource_id", "usage_type")
    )


def monthly_cost_by_interval_text(lines: DataFrame, scale: int | None = 3) -> DataFrame:
    """Cost per month, the month read off the time-interval text."""
    return (
        lines.groupBy(F.substring("identity_time_interval", 1, 7).alias("month"))
        .agg(_summed(lines, COST, scale).alias("total_cost"))
        .orderBy("month")
    )


def top_services_at_three_decimals(lines: DataFrame, n: int = 10) -> DataFrame:
    """Top services where a cost is cast to a bare DECIMAL, that is three decimals."""
    return (
        lines.where(has_amount(lines, COST))
        .groupBy(F.col(SERVICE).alias("product_name"))
        .agg(_summed(lines, COST, 3).alias("cost"))
        .orderBy(F.desc("cost"), "product_name")
        .limit(n)
    )


def top_services_blended(lines: DataFrame, n: int = 10) -> DataFrame:
    return (
        lines.groupBy(F.col(SERVICE).alias("service"))
        .agg(_summed(lines, BLENDED, None).alias("total_cost"))
        .orderBy(F.desc("total_cost"), "service")
        .limit(n)
    )


def daily_blended_cost(lines: DataFrame) -> DataFrame:
    return (
        lines.groupBy(F.to_date(START).alias("date"))
        .agg(_summed(lines, BLENDED, None).alias("daily_cost"))
        .orderBy("date")
    )


def cost_by_account(lines: DataFrame, scale: int | None = 2) -> DataFrame:
    return (
        lines.where(has_amount(lines, COST))
        .groupBy(F.col("line_item_usage_account_id").alias("account_id"))
        .agg(F.count(F.lit(1)).alias("line_items"), _summed(lines, COST, scale).alias("cost"))
        .orderBy(F.desc("cost"), "account_id")
    )


# ---- profiles ------------------------------------------------------------------
def dataset_profile(lines: DataFrame) -> DataFrame:
    """Records, distinct services and records with a positive cost."""
    return lines.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(SERVICE).alias("unique_services"),
        F.count_if(amount_of(lines, COST) > 0).alias("cost_records"),
    )


def cost_stats(lines: DataFrame) -> DataFrame:
    """Minimum, maximum, mean and exact median of the positive costs."""
    costs = lines.select(amount_of(lines, COST).alias("cost")).where(F.col("cost") > 0)
    median = exact_median(costs, "cost")
    return costs.agg(
        F.min("cost").alias("min_cost"),
        F.max("cost").alias("max_cost"),
        F.avg("cost").alias("avg_cost"),
        F.lit(median).cast("decimal(38,11)").alias("median_cost"),
    )


def usage_stats(lines: DataFrame) -> DataFrame:
    """Usage range and mean over readable amounts; exact median of the positive ones."""
    usage = lines.where(has_amount(lines, USAGE)).select(amount_of(lines, USAGE).alias("usage"))
    median = exact_median(usage.where(F.col("usage") > 0), "usage")
    return usage.agg(
        F.min("usage").alias("min_usage"),
        F.max("usage").alias("max_usage"),
        F.avg("usage").alias("avg_usage"),
        F.count_if(F.col("usage") > 0).alias("usage_records"),
        F.lit(median).cast("decimal(38,11)").alias("median_usage"),
    )


def services_by_records(lines: DataFrame, n: int = 10) -> DataFrame:
    return (
        lines.where(F.col(SERVICE).isNotNull())
        .groupBy(F.col(SERVICE).alias("service"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .orderBy(F.desc("record_count"), "service")
        .limit(n)
    )


def lines_since(unified: DataFrame, start: str) -> DataFrame:
    """Rows of the unified view with usage at or after ``start``."""
    return unified.where(F.col(START) >= F.lit(start).cast(unified.schema[START].dataType))
