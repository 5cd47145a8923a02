"""A GCP billing export and its mapping to the common columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.functions.scalars import AMOUNT


def recent_gcp_lines(
    export: DataFrame, as_of: dt.date, days: int = 30, ordered: bool = True
) -> DataFrame:
    """Nested export rows of the last ``days`` as flat columns, newest first."""
    lines = export.where(F.col("usage_start_time") >= F.date_sub(F.lit(as_of), days)).select(
        "billing_account_id",
        F.col("service.description").alias("service_name"),
        F.col("sku.description").alias("sku_description"),
        F.col("project.id").alias("project_id"),
        "usage_start_time",
        "usage_end_time",
        "cost",
        "currency",
        F.col("usage.amount").alias("usage_amount"),
        F.col("usage.unit").alias("usage_unit"),
    )
    # All columns break ties, so that rows of one hour can be split over tasks.
    ties = [name for name in lines.columns if name != "usage_start_time"]
    return lines.orderBy(F.desc("usage_start_time"), *ties) if ordered else lines


def standard_gcp_lines(lines: DataFrame) -> DataFrame:
    """Add vendor, billing period (the usage day), resource and costs; times as ISO text."""
    cost = F.coalesce(F.col("cost").cast(AMOUNT), F.lit(0).cast(AMOUNT))
    return lines.withColumns(
        {
            "vendor": F.lit("gcp"),
            "billing_period": F.to_date("usage_start_time"),
            "resource_id": F.coalesce("project_id", F.lit("unknown")),
            "effective_cost": cost,
            "billed_cost": cost,
        }
    ).withColumns(
        {
            "usage_start_time": F.date_format("usage_start_time", "yyyy-MM-dd'T'HH:mm:ss"),
            "usage_end_time": F.date_format("usage_end_time", "yyyy-MM-dd'T'HH:mm:ss"),
        }
    )
