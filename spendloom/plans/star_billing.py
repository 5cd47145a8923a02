"""Billing-shaped views of the star-schema test tables.

``billing_lines`` joins a dimension only when a requested column needs it, so a
report that reads three line-item columns scans just those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.functions.scalars import billing_period, month_start

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _line_type():
    flag = F.col("l_returnflag")
    return (
        F.when(flag == "N", "Usage").when(flag == "A", "DiscountedUsage").when(flag == "R", "Refund")
    )


def _unblended():
    price = F.col("l_extendedprice")
    return F.when(F.col("l_returnflag") == "R", -price).otherwise(price).cast("decimal(12,2)")


def _scaled(column: str, sign: int):
    share = F.col(column).cast("decimal(4,2)")
    factor = F.lit(1).cast("decimal(4,2)") + share * sign
    return (_unblended() * factor.cast("decimal(6,2)")).cast("decimal(20,4)")


# canonical column -> (expression, dimension it needs)
_COLUMNS = {
    "billing_period": (lambda: billing_period(F.col("l_shipdate")), None),
    "bill_billing_period_start_date": (lambda: month_start(F.col("l_shipdate")), None),
    "identity_time_interval": (
        lambda: F.concat(
            F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            F.lit("/"),
            F.date_format(F.date_add(F.to_date("l_shipdate"), 1), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        ),
        None,
    ),
    "line_item_usage_start_date": (lambda: F.col("l_shipdate"), None),
    "line_item_usage_end_date": (
        lambda: F.col("l_shipdate") + F.expr("INTERVAL '1' DAY"),
        None,
    ),
    "line_item_line_item_type": (_line_type, None),
    "line_item_resource_id": (
        lambda: F.concat(F.lit("part-"), F.col("l_partkey").cast("string")),
        None,
    ),
    "line_item_usage_amount": (lambda: F.col("l_quantity").cast("decimal(12,2)"), None),
    "line_item_unblended_cost": (_unblended, None),
    "line_item_net_unblended_cost": (lambda: _scaled("l_discount", -1), None),
    "line_item_blended_cost": (lambda: _scaled("l_tax", 1), None),
    "pricing_unit": (lambda: F.lit("Hrs"), None),
    "line_item_usage_account_id": (lambda: F.col("o_custkey").cast("string"), "orders"),
    "line_item_product_code": (lambda: F.col("p_type"), "part"),
    "product_product_name": (lambda: F.col("p_type"), "part"),
    "line_item_usage_type": (lambda: F.col("p_brand"), "part"),
    "product_region": (lambda: F.col("n_name"), "nation"),
}
BILLING_COLUMNS = tuple(_COLUMNS)


def billing_lines(
    spark: SparkSession, folder: str, columns: Sequence[str] = BILLING_COLUMNS
) -> DataFrame:
    """One billing line per ``lineitem`` row, with the requested canonical columns."""
    needs = {_COLUMNS[c][1] for c in columns}
    lines = table(spark, folder, "lineitem")
    if "orders" in needs:
        orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
        lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")
    if "part" in needs:
        part = table(spark, folder, "part").select("p_partkey", "p_type", "p_brand")
        lines = lines.join(part, lines.l_partkey == part.p_partkey, "left")
    if "nation" in needs:
        nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
        supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
        home = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
        lines = lines.join(
            home.select("s_suppkey", "n_name"), lines.l_suppkey == F.col("s_suppkey"), "left"
        )
    return lines.select(*[_COLUMNS[c][0]().alias(c) for c in columns])
