"""Registered queries: reports of both formats with drifting columns, their types and their headers.

Reports are written from the orders and line items, so they are as large as the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.functions.fixed_values import REQUIRED_REPORT_COLUMNS
from spendloom.operators import quality
from spendloom.operators.lake import BillingLake
from spendloom.plans.imports import import_export
from spendloom.plans.lake_queries import _raw_lines
from spendloom.plans.registry import query
from spendloom.plans.star_billing import table
from spendloom.session import scratch_folder
from spendloom.sources.inference import column_states, inferred_types, merged_states
from spendloom.sources.reports import csv_headers

# ---- inferred types -------------------------------------------------------------------
# Years of orders: odd ones are CSV, even ones Parquet with declared types.


def _drifting_orders(spark, folder):
    """Orders as text under columns that hold more kinds of values from year to year."""
    year, price, customer = F.year("o_orderdate"), F.col("o_totalprice"), F.col("o_custkey").cast("string")
    return table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy").alias("billing_period"),
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.when(year < 1995, F.floor(price).cast("string")).otherwise(price.cast("decimal(12,2)").cast("string")).alias("amount"),
        F.when(year < 1996, customer).otherwise(F.lpad(customer, 9, "0")).alias("code"),
        F.when(year < 1997, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("placed"),
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("false").alias("done"),
        F.when(year > 1993, F.col("o_orderpriority")).alias("note"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.floor(price).cast("string"), F.lit("e-3")))
        .otherwise((F.col("o_custkey") % 100).cast("string"))
        .alias("ratio"),
    )


DECLARED = {"order_key": "bigint", "amount": "decimal(14,3)", "done": "boolean", "ratio": "double"}
INFERRED_SQL = """
WITH o AS (SELECT *, year(o_orderdate) AS y, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS whole FROM orders),
t AS (SELECT strftime(o_orderdate, '%Y') AS p, y % 2 = 0 AS declared, CAST(o_orderkey AS VARCHAR) AS order_key,
  CASE WHEN y < 1995 THEN whole ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
  CASE WHEN y < 1996 THEN CAST(o_custkey AS VARCHAR) ELSE lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS code,
  CASE WHEN y < 1997 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS placed,
  CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS done, CASE WHEN y > 1993 THEN o_orderpriority END AS note,
  CASE WHEN o_orderstatus = 'P' THEN whole || 'e-3' ELSE CAST(o_custkey % 100 AS VARCHAR) END AS ratio FROM o),
v AS (SELECT p, declared, column_name, value FROM t UNPIVOT INCLUDE NULLS (value FOR column_name IN (order_key, amount, code, placed, done, note, ratio))),
d(column_name, declared_type, a, s) AS (VALUES ('order_key', 'bigint', 19, 0), ('amount', 'decimal', 11, 3), ('done', 'boolean', 0, 0), ('ratio', 'double', 0, 0)),
c AS (SELECT p, v.column_name AS column_name, CASE WHEN declared AND declared_type IS NOT NULL THEN declared_type
    WHEN declared AND v.column_name IN ('placed', 'code', 'note') THEN 'string' WHEN value IS NULL THEN 'none'
    WHEN regexp_full_match(value, '-?(0|[1-9][0-9]*)') THEN 'bigint' WHEN regexp_full_match(value, '-?(0|[1-9][0-9]*)[.][0-9]+') THEN 'decimal'
    WHEN regexp_full_match(value, '-?[0-9]+([.][0-9]+)?[eE][+-]?[0-9]+') THEN 'double'
    WHEN regexp_full_match(value, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN 'date' WHEN try_cast(value AS TIMESTAMP) IS NOT NULL THEN 'timestamp'
    WHEN value IN ('true', 'false') THEN 'boolean' ELSE 'string' END AS kind,
    CASE WHEN declared AND declared_type IS NOT NULL THEN a WHEN regexp_full_match(value, '-?[0-9]+([.][0-9]+)?') THEN length(split_part(replace(value, '-', ''), '.', 1)) ELSE 0 END AS a,
    CASE WHEN declared AND declared_type IS NOT NULL THEN s WHEN regexp_full_match(value, '-?[0-9]+[.][0-9]+') THEN length(split_part(value, '.', 2)) ELSE 0 END AS s
  FROM v LEFT JOIN d ON v.column_name = d.column_name),
k AS (SELECT p AS billing_period, column_name, kind, a, s FROM c UNION ALL SELECT 'all', column_name, kind, a, s FROM c),
g AS (SELECT billing_period, column_name, MAX(a) AS a, MAX(s) AS s, COUNT(*) FILTER (kind <> 'none') AS n,
    BOOL_AND(kind IN ('none', 'boolean')) AS all_boolean, BOOL_AND(kind IN ('none', 'date')) AS all_date,
    BOOL_AND(kind IN ('none', 'date', 'timestamp')) AS all_time, BOOL_AND(kind IN ('none', 'bigint', 'decimal', 'double')) AS all_number,
    BOOL_OR(kind = 'double') AS any_double, BOOL_OR(kind = 'decimal') AS any_decimal FROM k GROUP BY 1, 2)
SELECT billing_period, column_name, CASE WHEN n = 0 THEN 'string' WHEN all_boolean THEN 'boolean' WHEN all_date THEN 'date'
  WHEN all_time THEN 'timestamp' WHEN NOT all_number THEN 'string' WHEN any_double THEN 'double'
  WHEN any_decimal THEN 'decimal(' || CAST(a + s AS VARCHAR) || ',' || CAST(s AS VARCHAR) || ')' ELSE 'bigint' END AS column_type
FROM g"""


@query("inferred_types", INFERRED_SQL)
def inferred_types_query(spark: SparkSession, folder: str) -> DataFrame:
    """Types of each year's columns and of all years together, over CSV and Parquet reports."""
    root = scratch_folder(spark)
    orders = _drifting_orders(spark, folder)
    odd = F.col("billing_period").cast("int") % 2 == 1
    orders.where(odd).write.partitionBy("billing_period").option("header", "true").csv(f"{root}/csv")
    stored = orders.where(~odd).withColumns({name: F.col(name).cast(kind) for name, kind in DECLARED.items()})
    stored.write.partitionBy("billing_period").parquet(f"{root}/parquet")
    by = ["billing_period"]
    texts = spark.read.option("header", "true").csv(f"{root}/csv").withColumn("billing_period", F.col("billing_period").cast("string"))
    typed = spark.read.parquet(f"{root}/parquet").withColumn("billing_period", F.col("billing_period").cast("string"))
    months = merged_states([column_states(texts, by), column_states(typed, by, declared=True)], by)
    whole = merged_states([months.drop("billing_period")]).withColumn("billing_period", F.lit("all"))
    return inferred_types(months.unionByName(whole))


# ---- imports of the other formats ---------------------------------------------------------
def _manifests(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """One manifest for each period, with the files written below a folder."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    period = F.regexp_extract("path", r"feed_period=(\d{4}-\d{2})", 1)
    files = listing.groupBy(period.alias("billing_period")).agg(F.sort_array(F.collect_list("path")).alias("report_keys"))
    return files.select(
        F.lit("").alias("bucket"),
        F.col("billing_period").alias("key"),
        "billing_period",
        F.lit("v1").alias("version"),
        F.lit("first").alias("version_id"),
        "report_keys",
        F.size("report_keys").cast("long").alias("file_count"),
    )


PLAIN_SQL = """SELECT strftime(l_shipdate, '%Y') || '-01' AS billing_period, COUNT(*) AS n,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS cost, SUM(l_linenumber) AS line_numbers,
       'string,bigint,boolean' AS column_types, MIN(lpad(CAST(l_orderkey AS VARCHAR), 12, '0')) AS first_account,
       COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS returned
FROM lineitem GROUP BY 1"""


def _typed_lines(spark: SparkSession, folder: str) -> DataFrame:
    returned = (F.col("l_returnflag") == "R").alias("resourceTags/user:Returned")
    shipped = F.concat(F.date_format("l_shipdate", "yyyy"), F.lit("-01")).alias("feed_period")
    return table(spark, folder, "lineitem").select(
        shipped,
        F.lpad(F.col("l_orderkey").cast("string"), 12, "0").alias("lineItem/UsageAccountId"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("lineItem/UnblendedCost"),
        F.col("l_linenumber").cast("long").alias("line/Number"),
        returned,
    )


def _summed(lake: BillingLake) -> DataFrame:
    view = lake.unified_view()
    names = ["line_item_usage_account_id", "line_number", "resource_tags_user_returned"]
    return view.groupBy("billing_period").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("line_item_unblended_cost").alias("cost"),
        F.sum("line_number").alias("line_numbers"),
        F.lit(",".join(view.schema[name].dataType.simpleString() for name in names)).alias("column_types"),
        F.min("line_item_usage_account_id").alias("first_account"),
        F.count_if("resource_tags_user_returned").alias("returned"),
    )


@query("csv_plain_ingest", PLAIN_SQL)
def csv_plain_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Plain CSV reports without line breaks in values: files are split, other columns get inferred types."""
    root = scratch_folder(spark)
    _typed_lines(spark, folder).write.partitionBy("feed_period").option("header", "true").csv(f"{root}/reports")
    lake = BillingLake(spark, f"{root}/lake", "aws", "plain")
    manifests = _manifests(spark, f"{root}/reports", "*.csv")
    import_export(lake, manifests, lambda _, key: key, multi_line=False, periods_at_once=8, infer_types=True)
    return _summed(lake)


@query("parquet_ingest", PLAIN_SQL)
def parquet_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet reports, whose declared types are kept."""
    root = scratch_folder(spark)
    _typed_lines(spark, folder).write.partitionBy("feed_period").parquet(f"{root}/reports")
    lake = BillingLake(spark, f"{root}/lake", "aws", "stored")
    import_export(lake, _manifests(spark, f"{root}/reports", "*.parquet"), lambda _, key: key, periods_at_once=8)
    return _summed(lake)


# ---- headers -------------------------------------------------------------------------------
_GIVEN = ("lineItem/UsageAccountId", "lineItem/UsageStartDate", "lineItem/UnblendedCost", "lineItem/UsageAmount", "lineItem/Operation")
_ABSENT = sorted(set(REQUIRED_REPORT_COLUMNS) - set(_GIVEN))


@query(
    "schema_quality",
    f"""WITH p AS (SELECT strftime(l_shipdate, '%Y') || '-01' AS billing_period, BOOL_OR(l_returnflag = 'R') AS r,
         BOOL_OR(l_returnflag <> 'R') AS other FROM lineitem GROUP BY 1)
SELECT 'required_column' AS rule, billing_period, CAST(r AS BIGINT) + CAST(other AS BIGINT) AS n_rows, '{_ABSENT[0]}' AS sample FROM p
UNION ALL SELECT 'column_name_shape', billing_period, 1, 'owner' FROM p WHERE r""",
)
def schema_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Both header rules on the headers of written reports, of which some name a column wrongly."""
    root = scratch_folder(spark)
    raw, tag = _raw_lines(spark, folder), "resourceTags/user:Owner"
    for name, lines in (("plain", raw.where(F.col(tag) != "R").drop(tag)), ("tagged", raw.where(F.col(tag) == "R").withColumnRenamed(tag, "owner"))):
        dealt = lines.repartition("feed_period")  # a file for each period
        dealt.write.partitionBy("feed_period").option("header", "true").option("escape", '"').csv(f"{root}/{name}")
    listed = _manifests(spark, root, "*.csv").select("billing_period", F.explode("report_keys").alias("path")).collect()
    period = {row["path"]: row["billing_period"] for row in listed}
    return quality.header_report(spark, csv_headers(spark, list(period)), period)
