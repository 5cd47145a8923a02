"""Registered queries: FOCUS mapping, data quality, allocation and forecasts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from spendloom.functions import scalars as S
from spendloom.operators import allocation as N
from spendloom.operators import focus, quality
from spendloom.plans.analytics import COST, SERVICE, START, USAGE
from spendloom.plans.cost_queries import BILL
from spendloom.plans.registry import query
from spendloom.plans.star_billing import billing_lines, table
from spendloom.sources.gcp import recent_gcp_lines, standard_gcp_lines

NET, BLENDED = "line_item_net_unblended_cost", "line_item_blended_cost"
ACCOUNT, RESOURCE = "line_item_usage_account_id", "line_item_resource_id"
KIND = "line_item_line_item_type"
EXTENDED = (START, "line_item_usage_end_date", "line_item_product_code", RESOURCE, ACCOUNT, COST, NET,
            USAGE, "pricing_unit", KIND)


# ---- FOCUS mapping ---------------------------------------------------------------
@query(
    "focus_basic",
    BILL
    + """SELECT strftime(date_trunc('month', start_ts), '%Y-%m-%d %H:%M:%S') AS BillingPeriod,
       service AS ServiceName, resource_id AS ResourceId,
       CAST(usage_amount AS DOUBLE) AS UsageQuantity, usage_type AS UsageUnit,
       CAST(cost AS DOUBLE) AS ListCost, CAST(net AS DOUBLE) AS EffectiveCost,
       CAST(blended AS DOUBLE) AS BilledCost FROM lines""",
)
def focus_basic(spark, folder):
    columns = ("bill_billing_period_start_date", SERVICE, RESOURCE, USAGE, "line_item_usage_type",
               COST, NET, BLENDED)
    return focus.focus_basic(billing_lines(spark, folder, columns))


EXTENDED_SQL = (
    BILL
    + """, focus AS (SELECT date_trunc('month', start_ts) AS billing_period, start_ts,
       start_ts + INTERVAL 1 DAY AS end_ts, service AS service_name, resource_id, account_id,
       cost AS billed_cost,
       CASE WHEN line_type = 'DiscountedUsage' THEN cost ELSE net END AS effective_cost,
       usage_amount AS usage_quantity, 'Hrs' AS usage_unit,
       CASE line_type WHEN 'Usage' THEN 'Usage' WHEN 'Tax' THEN 'Tax' WHEN 'Credit' THEN 'Credit'
            ELSE 'Other' END AS charge_category FROM lines)
"""
)


@query(
    "focus_extended",
    EXTENDED_SQL
    + """SELECT strftime(billing_period, '%Y-%m-%d %H:%M:%S') AS billing_period,
       strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS billing_period_start,
       strftime(end_ts, '%Y-%m-%d %H:%M:%S') AS billing_period_end,
       service_name, resource_id, account_id, CAST(billed_cost AS DOUBLE) AS billed_cost,
       CAST(effective_cost AS DOUBLE) AS effective_cost,
       CAST(usage_quantity AS DOUBLE) AS usage_quantity, usage_unit, charge_category FROM focus""",
)
def focus_extended(spark, folder):
    return focus.focus_extended(billing_lines(spark, folder, EXTENDED))


@query(
    "focus_records",
    EXTENDED_SQL
    + """SELECT strftime(billing_period, '%Y-%m-%d %H:%M:%S') AS BillingPeriodStart,
       strftime(billing_period + INTERVAL 1 MONTH, '%Y-%m-%d %H:%M:%S') AS BillingPeriodEnd,
       CASE WHEN service_name IN ('EC2', 'Lambda') THEN 'Compute' ELSE 'Storage' END AS ServiceCategory,
       CASE WHEN service_name IN ('EC2', 'RDS') THEN 'Hours' ELSE 'GB' END AS UsageUnit,
       service_name AS ServiceName, COUNT(*) AS n, CAST(SUM(billed_cost) AS DOUBLE) AS BilledCost,
       ROUND(CAST(SUM(sign(ticks) * ((abs(ticks) * 2000000 + quantity) // (2 * quantity))) AS DOUBLE)
             / 10000000000, 4) AS EffectiveUnitPrices
FROM (SELECT billing_period, billed_cost, CAST(effective_cost * 10000 AS HUGEINT) AS ticks,
             CAST(usage_quantity AS HUGEINT) AS quantity,
             CASE service_name WHEN 'SMALL' THEN 'EC2' WHEN 'LARGE' THEN 'RDS'
                  WHEN 'PROMO' THEN 'Lambda' ELSE 'S3' END AS service_name FROM focus)
GROUP BY 1, 2, 3, 4, 5""",
)
def focus_records(spark, folder):
    names = {("star", "SMALL"): "EC2", ("star", "LARGE"): "RDS", ("star", "PROMO"): "Lambda",
             **{("star", s): "S3" for s in ("STANDARD", "MEDIUM", "ECONOMY")}}
    extended = focus.focus_extended(billing_lines(spark, folder, EXTENDED)).withColumn(
        "service_name", S.standard_service_name("star", F.col("service_name"), names)
    )
    keys = ("BillingPeriodStart", "BillingPeriodEnd", "ServiceCategory", "UsageUnit", "ServiceName")
    return (
        focus.focus_record(extended, "AWS")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("BilledCost").alias("BilledCost"),
            F.round(F.sum("EffectiveUnitPrice"), 4).alias("EffectiveUnitPrices"),
        )
    )


@query(
    "service_standardised",
    """SELECT CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 'NATION_' || length(p_type)
            ELSE p_type END AS standard_service, COUNT(*) AS n,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS cost
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def service_standardised(spark, folder):
    # A mapping table with a row per part: names repeat in it, lines must not.
    part = table(spark, folder, "part")
    mapping = part.where(F.col("p_type").isin("SMALL", "LARGE")).select(
        F.lit("aws").alias("provider"),
        F.col("p_type").alias("service"),
        F.concat(F.lit("NATION_"), F.length("p_type").cast("string")).alias("standard_service"),
    )
    item = table(spark, folder, "lineitem").select("l_partkey", "l_extendedprice")
    lines = item.join(part.select("p_partkey", "p_type"), item.l_partkey == part.p_partkey).select(
        F.lit("aws").alias("provider"),
        F.col("p_type").alias("service"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("cost"),
    )
    return (
        focus.with_standard_service(lines, mapping, "service")
        .groupBy("standard_service")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("cost").alias("cost"))
    )


def _gcp_export(spark, folder):
    """The line items shaped like a nested GCP export; some projects and costs are NULL."""
    item = table(spark, folder, "lineitem")
    ts = F.col("l_shipdate").cast("timestamp")
    return item.select(
        F.col("l_orderkey").cast("string").alias("billing_account_id"),
        F.struct(F.col("l_linestatus").alias("description")).alias("service"),
        F.struct(F.col("l_returnflag").alias("description")).alias("sku"),
        F.struct(
            F.when(F.col("l_linestatus") == "O", F.concat(F.lit("p-"), F.col("l_suppkey"))).alias("id")
        ).alias("project"),
        ts.alias("usage_start_time"),
        (ts + F.expr("INTERVAL '1' DAY")).alias("usage_end_time"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice").cast("decimal(12,2)")).alias("cost"),
        F.lit("USD").alias("currency"),
        F.struct(
            F.col("l_quantity").cast("decimal(12,2)").alias("amount"), F.lit("hour").alias("unit")
        ).alias("usage"),
    )


@query(
    "gcp_recent_lines",
    """SELECT CAST(l_orderkey AS VARCHAR) AS billing_account_id, 'gcp' AS vendor,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS billing_period,
       CASE WHEN l_linestatus = 'O' THEN 'p-' || CAST(l_suppkey AS VARCHAR) ELSE 'unknown' END AS resource_id,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS usage_start_time,
       strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') AS usage_end_time,
       l_linestatus AS service_name, l_returnflag AS sku_description,
       CAST(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice ELSE 0 END AS DOUBLE) AS billed_cost,
       CAST(l_quantity AS DOUBLE) AS usage_amount, 'hour' AS usage_unit
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-12-02'""",
)
def gcp_recent_lines(spark, folder):
    recent = recent_gcp_lines(_gcp_export(spark, folder), dt.date(2001, 1, 1))
    return standard_gcp_lines(recent).select(
        "billing_account_id", "vendor", "billing_period", "resource_id", "usage_start_time",
        "usage_end_time", "service_name", "sku_description", "billed_cost", "usage_amount", "usage_unit",
    )


# ---- data quality ----------------------------------------------------------------
QUALITY_SQL = """
WITH q AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS billing_period,
         CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'DiscountedUsage' ELSE
           CASE WHEN l_shipdate < TIMESTAMP '1996-01-01' THEN 'Fee' ELSE 'Usage' END END AS kind,
         CASE p_type WHEN 'SMALL' THEN 'AmazonEC2' WHEN 'LARGE' THEN 'AmazonS3' ELSE p_type END AS code,
         CASE WHEN p_size > 25 THEN 'AmazonEC2' ELSE 'AmazonS3' END AS servicecode,
         CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(l_quantity - 2 AS DECIMAL(12,2)) AS VARCHAR) END AS usage,
         CASE WHEN l_linestatus = 'O' THEN 'USD' ELSE 'EUR' END AS currency,
         CASE WHEN l_linenumber <= 3 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ')
              ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS started,
         CASE WHEN l_tax > 0.02 THEN 'arn:aws:ec2:eu-west-1:1:i/' || CAST(l_partkey AS VARCHAR)
              WHEN l_tax > 0 THEN 'i-' || CAST(l_partkey AS VARCHAR) ELSE '' END AS resource,
         rpad(lower(p_brand), CASE WHEN l_linenumber = 1 THEN 50 ELSE 49 END, 'x') AS line_id,
         CASE WHEN n_nationkey < 10 THEN 'eu-west-1' ELSE lower(n_name) END AS region,
         CASE WHEN n_nationkey < 5 THEN 'eu-west-1a' ELSE 'nation_1z' END AS zone
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey),
v AS (
  SELECT 'line_item_type_known' AS rule, billing_period, kind AS shown FROM q
    WHERE kind NOT IN ('Usage','DiscountedUsage','Credit','Discount','Fee','Tax','Refund','BundledDiscount')
  UNION ALL SELECT 'service_known', billing_period, servicecode FROM q
    WHERE servicecode NOT IN ('AmazonEC2','AmazonS3','AmazonRDS','AmazonCloudFront','AWSLambda')
  UNION ALL SELECT 'product_code_matches', billing_period, code FROM q WHERE code <> servicecode
  UNION ALL SELECT 'line_item_usage_amount_numeric', billing_period, usage FROM q
    WHERE TRY_CAST(usage AS DOUBLE) IS NULL
  UNION ALL SELECT 'usage_not_negative', billing_period, usage FROM q WHERE TRY_CAST(usage AS DOUBLE) < 0
  UNION ALL SELECT 'line_item_currency_code_is_usd', billing_period, currency FROM q WHERE currency <> 'USD'
  UNION ALL SELECT 'line_item_usage_start_date_iso', billing_period, started FROM q
    WHERE strpos(started, 'T') = 0 OR strpos(started, 'Z') = 0
  UNION ALL SELECT 'resource_is_arn', billing_period, resource FROM q
    WHERE resource <> '' AND NOT starts_with(resource, 'arn:aws:')
  UNION ALL SELECT 'line_item_id_shape', billing_period, line_id FROM q WHERE length(line_id) <> 50
  UNION ALL SELECT 'region_known', billing_period, region FROM q WHERE region <> 'eu-west-1'
  UNION ALL SELECT 'zone_in_region', billing_period, zone FROM q WHERE NOT starts_with(zone, region)
  UNION ALL SELECT 'usage_present', billing_period, NULL FROM q
    GROUP BY billing_period HAVING COUNT(CASE WHEN kind = 'Usage' THEN 1 END) = 0)
SELECT rule, billing_period, COUNT(*) AS n_rows, MIN(shown) AS sample FROM v GROUP BY 1, 2
"""


@query("quality_report", QUALITY_SQL)
def quality_report(spark, folder):
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, folder, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    home = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    item = table(spark, folder, "lineitem")
    joined = item.join(part, item.l_partkey == part.p_partkey).join(
        home, item.l_suppkey == home.s_suppkey
    )
    flag, ts, number = F.col("l_returnflag"), F.col("l_shipdate"), F.col("l_linenumber")
    kind = (
        F.when(flag == "R", "Returned")
        .when(flag == "A", "DiscountedUsage")
        .when(ts < "1996-01-01", "Fee")
        .otherwise("Usage")
    )
    code = (
        F.when(F.col("p_type") == "SMALL", "AmazonEC2")
        .when(F.col("p_type") == "LARGE", "AmazonS3")
        .otherwise(F.col("p_type"))
    )
    part_id = F.col("l_partkey").cast("string")
    lines = joined.select(
        S.billing_period(ts).alias("billing_period"),
        kind.alias(KIND),
        code.alias("line_item_product_code"),
        F.when(F.col("p_size") > 25, "AmazonEC2").otherwise("AmazonS3").alias("product_servicecode"),
        F.when(number == 7, "n/a")
        .otherwise((F.col("l_quantity") - 2).cast("decimal(12,2)").cast("string"))
        .alias(USAGE),
        F.when(F.col("l_linestatus") == "O", "USD").otherwise("EUR").alias("line_item_currency_code"),
        F.when(number <= 3, S.iso_text(ts)).otherwise(F.to_date(ts).cast("string")).alias(START),
        F.when(F.col("l_tax") > 0.02, F.concat(F.lit("arn:aws:ec2:eu-west-1:1:i/"), part_id))
        .when(F.col("l_tax") > 0, F.concat(F.lit("i-"), part_id))
        .otherwise("")
        .alias(RESOURCE),
        F.rpad(F.lower("p_brand"), F.when(number == 1, 50).otherwise(49), F.lit("x")).alias(
            "identity_line_item_id"
        ),
        F.when(F.col("n_nationkey") < 10, "eu-west-1").otherwise(F.lower("n_name")).alias("product_region"),
        F.when(F.col("n_nationkey") < 5, "eu-west-1a").otherwise("nation_1z").alias(
            "line_item_availability_zone"
        ),
    )
    return quality.quality_report(lines)


@query(
    "focus_quality",
    """WITH f AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS billing_period, CAST(o_orderkey AS VARCHAR) AS id,
         CASE o_orderstatus WHEN 'F' THEN 'EC2' WHEN 'O' THEN 'S3' ELSE o_orderpriority END AS service,
         CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS resource,
         CAST(o_totalprice - 1000 AS DECIMAL(12,2)) AS billed FROM orders),
v AS (SELECT 'ServiceName_known' AS rule, billing_period, service AS shown FROM f WHERE service NOT IN ('EC2', 'S3')
  UNION ALL SELECT 'ResourceId_filled', billing_period, resource FROM f WHERE resource = ''
  UNION ALL SELECT 'BilledCost_not_negative', billing_period, CAST(billed AS VARCHAR) FROM f WHERE billed < 0)
SELECT rule, billing_period, COUNT(*) AS n_rows, MIN(shown) AS sample FROM v GROUP BY 1, 2""",
)
def focus_quality(spark, folder):
    orders = table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    records = orders.select(
        F.col("o_orderdate").alias("BillingPeriodStart"),
        F.when(status == "F", "EC2")
        .when(status == "O", "S3")
        .otherwise(F.col("o_orderpriority"))
        .alias("ServiceName"),
        F.when(F.col("o_orderpriority") == "5-LOW", "")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("ResourceId"),
        (F.col("o_totalprice") - 1000).cast("decimal(12,2)").alias("BilledCost"),
        F.lit("AWS").alias("Provider"),
        F.lit("USD").alias("BillingCurrency"),
    )
    return quality.focus_quality_report(records)


@query(
    "dataset_comparison",
    """WITH b AS (SELECT COUNT(*) AS records, COUNT(DISTINCT event_type) AS services FROM events),
c AS (SELECT COUNT(*) AS records, COUNT(DISTINCT o_orderpriority) AS services FROM orders)
SELECT CAST(6 AS BIGINT) AS baseline_columns, b.records AS baseline_records, b.services AS baseline_services,
       CAST(5 AS BIGINT) AS candidate_columns, c.records AS candidate_records, c.services AS candidate_services,
       5 / 6 AS columns_ratio, c.records / b.records AS records_ratio,
       c.services / b.services AS services_ratio, TRUE AS columns_ok, c.services >= 5 AS services_ok
FROM b, c""",
)
def dataset_comparison(spark, folder):
    events = table(spark, folder, "events").withColumnRenamed("event_type", "service")
    orders = table(spark, folder, "orders").drop("o_totalprice")
    return quality.compare_datasets(
        events, orders.withColumnRenamed("o_orderpriority", "service"), "service"
    )


# ---- allocation ------------------------------------------------------------------
OWNED = """
WITH owned AS (SELECT strftime(o_orderdate, '%Y-%m') AS billing_period,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS owner,
       CAST(o_totalprice AS DECIMAL(12,2)) AS cost FROM orders)
"""


def _owned(spark, folder):
    return table(spark, folder, "orders").select(
        S.billing_period(F.col("o_orderdate")).alias("billing_period"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority")).alias("owner"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("cost"),
    )


@query(
    "allocation_direct",
    OWNED
    + """SELECT billing_period, coalesce(owner, 'unallocated') AS owner,
       CAST(SUM(cost) AS DOUBLE) AS cost FROM owned GROUP BY 1, 2""",
)
def allocation_direct(spark, folder):
    return N.allocate_direct(_owned(spark, folder), "owner", "cost")


@query(
    "allocation_proportional",
    OWNED
    + """, t AS (SELECT billing_period, SUM(CASE WHEN owner IS NOT NULL THEN cost END) AS owned_total,
       COALESCE(SUM(CASE WHEN owner IS NULL THEN cost END), 0) AS shared_total FROM owned GROUP BY 1),
o AS (SELECT billing_period, owner, SUM(cost) AS cost FROM owned WHERE owner IS NOT NULL GROUP BY 1, 2)
SELECT billing_period, owner, CAST(cost AS DOUBLE) AS own_cost,
       ROUND(CAST(cost AS DOUBLE) / CAST(owned_total AS DOUBLE) * CAST(shared_total AS DOUBLE), 2) AS shared_cost,
       ROUND(CAST(cost AS DOUBLE) + CAST(cost AS DOUBLE) / CAST(owned_total AS DOUBLE)
             * CAST(shared_total AS DOUBLE), 2) AS allocated_cost
FROM o JOIN t USING (billing_period)
UNION ALL SELECT billing_period, 'unallocated', CAST(shared_total AS DOUBLE), 0, CAST(shared_total AS DOUBLE)
FROM t WHERE owned_total IS NULL""",
)
def allocation_proportional(spark, folder):
    shares = N.allocate_proportional(_owned(spark, folder), "owner", "cost")
    return shares.withColumns({c: F.round(c, 2) for c in ("shared_cost", "allocated_cost")})


@query(
    "allocation_by_weights",
    """WITH c AS (SELECT strftime(o_orderdate, '%Y-%m') AS billing_period,
       SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS cost FROM orders GROUP BY 1),
w AS (SELECT strftime(l_shipdate, '%Y-%m') AS billing_period, l_returnflag AS owner,
       CAST(SUM(l_quantity) AS DOUBLE) AS weight FROM lineitem GROUP BY 1, 2)
SELECT c.billing_period, coalesce(owner, 'unallocated') AS owner,
       ROUND(CASE WHEN owner IS NULL THEN CAST(cost AS DOUBLE) ELSE CAST(cost AS DOUBLE)
         * (weight / SUM(weight) OVER (PARTITION BY c.billing_period)) END, 2) AS allocated_cost
FROM c LEFT JOIN w ON c.billing_period = w.billing_period""",
)
def allocation_by_weights(spark, folder):
    orders, item = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    costs = orders.select(
        S.billing_period(F.col("o_orderdate")).alias("billing_period"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("cost"),
    )
    weights = item.select(
        S.billing_period(F.col("l_shipdate")).alias("billing_period"),
        F.col("l_returnflag").alias("owner"),
        F.col("l_quantity").cast("decimal(12,2)").alias("weight"),
    )
    shares = N.allocate_by_weights(costs, weights, "cost")
    return shares.withColumn("allocated_cost", F.round("allocated_cost", 2))


@query(
    "inherited_tags",
    """SELECT c_mktsegment AS team, o_orderpriority AS env, COUNT(*) AS n FROM (
  SELECT CASE WHEN o_orderstatus = 'F' THEN 'own' ELSE c_mktsegment END AS c_mktsegment, o_orderpriority
  FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY 1, 2""",
)
def inherited_tags(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    own = S.tags_from_columns({" Env": "o_orderpriority", "TEAM": "team"})
    account = S.tags_from_columns({"Team ": "c_mktsegment"})
    team = F.when(F.col("o_orderstatus") == "F", "own")
    tagged = orders.join(customer, orders.o_custkey == customer.c_custkey).withColumn("team", team)
    tags = N.inherited_tags(N.normalised_tags(own), N.normalised_tags(account))
    return (
        tagged.select(tags.alias("tags"))
        .groupBy(
            F.try_element_at("tags", F.lit("team")).alias("team"),
            F.try_element_at("tags", F.lit("env")).alias("env"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "currency_standardised",
    """WITH l AS (SELECT strftime(o_orderdate, '%Y-%m') AS billing_period,
       CASE o_orderstatus WHEN 'F' THEN 'USD' WHEN 'O' THEN 'EUR' ELSE 'GBP' END AS currency,
       CAST(o_totalprice AS DECIMAL(12,2)) AS cost FROM orders),
r AS (SELECT strftime(l_shipdate, '%Y-%m') AS billing_period, 'EUR' AS currency,
       CAST(1 + MAX(CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(6,2)) AS rate FROM lineitem GROUP BY 1)
SELECT billing_period, currency, COUNT(*) AS n, COUNT(converted) AS converted_lines,
       COALESCE(CAST(SUM(converted) AS DOUBLE), 0) AS converted_cost FROM (
  SELECT l.billing_period, l.currency, CAST(CASE WHEN l.currency = 'USD' THEN cost ELSE cost * rate END
       AS DECIMAL(18,4)) AS converted
  FROM l LEFT JOIN r ON l.currency = r.currency AND l.billing_period = r.billing_period) GROUP BY 1, 2""",
)
def currency_standardised(spark, folder):
    status = F.col("o_orderstatus")
    lines = table(spark, folder, "orders").select(
        S.billing_period(F.col("o_orderdate")).alias("billing_period"),
        F.when(status == "F", "USD").when(status == "O", "EUR").otherwise("GBP").alias("currency"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("cost"),
    )
    rates = table(spark, folder, "lineitem").select(
        S.billing_period(F.col("l_shipdate")).alias("billing_period"),
        F.lit("EUR").alias("currency"),
        (F.lit(1) + F.col("l_tax").cast("decimal(4,2)")).alias("rate"),
    )
    return (
        N.in_currency(lines, rates, "cost", scale=None)
        .groupBy("billing_period", "currency")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("converted_cost").alias("converted_lines"),
            F.coalesce(F.sum("converted_cost"), F.lit(0)).alias("converted_cost"),
        )
    )


UNIFIED_SQL = """, item AS (SELECT l_shipdate, l_linestatus, l_orderkey,
       CASE WHEN l_linestatus = 'O' THEN 'p-' || CAST(l_suppkey AS VARCHAR) ELSE 'unknown' END AS project,
       CAST(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice ELSE 0 END AS DECIMAL(12,2)) AS cost,
       CAST(l_quantity AS DECIMAL(12,2)) AS quantity FROM lineitem),
unified AS (
  SELECT 'aws' AS provider, strftime(billing_period, '%Y-%m') AS billing_period, service_name,
         account_id, usage_quantity, billed_cost, effective_cost, charge_category FROM focus
  UNION ALL SELECT 'gcp', strftime(l_shipdate, '%Y-%m'), l_linestatus, CAST(l_orderkey AS VARCHAR),
         quantity, cost, cost, 'Usage' FROM item
  UNION ALL SELECT 'azure', strftime(o_orderdate, '%Y-%m'), o_orderpriority, CAST(o_custkey AS VARCHAR),
         1, CAST(o_totalprice AS DECIMAL(12,2)), CAST(o_totalprice AS DECIMAL(12,2)), o_orderstatus FROM orders)
"""


def _unified(spark, folder):
    azure = table(spark, folder, "orders").select(
        F.col("o_orderdate").alias("Date"),
        F.col("o_orderpriority").alias("MeterCategory"),
        F.col("o_orderkey").cast("string").alias("ResourceId"),
        F.col("o_custkey").cast("string").alias("SubscriptionId"),
        F.lit(1).alias("Quantity"),
        F.lit("Unit").alias("UnitOfMeasure"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("CostInBillingCurrency"),
        F.lit("EUR").alias("BillingCurrency"),
        F.col("o_orderstatus").alias("ChargeType"),
    )
    gcp = _gcp_export(spark, folder).select(
        "billing_account_id",
        F.col("service.description").alias("service_name"),
        F.col("project.id").alias("project_id"),
        "usage_start_time",
        "usage_end_time",
        "cost",
        "currency",
        F.col("usage.amount").alias("usage_amount"),
        F.col("usage.unit").alias("usage_unit"),
    )
    return focus.unified_costs(
        {
            "aws": billing_lines(spark, folder, EXTENDED),
            "gcp": standard_gcp_lines(gcp),
            "azure": azure,
        }
    )


@query(
    "unified_multicloud",
    EXTENDED_SQL
    + UNIFIED_SQL
    + """SELECT provider, billing_period, COUNT(*) AS n, CAST(SUM(usage_quantity) AS DOUBLE) AS usage_quantity,
       CAST(SUM(billed_cost) AS DOUBLE) AS billed_cost, CAST(SUM(effective_cost) AS DOUBLE) AS effective_cost,
       COUNT(DISTINCT service_name) AS services
FROM unified GROUP BY 1, 2""",
)
def unified_multicloud(spark, folder):
    return (
        _unified(spark, folder)
        .groupBy("provider", "billing_period")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("usage_quantity").alias("usage_quantity"),
            F.sum("billed_cost").alias("billed_cost"),
            F.sum("effective_cost").alias("effective_cost"),
            F.count_distinct("service_name").alias("services"),
        )
    )


@query(
    "azure_focus",
    """SELECT strftime(o_orderdate, '%Y-%m') AS billing_period, o_orderpriority AS service_name,
       o_orderstatus AS charge_category, COUNT(*) AS n,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS billed_cost
FROM orders GROUP BY 1, 2, 3""",
)
def azure_focus(spark, folder):
    lines = _unified(spark, folder).where(F.col("provider") == "azure")
    return lines.groupBy("billing_period", "service_name", "charge_category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("billed_cost").alias("billed_cost")
    )


@query(
    "monthly_mart",
    EXTENDED_SQL
    + UNIFIED_SQL
    + """SELECT provider, billing_period, service_name, account_id, charge_category,
       COUNT(*) AS line_items, CAST(SUM(usage_quantity) AS DOUBLE) AS usage_quantity,
       CAST(SUM(billed_cost) AS DOUBLE) AS billed_cost, CAST(SUM(effective_cost) AS DOUBLE) AS effective_cost
FROM unified GROUP BY 1, 2, 3, 4, 5""",
)
def monthly_mart(spark, folder):
    return N.monthly_mart(_unified(spark, folder), ("provider",))


@query(
    "cost_reconciliation",
    EXTENDED_SQL
    + """, r AS (SELECT strftime(l_shipdate, '%Y-%m') AS billing_period, COUNT(*) AS raw_rows,
       SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS raw_cost FROM lineitem GROUP BY 1),
f AS (SELECT strftime(billing_period, '%Y-%m') AS billing_period, COUNT(*) AS focus_rows,
       SUM(billed_cost) AS focus_cost FROM focus GROUP BY 1)
SELECT billing_period, COALESCE(raw_rows, 0) AS raw_rows, COALESCE(focus_rows, 0) AS focus_rows,
       CAST(COALESCE(raw_cost, 0) AS DOUBLE) AS raw_cost, CAST(COALESCE(focus_cost, 0) AS DOUBLE) AS focus_cost,
       CAST(COALESCE(focus_cost, 0) - COALESCE(raw_cost, 0) AS DOUBLE) AS difference,
       COALESCE(raw_rows, 0) = COALESCE(focus_rows, 0) AND COALESCE(raw_cost, 0) = COALESCE(focus_cost, 0) AS reconciled
FROM r FULL JOIN f USING (billing_period)""",
)
def cost_reconciliation(spark, folder):
    # Raw prices know no refunds, so the mapped totals differ from them.
    raw = table(spark, folder, "lineitem").select(
        S.billing_period(F.col("l_shipdate")).alias("billing_period"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("cost"),
    )
    mapped = focus.focus_extended(billing_lines(spark, folder, EXTENDED)).select(
        S.billing_period(F.col("billing_period")).alias("billing_period"), "billed_cost"
    )
    return N.reconciliation(raw, mapped, "cost", "billed_cost")


@query(
    "chargeback",
    BILL
    + """, c AS (SELECT billing_period, coalesce(region, 'unallocated') AS cost_centre,
       SUM(cost) AS cost FROM lines GROUP BY 1, 2)
SELECT billing_period, cost_centre, CAST(cost AS DOUBLE) AS cost,
       ROUND(CAST(cost AS DOUBLE) / CAST(SUM(cost) OVER (PARTITION BY billing_period) AS DOUBLE), 6) AS share FROM c""",
)
def chargeback(spark, folder):
    lines = billing_lines(spark, folder, ("billing_period", "product_region", COST))
    shares = N.chargeback(lines, F.col("product_region"), COST)
    return shares.withColumn("share", F.round("share", 6))


@query(
    "commitment_share",
    BILL
    + """, c AS (SELECT billing_period, CASE WHEN line_type = 'DiscountedUsage' THEN 'committed'
       ELSE 'on demand' END AS commitment, COUNT(*) AS line_items, SUM(net) AS cost FROM lines GROUP BY 1, 2)
SELECT billing_period, commitment, line_items, CAST(cost AS DOUBLE) AS cost,
       ROUND(CAST(cost AS DOUBLE) / CAST(SUM(cost) OVER (PARTITION BY billing_period) AS DOUBLE), 6) AS share FROM c""",
)
def commitment_share(spark, folder):
    lines = billing_lines(spark, folder, ("billing_period", KIND, NET))
    commitment = F.when(F.col(KIND) == "DiscountedUsage", "committed").otherwise("on demand")
    return N.commitment_share(lines, commitment, NET).withColumn("share", F.round("share", 6))


@query(
    "budget_breaches",
    BILL
    + """, s AS (SELECT billing_period, service, SUM(cost) AS cost FROM lines GROUP BY 1, 2),
b AS (SELECT p_type AS service, CAST(SUM(CAST(p_retailprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS budget
      FROM part GROUP BY 1)
SELECT billing_period, s.service AS service, CAST(cost AS DOUBLE) AS cost, CAST(budget AS DOUBLE) AS budget
FROM s JOIN b ON s.service = b.service WHERE cost >= budget * CAST(0.8 AS DECIMAL(6,4))""",
)
def budget_breaches(spark, folder):
    lines = billing_lines(spark, folder, ("billing_period", SERVICE, COST))
    budgets = (
        table(spark, folder, "part")
        .groupBy(F.col("p_type").alias("service"))
        .agg(F.sum(F.col("p_retailprice").cast("decimal(12,2)")).alias("budget"))
    )
    return N.budget_breaches(lines.withColumnRenamed(SERVICE, "service"), budgets, "service", COST, 0.8)


@query(
    "daily_anomalies",
    BILL
    + """, d AS (SELECT service, CAST(start_ts AS DATE) AS day, CAST(SUM(cost) AS DOUBLE) AS cost
       FROM lines GROUP BY 1, 2),
w AS (SELECT *, COUNT(cost) OVER b AS seen, AVG(cost) OVER b AS mean, STDDEV_SAMP(cost) OVER b AS deviation
      FROM d WINDOW b AS (PARTITION BY service ORDER BY day ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
SELECT service, CAST(day AS VARCHAR) AS date, cost, seen, ROUND(mean, 4) AS mean, ROUND(deviation, 4) AS deviation
FROM w WHERE seen = 30 AND deviation > 0 AND abs(cost - mean) > deviation * 3""",
)
def daily_anomalies(spark, folder):
    lines = billing_lines(spark, folder, (SERVICE, START, COST))
    found = N.daily_anomalies(lines.withColumnRenamed(SERVICE, "service"), "service", COST, START)
    return found.withColumns({c: F.round(c, 4) for c in ("mean", "deviation")})


@query(
    "service_forecast",
    BILL
    + """, m AS (SELECT service, (year(start_ts) - 2000) * 12 + month(start_ts) AS month_no,
       CAST(SUM(cost) AS DOUBLE) AS cost FROM lines GROUP BY 1, 2),
t AS (SELECT service, COUNT(*) AS months, MAX(month_no) AS last_month, regr_slope(cost, month_no) AS slope,
       regr_intercept(cost, month_no) AS intercept FROM m GROUP BY 1)
SELECT service, months, last_month, ROUND(slope, 2) AS slope, ROUND(intercept, 2) AS intercept,
       ROUND(intercept + slope * (last_month + 1), 2) AS next_cost FROM t""",
)
def service_forecast(spark, folder):
    lines = billing_lines(spark, folder, (SERVICE, START, COST))
    trend = N.cost_forecast(lines.withColumnRenamed(SERVICE, "service"), "service", COST, START)
    return trend.withColumns({c: F.round(c, 2) for c in ("slope", "intercept", "next_cost")})
