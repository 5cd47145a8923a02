"""Registered queries: cost reports, profiles and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendloom.functions import names
from spendloom.functions import scalars as S
from spendloom.plans import analytics as A
from spendloom.plans.registry import query
from spendloom.plans.star_billing import billing_lines, table
from spendloom.sources.reports import union_by_name

# The billing view of the test tables, as SQL.
BILL = """
WITH bill AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS billing_period,
         l_shipdate AS start_ts,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') || '/'
           || strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ') AS time_interval,
         CASE l_returnflag WHEN 'N' THEN 'Usage' WHEN 'A' THEN 'DiscountedUsage'
                           WHEN 'R' THEN 'Refund' END AS line_type,
         'part-' || CAST(l_partkey AS VARCHAR) AS resource_id,
         CAST(l_quantity AS DECIMAL(12,2)) AS usage_amount,
         CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(12,2))
              ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS cost,
         CAST(l_discount AS DECIMAL(4,2)) AS discount,
         CAST(l_tax AS DECIMAL(4,2)) AS tax,
         CAST(o_custkey AS VARCHAR) AS account_id,
         p_type AS service, p_brand AS usage_type, n_name AS region
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey),
lines AS (
  SELECT *, CAST(cost * (1 - discount) AS DECIMAL(18,4)) AS net,
            CAST(cost * (1 + tax) AS DECIMAL(18,4)) AS blended
  FROM bill)
"""

COST, USAGE, SERVICE, START = A.COST, A.USAGE, A.SERVICE, A.START
MONTH = "bill_billing_period_start_date"


def _lines(spark, folder, *columns):
    return billing_lines(spark, folder, columns)


# ---- cost reports ----------------------------------------------------------------
@query(
    "monthly_cost",
    BILL
    + """SELECT strftime(date_trunc('month', start_ts), '%Y-%m-%d %H:%M:%S') AS month,
       CAST(SUM(CAST(cost AS DECIMAL(10,2))) AS DOUBLE) AS total_cost
FROM lines WHERE cost IS NOT NULL GROUP BY 1""",
)
def monthly_cost(spark, folder):
    return A.monthly_cost(_lines(spark, folder, MONTH, COST))


@query(
    "top_services",
    BILL
    + """SELECT service, CAST(SUM(CAST(cost AS DECIMAL(10,2))) AS DOUBLE) AS cost
FROM lines WHERE cost IS NOT NULL AND service IS NOT NULL
GROUP BY service ORDER BY cost DESC, service LIMIT 10""",
)
def top_services(spark, folder):
    return A.top_services(_lines(spark, folder, SERVICE, COST))


@query(
    "daily_cost",
    BILL
    + """SELECT CAST(CAST(start_ts AS DATE) AS VARCHAR) AS date,
       CAST(SUM(CAST(cost AS DECIMAL(10,2))) AS DOUBLE) AS daily_cost
FROM lines WHERE cost IS NOT NULL GROUP BY 1""",
)
def daily_cost(spark, folder):
    return A.daily_cost(_lines(spark, folder, START, COST))


@query(
    "usage_type_cost",
    BILL
    + """SELECT usage_type, COUNT(*) AS line_items,
       CAST(SUM(CAST(cost AS DECIMAL(10,2))) AS DOUBLE) AS total_cost
FROM lines WHERE cost IS NOT NULL GROUP BY usage_type
HAVING SUM(CAST(cost AS DECIMAL(10,2))) > 0""",
)
def usage_type_cost(spark, folder):
    return A.usage_type_cost(_lines(spark, folder, "line_item_usage_type", COST))


@query(
    "resource_usage",
    BILL
    + """SELECT resource_id, usage_type,
       CAST(SUM(CAST(usage_amount AS DECIMAL(10,2))) AS DOUBLE) AS hours,
       CAST(SUM(CAST(cost AS DECIMAL(10,2))) AS DOUBLE) AS cost
FROM lines WHERE service = 'ECONOMY' AND resource_id IS NOT NULL
GROUP BY resource_id, usage_type""",
)
def resource_usage(spark, folder):
    lines = _lines(
        spark, folder, SERVICE, "line_item_resource_id", "line_item_usage_type", USAGE, COST
    )
    return A.resource_usage(lines, "ECONOMY")


@query(
    "monthly_cost_interval_text",
    BILL
    + """SELECT SUBSTRING(time_interval, 1, 7) AS month,
       CAST(SUM(CAST(cost AS DECIMAL)) AS DOUBLE) AS total_cost
FROM lines GROUP BY 1""",
)
def monthly_cost_interval_text(spark, folder):
    return A.monthly_cost_by_interval_text(_lines(spark, folder, "identity_time_interval", COST))


@query(
    "top_services_bare_decimal",
    BILL
    + """SELECT service AS product_name, CAST(SUM(CAST(net AS DECIMAL)) AS DOUBLE) AS cost
FROM lines WHERE net IS NOT NULL GROUP BY service ORDER BY cost DESC, service LIMIT 10""",
)
def top_services_bare_decimal(spark, folder):
    # The net cost has four decimals, so the cast to three is seen to round each line.
    net = "line_item_net_unblended_cost"
    lines = _lines(spark, folder, SERVICE, net).withColumnRenamed(net, COST)
    return A.top_services_at_three_decimals(lines)


@query(
    "top_services_blended",
    BILL
    + """SELECT service, CAST(SUM(blended) AS DOUBLE) AS total_cost
FROM lines GROUP BY service ORDER BY total_cost DESC, service LIMIT 10""",
)
def top_services_blended(spark, folder):
    return A.top_services_blended(_lines(spark, folder, SERVICE, A.BLENDED))


@query(
    "daily_blended_cost",
    BILL
    + """SELECT CAST(CAST(start_ts AS DATE) AS VARCHAR) AS date,
       CAST(SUM(blended) AS DOUBLE) AS daily_cost
FROM lines GROUP BY 1""",
)
def daily_blended_cost(spark, folder):
    return A.daily_blended_cost(_lines(spark, folder, START, A.BLENDED))


@query(
    "cost_by_account",
    BILL
    + """SELECT account_id, COUNT(*) AS line_items,
       CAST(SUM(CAST(cost AS DECIMAL(10,2))) AS DOUBLE) AS cost
FROM lines WHERE cost IS NOT NULL GROUP BY account_id""",
)
def cost_by_account(spark, folder):
    return A.cost_by_account(_lines(spark, folder, "line_item_usage_account_id", COST))


# ---- profiles --------------------------------------------------------------------
@query(
    "dataset_profile",
    BILL
    + """SELECT COUNT(*) AS total_records, COUNT(DISTINCT service) AS unique_services,
       COUNT(CASE WHEN cost > 0 THEN 1 END) AS cost_records FROM lines""",
)
def dataset_profile(spark, folder):
    return A.dataset_profile(_lines(spark, folder, SERVICE, COST))


@query(
    "cost_stats",
    BILL
    + """SELECT CAST(MIN(cost) AS DOUBLE) AS min_cost, CAST(MAX(cost) AS DOUBLE) AS max_cost,
       ROUND(AVG(cost), 4) AS avg_cost, CAST(MEDIAN(CAST(cost AS DOUBLE)) AS DOUBLE) AS median_cost
FROM lines WHERE cost > 0""",
)
def cost_stats(spark, folder):
    stats = A.cost_stats(_lines(spark, folder, COST))
    return stats.withColumn("avg_cost", F.round("avg_cost", 4))


@query(
    "usage_stats",
    BILL
    + """SELECT CAST(MIN(usage_amount) AS DOUBLE) AS min_usage,
       CAST(MAX(usage_amount) AS DOUBLE) AS max_usage, ROUND(AVG(usage_amount), 4) AS avg_usage,
       COUNT(CASE WHEN usage_amount > 0 THEN 1 END) AS usage_records,
       (SELECT MEDIAN(CAST(usage_amount AS DOUBLE)) FROM lines WHERE usage_amount > 0) AS median_usage
FROM lines WHERE usage_amount IS NOT NULL""",
)
def usage_stats(spark, folder):
    stats = A.usage_stats(_lines(spark, folder, USAGE))
    return stats.withColumn("avg_usage", F.round("avg_usage", 4))


@query(
    "services_by_records",
    BILL
    + """SELECT service, COUNT(*) AS record_count FROM lines WHERE service IS NOT NULL
GROUP BY service ORDER BY record_count DESC, service LIMIT 10""",
)
def services_by_records(spark, folder):
    return A.services_by_records(_lines(spark, folder, SERVICE))


# ---- views over periods ------------------------------------------------------------
@query(
    "unified_view_since",
    BILL
    + """SELECT billing_period, resource_id, CAST(cost AS DOUBLE) AS cost
FROM lines WHERE start_ts >= TIMESTAMP '2001-06-01 00:00:00'""",
)
def unified_view_since(spark, folder):
    columns = ("billing_period", "line_item_resource_id", START, COST)
    lines = _lines(spark, folder, *columns)
    early = lines.where(F.col("line_item_usage_start_date") < "1999-01-01")
    late = lines.where(F.col("line_item_usage_start_date") >= "1999-01-01")
    view = A.lines_since(union_by_name([early, late]), "2001-06-01")
    return view.select("billing_period", F.col("line_item_resource_id").alias("resource_id"),
                       F.col(COST).alias("cost"))


@query(
    "unified_view_drift",
    """SELECT strftime(l_shipdate, '%Y') AS year, COUNT(*) AS n,
       COUNT(CASE WHEN l_shipdate >= TIMESTAMP '1999-01-01' THEN 1 END) AS with_late_column,
       COUNT(CASE WHEN l_shipdate < TIMESTAMP '1997-01-01' THEN 1 END) AS with_early_column,
       CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity,
       MIN(CASE WHEN l_shipdate >= TIMESTAMP '1999-01-01' THEN l_returnflag
                ELSE CAST(l_linenumber AS VARCHAR) END) AS least_mixed
FROM lineitem GROUP BY 1""",
)
def unified_view_drift(spark, folder):
    # Three runs of periods with other columns and with types that disagree.
    item = table(spark, folder, "lineitem").select(
        "l_shipdate", "l_linenumber", "l_quantity", "l_returnflag", "l_tax"
    )
    shipped = F.col("l_shipdate")
    early = item.where(shipped < "1997-01-01").select(
        "l_shipdate", F.col("l_linenumber").alias("mixed"),
        F.col("l_quantity").cast("int").alias("quantity"), F.col("l_tax").alias("early_only"),
    )
    middle = item.where((shipped >= "1997-01-01") & (shipped < "1999-01-01")).select(
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
        F.col("l_linenumber").cast("long").alias("mixed"), "l_shipdate",
    )
    late = item.where(shipped >= "1999-01-01").select(
        F.col("l_returnflag").alias("MIXED"), "l_shipdate", "l_returnflag",
        F.col("l_quantity").cast("long").alias("quantity"),
    )
    return (
        union_by_name([early, middle, late])
        .groupBy(F.date_format("l_shipdate", "yyyy").alias("year"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("l_returnflag").alias("with_late_column"),
            F.count("early_only").alias("with_early_column"),
            F.sum("quantity").alias("quantity"),
            F.min("mixed").alias("least_mixed"),
        )
    )


@query(
    "unified_view_distinct",
    """SELECT strftime(l_shipdate, '%Y-%m') AS billing_period, COUNT(*) AS distinct_lines
FROM (SELECT DISTINCT l_shipdate, l_partkey, l_linestatus FROM lineitem) GROUP BY 1""",
)
def unified_view_distinct(spark, folder):
    item = table(spark, folder, "lineitem").select("l_shipdate", "l_partkey", "l_linestatus")
    open_lines = item.where(F.col("l_linestatus") == "O")
    closed = item.where(F.col("l_linestatus") == "F").select("l_linestatus", "l_partkey", "l_shipdate")
    return (
        union_by_name([open_lines, closed], distinct=True)
        .groupBy(S.billing_period(F.col("l_shipdate")).alias("billing_period"))
        .agg(F.count(F.lit(1)).alias("distinct_lines"))
    )


# ---- scalar functions ----------------------------------------------------------------
@query(
    "charge_category_totals",
    BILL
    + """SELECT billing_period, CASE line_type WHEN 'Usage' THEN 'Usage' WHEN 'Tax' THEN 'Tax'
       WHEN 'Credit' THEN 'Credit' ELSE 'Other' END AS charge_category,
       COUNT(*) AS line_items, CAST(SUM(cost) AS DOUBLE) AS cost
FROM lines GROUP BY 1, 2""",
)
def charge_category_totals(spark, folder):
    lines = _lines(spark, folder, "billing_period", "line_item_line_item_type", COST)
    category = S.charge_category(F.col("line_item_line_item_type"))
    return lines.groupBy("billing_period", category.alias("charge_category")).agg(
        F.count(F.lit(1)).alias("line_items"), F.sum(COST).alias("cost")
    )


@query(
    "effective_cost_totals",
    BILL
    + """SELECT line_type, CAST(SUM(CASE WHEN line_type = 'DiscountedUsage' THEN cost ELSE net END)
       AS DOUBLE) AS effective_cost FROM lines GROUP BY line_type""",
)
def effective_cost_totals(spark, folder):
    kind, net = "line_item_line_item_type", "line_item_net_unblended_cost"
    lines = _lines(spark, folder, kind, COST, net)
    effective = S.effective_cost(F.col(kind), F.col(COST), F.col(net))
    return lines.groupBy(F.col(kind).alias("line_type")).agg(
        F.sum(effective).alias("effective_cost")
    )


@query(
    "period_bounds",
    """SELECT strftime(o_orderdate, '%Y-%m') AS billing_period,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS period_start,
       strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y-%m-%d') AS period_end,
       COUNT(*) AS orders
FROM orders GROUP BY 1, 2, 3""",
)
def period_bounds(spark, folder):
    orders = table(spark, folder, "orders")
    periods = orders.groupBy(S.billing_period(F.col("o_orderdate")).alias("billing_period")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    period = F.col("billing_period")
    return periods.select(
        "billing_period",
        S.period_start(period).alias("period_start"),
        S.period_end(period).alias("period_end"),
        "orders",
    )


@query(
    "unit_rate",
    """SELECT l_returnflag, CAST(SUM(rate) AS DOUBLE) AS rates, COUNT(*) AS n,
       COUNT(CASE WHEN rate = 0 THEN 1 END) AS without_usage
FROM (SELECT l_returnflag, CASE WHEN l_returnflag <> 'R' AND l_quantity > 0
        THEN CAST(ROUND(l_extendedprice / l_quantity, 6) AS DECIMAL(18,6)) ELSE 0 END AS rate
      FROM lineitem) GROUP BY l_returnflag""",
)
def unit_rate(spark, folder):
    item = table(spark, folder, "lineitem")
    usage = F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("decimal(12,2)")).otherwise(0)
    rate = F.round(S.unit_rate(F.col("l_extendedprice").cast("decimal(12,2)"), usage), 6)
    return (
        item.select("l_returnflag", rate.alias("rate"))
        .groupBy("l_returnflag")
        .agg(
            F.sum("rate").alias("rates"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("rate") == 0).alias("without_usage"),
        )
    )


@query(
    "tags_from_json",
    """SELECT event_type, json_extract_string(props, '$.k') AS tag_value, COUNT(*) AS n,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS cost
FROM events GROUP BY 1, 2""",
)
def tags_from_json(spark, folder):
    events = table(spark, folder, "events").select("event_type", "props", "value")
    return (
        events.withColumn("tags", S.tags_from_json(F.col("props")))
        .groupBy("event_type", F.try_element_at("tags", F.lit("k")).alias("tag_value"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(12,2)")).alias("cost"))
    )


@query(
    "tags_from_columns",
    """SELECT tag, value, COUNT(*) AS n FROM (
  SELECT 'Environment' AS tag, o_orderstatus AS value FROM orders
  UNION ALL SELECT 'Project', o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW')
GROUP BY tag, value""",
)
def tags_from_columns(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderstatus",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("").alias("p"),
    )
    tags = S.tags_from_columns({"Environment": "o_orderstatus", "Project": "p"})
    return (
        orders.select(F.explode(tags).alias("tag", "value"))
        .groupBy("tag", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "arn_breakdown",
    BILL
    + """SELECT lower(service) AS service, region,
       COUNT(*) AS n, COUNT(DISTINCT resource_id || ':' || usage_type) AS resources
FROM lines GROUP BY 1, 2""",
)
def arn_breakdown(spark, folder):
    resource, kind = "line_item_resource_id", "line_item_usage_type"
    lines = _lines(spark, folder, SERVICE, "product_region", resource, kind)
    arn = F.concat_ws(
        ":", F.lit("arn:aws"), F.lower(SERVICE), "product_region", F.lit("123456789012"), resource, kind
    )
    return (
        lines.select(S.arn_parts(arn).alias("arn"))
        .groupBy(F.col("arn.service").alias("service"), F.col("arn.region").alias("region"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("arn.resource").alias("resources"))
    )


@query(
    "instance_types",
    """SELECT CASE WHEN strpos(url, ':') > 0 THEN string_split(url, ':')[-1] ELSE 't3.micro' END
       AS instance_type, COUNT(*) AS n FROM pages GROUP BY 1""",
)
def instance_types(spark, folder):
    pages = table(spark, folder, "pages")
    return pages.groupBy(S.instance_type(F.col("url"), "t3.micro").alias("instance_type")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "interval_bounds",
    """SELECT strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS interval_start,
       strftime(date_trunc('second', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS interval_end,
       event_id FROM events""",
)
def interval_bounds(spark, folder):
    events = table(spark, folder, "events")
    ts = F.col("ts").cast("timestamp")
    interval = S.time_interval(ts, ts + F.expr("INTERVAL '1' HOUR"))
    return events.select("event_id", interval.alias("i")).select(
        "event_id",
        S.interval_start(F.col("i")).alias("interval_start"),
        S.interval_end(F.col("i")).alias("interval_end"),
    )


@query(
    "daily_event_cost",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
       CAST(SUM(CAST(value AS DECIMAL(10,2))) AS DOUBLE) AS daily_cost
FROM events WHERE value IS NOT NULL GROUP BY 1""",
)
def daily_event_cost(spark, folder):
    # Costs as text and times within the day, as raw reports have them.
    events = table(spark, folder, "events")
    return A.daily_cost(
        events.select(F.col("ts").alias(START), F.col("value").cast("string").alias(COST))
    )


@query(
    "table_names",
    r"""WITH s AS (SELECT url, regexp_replace(regexp_replace(lower(url), '[\s\-/\\]+', '_', 'g'),
        '[^a-z0-9_]', '', 'g') AS plain FROM pages),
p AS (SELECT url, CASE WHEN regexp_matches(plain, '^[a-z]') THEN plain
        ELSE 'export_' || plain END AS lettered FROM s),
n AS (SELECT url, substring(trim(regexp_replace(lettered, '_+', '_', 'g'), '_'), 1, 50) AS name FROM p)
SELECT url, name AS table_name, name || '_2024_01' AS period_table, '2024-01' AS billing_period FROM n""",
)
def table_names(spark, folder):
    pages = table(spark, folder, "pages")
    named = names.period_table_name(F.col("url"), F.lit("2024-01"))
    return pages.select(
        "url",
        names.table_name(F.col("url")).alias("table_name"),
        named.alias("period_table"),
        names.period_of_table(named).alias("billing_period"),
    )
