"""Registered queries: restated lines, centres that serve one another, seasonal costs, a mart kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.operators import marts, reciprocal, restatement, seasonal
from spendloom.operators.allocation import monthly_mart
from spendloom.operators.lake import BillingLake
from spendloom.plans.registry import query
from spendloom.plans.star_billing import table
from spendloom.session import scratch_folder

# ---- restated lines -------------------------------------------------------------------------
# The second version lacks every seventh order, doubles the lines of every eleventh, and reprices every fifth.
_VERSIONS = """
WITH o AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, l_orderkey AS k, l_linestatus AS mode,
         CAST(l_quantity AS DECIMAL(12,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS cost FROM lineitem),
n AS (SELECT id, CASE WHEN k % 13 = 0 THEN NULL ELSE mode END AS mode, quantity, CASE WHEN k % 5 = 0 THEN cost + 1 ELSE cost END AS cost
      FROM o CROSS JOIN range(2) t(i) WHERE k % 7 <> 0 AND (i = 0 OR k % 11 = 0)),
d AS (SELECT id, mode, quantity, cost, SUM(side) AS more FROM (SELECT id, mode, quantity, cost, -1 AS side FROM o UNION ALL SELECT *, 1 FROM n)
      GROUP BY 1, 2, 3, 4 HAVING SUM(side) <> 0),
s AS (SELECT id, CAST(SUM(GREATEST(more, 0)) AS BIGINT) AS a, CAST(SUM(GREATEST(-more, 0)) AS BIGINT) AS r,
        SUM(GREATEST(-more, 0) * cost) AS old_cost, SUM(GREATEST(more, 0) * cost) AS new_cost FROM d GROUP BY 1)
"""


def _versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    key, price = F.col("l_orderkey"), F.col("l_extendedprice").cast("decimal(12,2)")
    item = table(spark, folder, "lineitem").select(
        F.concat_ws("-", key.cast("string"), F.col("l_linenumber").cast("string")).alias("id"), key.alias("k"),
        F.col("l_linestatus").alias("mode"), F.col("l_quantity").cast("decimal(12,2)").alias("quantity"), price.alias("cost"),
    )
    kept = item.where("k % 7 <> 0").withColumn("copy", F.explode(F.when(F.col("k") % 11 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    cost = F.when(F.col("k") % 5 == 0, F.col("cost") + 1).otherwise(F.col("cost"))
    new = kept.withColumns({"mode": F.when(F.col("k") % 13 != 0, F.col("mode")), "cost": cost})
    return item.drop("k"), new.drop("k", "copy")


@query(
    "restated_lines",
    _VERSIONS + """SELECT id, a - LEAST(a, r) AS added, r - LEAST(a, r) AS removed, LEAST(a, r) AS changed, CAST(old_cost AS DOUBLE) AS old_cost,
       CAST(new_cost AS DOUBLE) AS new_cost, CAST(new_cost - old_cost AS DOUBLE) AS cost_delta FROM s""",
)
def restated_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items against a version with lines gone, doubled and repriced."""
    return restatement.restated_lines(*_versions(spark, folder), "id", "cost")


@query(
    "restatement_summary",
    _VERSIONS + """SELECT COUNT(*) AS line_ids, CAST(SUM(a - LEAST(a, r)) AS BIGINT) AS added, CAST(SUM(r - LEAST(a, r)) AS BIGINT) AS removed,
       CAST(SUM(LEAST(a, r)) AS BIGINT) AS changed, CAST(SUM(new_cost - old_cost) AS DOUBLE) AS cost_delta FROM s""",
)
def restatement_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The same in one row."""
    return restatement.restatement_summary(restatement.restated_lines(*_versions(spark, folder), "id", "cost", ("mode", "cost")))


# ---- centres that serve one another -----------------------------------------------------------
# Line items of flags A and R belong to serving centres, those of N to owners; orders are the services they give.
_CENTRES = """
WITH c AS (SELECT strftime(l_shipdate, '%Y') AS billing_period, CASE l_returnflag WHEN 'N' THEN 'N' || CAST(l_linenumber AS VARCHAR) ELSE l_returnflag END AS centre,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS cost FROM lineitem GROUP BY 1, 2),
w AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'A' ELSE 'R' END AS origin,
         CASE WHEN o_custkey % 3 = 0 THEN CASE o_orderstatus WHEN 'F' THEN 'R' ELSE 'A' END ELSE 'N' || CAST(1 + o_custkey % 7 AS VARCHAR) END AS target,
         COUNT(*) AS weight FROM orders GROUP BY 1, 2),
b AS (SELECT p.billing_period, COALESCE(MAX(cost) FILTER (centre = 'A'), 0) AS a, COALESCE(MAX(cost) FILTER (centre = 'R'), 0) AS r
      FROM (SELECT DISTINCT billing_period FROM c) p JOIN c USING (billing_period) GROUP BY 1),
o AS (SELECT DISTINCT target AS owner FROM w WHERE target LIKE 'N%' UNION SELECT DISTINCT centre FROM c WHERE centre LIKE 'N%'),
"""


def _centres(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    flag = F.col("l_returnflag")
    costs = table(spark, folder, "lineitem").groupBy(
        F.date_format("l_shipdate", "yyyy").alias("billing_period"),
        F.when(flag == "N", F.concat(flag, F.col("l_linenumber").cast("string"))).otherwise(flag).alias("centre"),
    ).agg(F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("cost"))
    finished, customer = F.col("o_orderstatus") == "F", F.col("o_custkey")
    serves = F.when(customer % 3 == 0, F.when(finished, "R").otherwise("A")).otherwise(F.concat(F.lit("N"), (customer % 7 + 1).cast("string")))
    weights = table(spark, folder, "orders").groupBy(F.when(finished, "A").otherwise("R").alias("origin"), serves.alias("target")).agg(F.count("*").alias("weight"))
    return costs, weights


def _rounded(found: DataFrame) -> DataFrame:
    return found.select("billing_period", "owner", *[F.round(name, 2).alias(name) for name in ("own_cost", "allocated_cost")])


_OWNERS = """SELECT b.billing_period, owner, ROUND(COALESCE(c.cost, 0), 2) AS own_cost, ROUND(COALESCE(c.cost, 0) + xa * COALESCE(wa.share, 0) + xr * COALESCE(wr.share, 0), 2) AS allocated_cost
FROM x b CROSS JOIN o LEFT JOIN c ON c.billing_period = b.billing_period AND c.centre = owner
LEFT JOIN s wa ON wa.origin = 'A' AND wa.target = owner LEFT JOIN s wr ON wr.origin = 'R' AND wr.target = owner
WHERE c.cost IS NOT NULL OR (xa > 0 AND wa.share IS NOT NULL) OR (xr > 0 AND wr.share IS NOT NULL)"""


@query(
    "allocation_reciprocal",
    _CENTRES + """s AS (SELECT origin, target, weight / SUM(weight) OVER (PARTITION BY origin) AS share FROM w),
k AS (SELECT COALESCE(MAX(share) FILTER (origin = 'A' AND target = 'R'), 0) AS ar, COALESCE(MAX(share) FILTER (origin = 'R' AND target = 'A'), 0) AS ra FROM s),
x AS (SELECT billing_period, (a + ra * r) / (1 - ar * ra) AS xa, (r + ar * a) / (1 - ar * ra) AS xr FROM b, k)
""" + _OWNERS,
)
def allocation_reciprocal(spark: SparkSession, folder: str) -> DataFrame:
    """Two centres that serve one another and seven owners; the SQL solves the equations."""
    return _rounded(reciprocal.allocate_reciprocal(*_centres(spark, folder)))


@query(
    "allocation_step_down",
    _CENTRES + """s AS (SELECT origin, target, weight / SUM(weight) OVER (PARTITION BY origin) AS share FROM w WHERE NOT (origin = 'R' AND target = 'A')),
k AS (SELECT COALESCE(MAX(share) FILTER (origin = 'A' AND target = 'R'), 0) AS ar FROM s),
x AS (SELECT billing_period, a AS xa, r + ar * a AS xr FROM b, k)
""" + _OWNERS,
)
def allocation_step_down(spark: SparkSession, folder: str) -> DataFrame:
    """The same, one centre after the other."""
    return _rounded(reciprocal.allocate_step_down(*_centres(spark, folder), ["A", "R"]))


# ---- seasonal costs -------------------------------------------------------------------------------
_SMOOTHED = """
WITH RECURSIVE t AS (SELECT o_orderpriority AS key, CAST(o_orderdate AS DATE) AS date, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS cost FROM orders GROUP BY 1, 2),
span AS (SELECT key, MIN(date) AS first, MAX(date) AS last FROM t GROUP BY 1),
d AS (SELECT span.key, g.n AS n, first + CAST(g.n AS INTEGER) AS date, COALESCE(cost, 0) AS cost
      FROM span JOIN (SELECT unnest(range(4000)) AS n) g ON g.n <= last - first LEFT JOIN t ON t.key = span.key AND t.date = first + CAST(g.n AS INTEGER)),
w AS (SELECT key, (MAX(cost) FILTER (n = 0) + MAX(cost) FILTER (n = 1) + MAX(cost) FILTER (n = 2) + MAX(cost) FILTER (n = 3) + MAX(cost) FILTER (n = 4)
        + MAX(cost) FILTER (n = 5) + MAX(cost) FILTER (n = 6)) / 7 AS level, list(cost ORDER BY n) AS costs FROM d WHERE n < 7 GROUP BY 1),
f AS (SELECT key, CAST(6 AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS told, CAST(NULL AS DOUBLE) AS cost, level, list_transform(costs, lambda c: c - level) AS factors FROM w
  UNION ALL SELECT f.key, f.n + 1, f.level + factors[1], d.cost, f.level + (d.cost - (f.level + factors[1])) * 0.25,
      list_append(factors[2:], factors[1] + (d.cost - (f.level + factors[1])) * 0.125) FROM f JOIN d ON d.key = f.key AND d.n = f.n + 1),
e AS (SELECT key, n, told, cost, cost - told AS error FROM f WHERE told IS NOT NULL),
m AS (SELECT key, median(error) AS centre FROM e GROUP BY 1),
p AS (SELECT key, centre, median(abs(error - centre)) AS spread FROM e JOIN m USING (key) GROUP BY 1, 2)
"""


@query(
    "seasonal_forecast",
    _SMOOTHED + """SELECT key, CAST(span.first + CAST(f.n + ahead AS INTEGER) AS VARCHAR) AS date, ROUND(level + factors[ahead], 2) AS forecast,
       ROUND(level + factors[ahead] - spread * (3 * 1.4826), 2) AS low, ROUND(level + factors[ahead] + spread * (3 * 1.4826), 2) AS high
FROM f JOIN span USING (key) JOIN p USING (key) CROSS JOIN (SELECT unnest(range(1, 8)) AS ahead) WHERE f.n = span.last - span.first""",
)
def seasonal_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """The week after the last orders of each priority."""
    orders = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("key"), "o_orderdate", F.col("o_totalprice").cast("decimal(12,2)").alias("cost"))
    found = seasonal.seasonal_forecast(orders, "key", "cost", "o_orderdate")
    return found.select("key", "date", *[F.round(name, 2).alias(name) for name in ("forecast", "low", "high")])


@query(
    "seasonal_anomalies",
    _SMOOTHED + """SELECT key, CAST(span.first + CAST(n AS INTEGER) AS VARCHAR) AS date, ROUND(cost, 2) AS cost, ROUND(told, 2) AS expected
FROM e JOIN p USING (key) JOIN span USING (key) WHERE abs(error - centre) > spread * (3 * 1.4826)""",
)
def seasonal_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """Days of a priority whose orders are out of line with their weekday."""
    orders = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("key"), "o_orderdate", F.col("o_totalprice").cast("decimal(12,2)").alias("cost"))
    found = seasonal.seasonal_anomalies(orders, "key", "cost", "o_orderdate")
    return found.select("key", "date", *[F.round(name, 2).alias(name) for name in ("cost", "expected")])


# ---- a mart kept up to date -----------------------------------------------------------------------
@query(
    "mart_refresh",
    """WITH l AS (SELECT l_returnflag AS flag, 's' || CAST(l_linenumber AS VARCHAR) AS service_name, CAST(l_suppkey % 10 AS VARCHAR) AS account_id,
  CASE l_linestatus WHEN 'F' THEN 'Usage' ELSE 'Purchase' END AS charge_category, CAST(l_quantity AS DECIMAL(12,2)) AS q, CAST(l_extendedprice AS DECIMAL(12,2)) AS c FROM lineitem)
SELECT CASE flag WHEN 'A' THEN '2024-01' ELSE '2024-02' END AS billing_period, service_name, account_id, charge_category, COUNT(*) AS line_items,
  CAST(SUM(q) AS DOUBLE) AS usage_quantity, CAST(SUM(c) AS DOUBLE) AS billed_cost,
  CAST(SUM(CASE flag WHEN 'A' THEN 2 ELSE 1 END * c) AS DOUBLE) AS effective_cost, flag = 'A' AS rebuilt
FROM l WHERE flag <> 'R' GROUP BY flag, 2, 3, 4""",
)
def mart_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Three periods are built, one is restated and one emptied; the second refresh leaves the third period's files."""
    root = scratch_folder(spark)
    lake = BillingLake(spark, root, "aws", "star")
    item = table(spark, folder, "lineitem")

    def lines(flag: str, factor: int = 1) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        return item.where(F.col("l_returnflag") == flag).select(
            F.concat(F.lit("s"), F.col("l_linenumber").cast("string")).alias("service_name"), (F.col("l_suppkey") % 10).cast("string").alias("account_id"),
            F.when(F.col("l_linestatus") == "F", "Usage").otherwise("Purchase").alias("charge_category"),
            F.col("l_quantity").cast("decimal(12,2)").alias("usage_quantity"), price.alias("billed_cost"), (price * factor).cast("decimal(14,2)").alias("effective_cost"),
        )

    def build(unified: DataFrame) -> DataFrame:
        return monthly_mart(unified, ("load_id",))

    for period, flag in (("2024-01", "A"), ("2024-02", "N"), ("2024-03", "R")):
        lake.replace_period(lambda flag=flag: lines(flag), period, "first", "v1", 1)
    path = f"{root}/mart"
    marts.refresh_mart(lake, path, build)
    lake.replace_period(lambda: lines("A", 2), "2024-01", "second", "v1", 1)
    lake.replace_period(lambda: lines("R").where("billed_cost IS NULL"), "2024-03", "second", "v1", 1)
    rebuilt = marts.refresh_mart(lake, path, build)
    mart = marts.read_mart(lake, path).drop("load_id")
    return mart.withColumn("rebuilt", F.col("billing_period").isin(rebuilt))
