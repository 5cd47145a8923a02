"""Registered queries: sketches per period, coverage by commitments, rates as of a day, tags down a tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.functions import scalars as S
from spendloom.operators import account_tree, commitments, rates, sketches
from spendloom.plans.registry import query
from spendloom.plans.star_billing import table
from spendloom.session import scratch_folder


# ---- sketches ---------------------------------------------------------------------------
@query(
    "period_sketches",
    """WITH o AS (SELECT strftime(o_orderdate, '%Y') AS billing_period, o_custkey FROM orders)
SELECT billing_period, COUNT(*) AS records, COUNT(DISTINCT o_custkey) AS customers, TRUE AS distinct_within, TRUE AS median_within FROM o GROUP BY 1
UNION ALL SELECT 'all', COUNT(*), COUNT(DISTINCT o_custkey), TRUE, TRUE FROM o""",
)
def period_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the stored sketches of each year, and merged ones of all years, keep their error bounds."""
    orders = table(spark, folder, "orders").select(F.date_format("o_orderdate", "yyyy").alias("billing_period"), "o_custkey", "o_totalprice")
    path = scratch_folder(spark)
    sketches.period_sketches(orders, F.col("billing_period"), ["o_custkey"], ["o_totalprice"]).write.parquet(path)
    stored = spark.read.parquet(path)
    whole = sketches.merged_sketches(stored).withColumn("billing_period", F.lit("all"))
    told = stored.unionByName(whole).select(
        "billing_period", "records", sketches.distinct_count("o_custkey").alias("about"), sketches.quantile("o_totalprice", 0.5).alias("median")
    )
    both = orders.unionByName(orders.withColumn("billing_period", F.lit("all")))
    ranked = both.join(F.broadcast(told.select("billing_period", "median")), "billing_period")  # a row for each year
    exact = ranked.groupBy("billing_period").agg(
        F.count_distinct("o_custkey").alias("customers"), F.avg((F.col("o_totalprice") <= F.col("median")).cast("double")).alias("rank")
    )
    return told.join(exact, "billing_period").select(
        "billing_period",
        "records",
        "customers",
        (F.abs(F.col("about") - F.col("customers")) <= sketches.DISTINCT_ERROR * F.col("customers")).alias("distinct_within"),
        (F.abs(F.col("rank") - 0.5) <= 2 * sketches.RANK_ERROR).alias("median_within"),
    )


@query(
    "distribution_comparison",
    """SELECT * FROM (VALUES ('open', TRUE, TRUE), ('dearer', TRUE, FALSE), ('few_customers', FALSE, TRUE)) AS t(candidate, customers_ok, price_ok)
WHERE (SELECT COUNT(*) FROM orders) > 0""",
)
def distribution_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Finished orders against open ones, against dearer ones and against those of few customers."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_totalprice", "o_orderstatus")
    few = orders.where("o_orderstatus = 'O'").withColumn("o_custkey", F.col("o_custkey") % 7)
    open_ones = orders.where("o_orderstatus = 'O'")
    sides = {"open": open_ones, "dearer": open_ones.withColumn("o_totalprice", F.col("o_totalprice") * 1.7), "few_customers": few}

    def one(rows: DataFrame) -> DataFrame:
        kinds = (["o_custkey"], ["o_totalprice"])
        return sketches.merged_sketches(sketches.period_sketches(rows, F.lit("all"), *kinds))

    finished = one(orders.where("o_orderstatus = 'F'"))
    found = [
        sketches.compare_distributions(finished, one(rows), ["o_custkey"], ["o_totalprice"]).select(
            F.lit(name).alias("candidate"), F.col("o_custkey_ok").alias("customers_ok"), F.col("o_totalprice_ok").alias("price_ok")
        )
        for name, rows in sides.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


# ---- commitments --------------------------------------------------------------------------
@query(
    "commitment_coverage",
    """WITH u AS (SELECT l_returnflag AS service, l_shipdate + INTERVAL (l_linenumber) HOUR AS s, CAST(1 + l_quantity AS BIGINT) AS h FROM lineitem),
c AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'N' ELSE 'X' END AS service, o_orderdate AS s,
        CAST(24 * (1 + o_orderkey % 5) AS BIGINT) AS h, CAST(o_custkey % 4 AS BIGINT) AS amount FROM orders),
uh AS (SELECT service, s + to_hours(i) AS hour, COUNT(*) AS used FROM (SELECT service, s, unnest(range(h)) AS i FROM u) GROUP BY 1, 2),
ch AS (SELECT service, s + to_hours(i) AS hour, SUM(amount) AS committed FROM (SELECT service, s, amount, unnest(range(h)) AS i FROM c) GROUP BY 1, 2)
SELECT service, strftime(hour, '%Y-%m-%d') AS date, CAST(SUM(COALESCE(used, 0)) AS DOUBLE) AS used_hours,
       CAST(SUM(COALESCE(committed, 0)) AS DOUBLE) AS committed_hours,
       CAST(SUM(LEAST(COALESCE(used, 0), COALESCE(committed, 0))) AS DOUBLE) AS covered_hours
FROM uh FULL JOIN ch USING (service, hour) GROUP BY 1, 2""",
)
def commitment_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as use of some hours, orders as commitments of some days, by service and day."""
    start = F.col("l_shipdate") + F.make_interval(hours=F.col("l_linenumber"))
    use = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("service"),
        start.alias("start"),
        (start + F.make_interval(hours=(1 + F.col("l_quantity")).cast("int"))).alias("end"),
        F.lit(1).alias("amount"),
    )
    status = F.col("o_orderstatus")
    committed = table(spark, folder, "orders").select(
        F.when(status == "F", "A").when(status == "O", "N").otherwise("X").alias("service"),
        F.col("o_orderdate").alias("start"),
        (F.col("o_orderdate") + F.make_interval(days=(1 + F.col("o_orderkey") % 5).cast("int"))).alias("end"),
        (F.col("o_custkey") % 4).alias("amount"),
    )
    return commitments.commitment_coverage(use, committed, "service")


# ---- rates ------------------------------------------------------------------------------------
@query(
    "currency_as_of",
    """WITH l AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'USD' WHEN 'O' THEN 'EUR' ELSE 'GBP' END AS currency, CAST(o_orderdate AS DATE) AS date,
       COUNT(*) AS line_items, SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS cost FROM orders GROUP BY 1, 2),
r AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'EUR' ELSE 'GBP' END AS currency, CAST(l_shipdate AS DATE) AS date,
       MAX(1 + CAST(l_tax AS DECIMAL(4,2))) AS rate FROM lineitem
     WHERE l_suppkey % 9 = 0 AND (l_linenumber % 2 = 0 OR year(l_shipdate) BETWEEN 1997 AND 1998) GROUP BY 1, 2)
SELECT currency, strftime(date, '%Y-%m-%d') AS date, line_items, CAST(cost AS DOUBLE) AS cost, CAST(rate AS DOUBLE) AS rate,
       CAST(cost * rate AS DOUBLE) AS converted_cost FROM (
  SELECT l.currency, l.date, line_items, cost, CASE WHEN l.currency = 'USD' THEN 1 WHEN date_diff('day', r.date, l.date) <= 400 THEN rate END AS rate
  FROM l ASOF LEFT JOIN r ON l.currency = r.currency AND l.date >= r.date)""",
)
def currency_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Each day's orders in dollars by the last rate; pounds have rates for two years only."""
    status = F.col("o_orderstatus")
    lines = table(spark, folder, "orders").select(
        F.when(status == "F", "USD").when(status == "O", "EUR").otherwise("GBP").alias("currency"), "o_orderdate", "o_totalprice"
    )
    even = F.col("l_linenumber") % 2 == 0
    chosen = table(spark, folder, "lineitem").where((F.col("l_suppkey") % 9 == 0) & (even | F.year("l_shipdate").between(1997, 1998)))
    published = chosen.select(
        F.when(even, "EUR").otherwise("GBP").alias("currency"), F.col("l_shipdate").alias("date"), (F.lit(1) + F.col("l_tax").cast("decimal(4,2)")).alias("rate")
    )
    return rates.daily_costs_as_of(lines, published, "o_totalprice", "o_orderdate", oldest=400).drop("rate_date")


# ---- tags down a tree ---------------------------------------------------------------------------
@query(
    "inherited_tags_tree",
    """WITH RECURSIVE a AS (SELECT c_custkey AS account, CASE WHEN c_custkey > 0 THEN c_custkey // 2 END AS parent,
       CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment END AS team, CASE WHEN c_custkey % 5 = 0 THEN 'e' || CAST(c_nationkey AS VARCHAR) END AS env FROM customer),
w AS (SELECT account, 0 AS depth, team, env FROM a WHERE parent IS NULL OR parent NOT IN (SELECT account FROM a)
  UNION ALL SELECT a.account, depth + 1, COALESCE(a.team, w.team), COALESCE(a.env, w.env) FROM w JOIN a ON a.parent = w.account)
SELECT account, depth, team, env FROM w""",
)
def inherited_tags_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as a tree of accounts whose tags are handed down."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    own = table(spark, folder, "customer").select(
        key.alias("account"),
        F.when(key > 0, F.floor(key / 2)).alias("parent"),
        F.when(F.col("c_nationkey") % 3 == 0, F.col("c_mktsegment")).alias("team"),
        F.when(key % 5 == 0, F.concat(F.lit("e"), nation)).alias("env"),
    )
    accounts = own.select("account", "parent", S.tags_from_columns({"team": "team", "env": "env"}).alias("tags"))
    found = account_tree.tags_of_accounts(accounts)
    return found.select("account", "depth", *[F.try_element_at("tags", F.lit(name)).alias(name) for name in ("team", "env")])
