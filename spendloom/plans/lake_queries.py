"""Registered queries: manifests, imports, load state and catalogues.

Manifests and load events are derived from the orders and line items, so there are
as many of them as the tables have periods, and the folds grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from spendloom.functions import scalars as S
from spendloom.functions.names import clean_columns
from spendloom.operators import quality, state
from spendloom.operators.lake import BillingLake
from spendloom.plans.imports import import_export
from spendloom.plans.registry import query
from spendloom.plans.star_billing import table
from spendloom.session import scratch_folder
from spendloom.sources import manifests as M
from spendloom.sources.reports import report_union, typed_columns

# ---- load state --------------------------------------------------------------------
# Every order starts a load; a finished or partial one also completes or fails it.
EVENTS = """
WITH base AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'aws' WHEN '2-HIGH' THEN 'aws'
              WHEN '3-MEDIUM' THEN 'gcp' ELSE 'azure' END AS vendor,
         o_orderpriority AS export_name, strftime(o_orderdate, '%Y-%m') AS billing_period,
         'v' || right(CAST(o_custkey AS VARCHAR), 1) AS version_id, o_orderstatus AS status,
         o_orderkey, o_orderdate, o_custkey, CAST(floor(o_totalprice) AS BIGINT) AS row_count FROM orders),
ev AS (SELECT vendor, export_name, billing_period, version_id, 'started' AS event, o_orderkey * 2 AS seq,
         o_orderdate AS ts, o_custkey AS file_count, NULL AS row_count,
         'f' || CAST(o_orderkey AS VARCHAR) AS format, NULL AS error FROM base
  UNION ALL SELECT vendor, export_name, billing_period, version_id,
         CASE status WHEN 'F' THEN 'completed' ELSE 'failed' END, o_orderkey * 2 + 1, o_orderdate, NULL,
         CASE status WHEN 'F' THEN row_count END, NULL,
         CASE status WHEN 'P' THEN 'error ' || CAST(o_orderkey AS VARCHAR) END FROM base WHERE status <> 'O'),
folded AS (SELECT vendor, export_name, billing_period, version_id,
         arg_min(format, seq) FILTER (event = 'started') AS format,
         arg_max(ts, seq) FILTER (event = 'started') AS load_timestamp,
         arg_max(file_count, seq) FILTER (event = 'started') AS file_count,
         arg_max(row_count, seq) FILTER (event = 'completed') AS row_count,
         arg_max(event, seq) AS last_event, MAX(seq) AS last_seq FROM ev GROUP BY 1, 2, 3, 4),
cur AS (SELECT vendor, export_name, billing_period, arg_max(version_id, seq) AS current_id
        FROM ev WHERE event = 'completed' GROUP BY 1, 2, 3),
state AS (SELECT folded.vendor AS vendor, folded.export_name AS export_name,
         folded.billing_period AS billing_period, version_id, format AS data_format_version,
         COALESCE(version_id = current_id, FALSE) AS current_version,
         strftime(load_timestamp, '%Y-%m-%d %H:%M:%S') AS load_timestamp,
         last_event = 'completed' AS load_completed, COALESCE(folded.row_count, -1) AS row_count,
         folded.file_count AS file_count,
         CASE WHEN last_event = 'failed' THEN (SELECT error FROM ev WHERE seq = last_seq) END AS error_message
  FROM folded LEFT JOIN cur ON folded.vendor = cur.vendor AND folded.export_name = cur.export_name
       AND folded.billing_period = cur.billing_period)
"""


def _events(spark, folder):
    orders = table(spark, folder, "orders")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    vendor = (
        F.when(priority.isin("1-URGENT", "2-HIGH"), "aws")
        .when(priority == "3-MEDIUM", "gcp")
        .otherwise("azure")
    )
    key = F.col("o_orderkey").cast("string")
    base = orders.select(
        vendor.alias("vendor"),
        priority.alias("export_name"),
        S.billing_period(F.col("o_orderdate")).alias("billing_period"),
        F.concat(F.lit("v"), F.right(F.col("o_custkey").cast("string"), F.lit(1))).alias("version_id"),
        key.alias("load_id"),
        F.array(
            F.struct(
                F.lit(state.STARTED).alias("event"),
                (F.col("o_orderkey") * 2).alias("seq"),
                F.col("o_custkey").alias("file_count"),
                F.lit(None).cast("long").alias("row_count"),
                F.concat(F.lit("f"), key).alias("data_format_version"),
                F.lit(None).cast("string").alias("error_message"),
            ),
            F.when(
                status != "O",
                F.struct(
                    F.when(status == "F", state.COMPLETED).otherwise(state.FAILED).alias("event"),
                    (F.col("o_orderkey") * 2 + 1).alias("seq"),
                    F.lit(None).cast("long").alias("file_count"),
                    F.when(status == "F", F.floor("o_totalprice")).cast("long").alias("row_count"),
                    F.lit(None).cast("string").alias("data_format_version"),
                    F.when(status == "P", F.concat(F.lit("error "), key)).alias("error_message"),
                ),
            ),
        ).alias("steps"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
    )
    return (
        base.select("*", F.explode("steps").alias("step"))
        .where(F.col("step").isNotNull())
        .select("vendor", "export_name", "billing_period", "version_id", "load_id", "ts", "step.*")
        .withColumn("load_schema", F.lit(None).cast("string"))
    )


def _state(spark, folder):
    return state.fold_events(_events(spark, folder)).fillna(-1, ["row_count"])


@query("load_state_fold", EVENTS + "SELECT * FROM state")
def load_state_fold(spark, folder):
    return _state(spark, folder)


@query(
    "current_versions",
    EVENTS
    + """SELECT billing_period, version_id, data_format_version, load_timestamp, row_count, file_count
FROM state WHERE vendor = 'aws' AND export_name = '2-HIGH' AND current_version""",
)
def current_versions(spark, folder):
    return state.current_versions(_state(spark, folder), "aws", "2-HIGH")


@query(
    "version_history",
    EVENTS
    + """SELECT version_id, data_format_version, current_version, load_timestamp, load_completed,
       row_count, file_count, error_message
FROM state WHERE vendor = 'gcp' AND export_name = '3-MEDIUM' AND billing_period = '1998-03'""",
)
def version_history(spark, folder):
    return state.version_history(_state(spark, folder), "gcp", "3-MEDIUM", "1998-03")


@query(
    "show_state",
    EVENTS
    + """SELECT left(version_id, 40) AS version_id, data_format_version, current_version,
       CASE WHEN load_completed THEN 'Complete' WHEN error_message IS NOT NULL THEN 'Failed'
            ELSE 'In Progress' END AS status, row_count, load_timestamp, error_message
FROM state WHERE vendor = 'azure' AND export_name = '5-LOW' AND billing_period = '1996-07'""",
)
def show_state(spark, folder):
    return state.show_state(_state(spark, folder), "azure", "5-LOW", "1996-07")


TABLES = """, tables AS (SELECT vendor, export_name, billing_period,
       'export_' || replace(replace(lower(export_name), '-', '_'), ' ', '_') || '_' || replace(billing_period, '-', '_') AS table_name,
       arg_max(row_count, seq) AS rows, arg_max(version_id, seq) AS version_id
FROM ev WHERE event = 'completed' GROUP BY 1, 2, 3, 4)
"""


def _tables(spark, folder):
    return state.period_tables(state.current_loads(_events(spark, folder)))


@query("period_tables", EVENTS + TABLES + "SELECT * FROM tables")
def period_tables(spark, folder):
    return _tables(spark, folder)


@query(
    "tables_of_export",
    EVENTS + TABLES + "SELECT * FROM tables WHERE vendor = 'azure' AND export_name = '5-LOW'",
)
def tables_of_export(spark, folder):
    return state.tables_of_export(_tables(spark, folder), "azure", "5-LOW")


@query(
    "load_summary",
    EVENTS
    + TABLES
    + """SELECT vendor, export_name, billing_period, table_name, rows, left(version_id, 8) AS version,
       CAST(SUM(rows) OVER (PARTITION BY vendor, export_name) AS BIGINT) AS total_rows FROM tables""",
)
def load_summary(spark, folder):
    return state.load_summary(_tables(spark, folder), _state(spark, folder))


@query(
    "exports_catalogue",
    EVENTS
    + TABLES
    + """, e AS (SELECT DISTINCT vendor, export_name FROM state WHERE load_completed)
SELECT e.vendor AS vendor, e.export_name AS export_name, COUNT(table_name) AS tables,
       CAST(COALESCE(SUM(rows), 0) AS BIGINT) AS total_rows,
       (SELECT COUNT(*) FROM e AS x WHERE x.vendor = e.vendor) AS vendor_exports
FROM e LEFT JOIN tables ON e.vendor = tables.vendor AND e.export_name = tables.export_name
GROUP BY 1, 2""",
)
def exports_catalogue(spark, folder):
    return state.exports_catalogue(_state(spark, folder), _tables(spark, folder))


@query(
    "is_version_loaded",
    EVENTS
    + """SELECT vendor, export_name, billing_period, version_id FROM
  (SELECT DISTINCT vendor, export_name, billing_period, version_id FROM base WHERE status = 'O')
  WHERE (vendor, export_name, billing_period, version_id) IN
        (SELECT (vendor, export_name, billing_period, version_id) FROM state WHERE load_completed)""",
)
def is_version_loaded(spark, folder):
    events = _events(spark, folder)
    # Versions with a start that nothing followed: an order that is still open.
    open_loads = events.groupBy("load_id", *state.VERSION_KEY).agg(F.count(F.lit(1)).alias("n"))
    asked = open_loads.where("n = 1").select(*state.VERSION_KEY).distinct()
    return state.is_version_loaded(_state(spark, folder), asked)


# ---- manifests -----------------------------------------------------------------------
# One manifest per month of orders and report version; file names and ids come from the orders.
MANIFESTS = """
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS billing_period, MAX(o_orderkey) AS top,
         COUNT(*) AS n, date_trunc('month', MIN(o_orderdate)) AS first_day FROM orders GROUP BY 1)
"""


def _manifest_objects(spark, folder):
    """(key, content) of v1 and v2 manifests, and objects that are not manifests."""
    months = (
        table(spark, folder, "orders")
        .groupBy(S.billing_period(F.col("o_orderdate")).alias("p"))
        .agg(F.max("o_orderkey").alias("top"), F.count(F.lit(1)).alias("n"))
    )
    period, top = F.col("p"), F.col("top").cast("string")
    start = F.date_format(S.period_start(period), "yyyyMMdd")
    end = F.date_format(S.period_end(period), "yyyyMMdd")
    v1_body = F.to_json(
        F.struct(
            F.concat(F.lit("asm-"), top).alias("assemblyId"),
            F.when(F.col("n") % 2 == 0, "123456789012").alias("account"),
            F.array(F.concat(F.lit("cur/"), top, F.lit("-1.csv.gz")),
                    F.concat(F.lit("cur/"), top, F.lit("-2.csv"))).alias("reportKeys"),
            F.array(
                F.struct(F.lit("lineItemColumns").alias("category"), F.lit("lineItem/UsageAmount").alias("name"))
            ).alias("columns"),
            F.struct(
                S.iso_text(S.period_start(period)).alias("start"), S.iso_text(S.period_end(period)).alias("end")
            ).alias("billingPeriod"),
            F.lit("bkt").alias("bucket"),
        )
    )
    v2_body = F.to_json(
        F.struct(
            F.when(F.col("n") % 2 == 0, F.concat(F.lit("exec-"), top)).alias("executionId"),
            F.when(F.col("n") % 3 == 0, top).alias("lastModified"),
            F.array(F.concat(F.lit("s3://other/data/"), top, F.lit(".parquet"))).alias("dataFiles"),
            F.array(F.lit("ignored.csv")).alias("reportKeys"),
        )
    )
    keys = F.array(
        F.struct(
            F.concat(F.lit("cur/feed/"), start, F.lit("-"), end, F.lit("/feed-Manifest.json")).alias("key"),
            v1_body.alias("content"),
        ),
        F.struct(
            F.concat(F.lit("cur/feed/metadata/BILLING_PERIOD="), period, F.lit("/feed-Manifest.json")).alias("key"),
            v2_body.alias("content"),
        ),
        F.struct(
            F.concat(F.lit("cur/feed/"), start, F.lit("-"), end, F.lit("/feed-1.csv.gz")).alias("key"),
            F.lit("not json").alias("content"),
        ),
    )
    return months.select(F.inline(keys))


def _manifests(spark, folder, version, start=None, end=None):
    chosen = M.select_manifests(
        _manifest_objects(spark, folder), "bkt", "cur", "feed", version, start, end
    )
    return M.identified(M.parse_manifests(chosen))


@query(
    "manifest_version_ids",
    MANIFESTS
    + """SELECT billing_period, 'v1' AS version, 'asm-' || CAST(top AS VARCHAR) AS version_id, CAST(2 AS BIGINT) AS file_count,
       'cur/feed/' || strftime(first_day, '%Y%m%d') || '-' || strftime(first_day + INTERVAL 1 MONTH, '%Y%m%d')
         || '/feed-Manifest.json' AS key FROM m
UNION ALL SELECT billing_period, 'v2', CASE WHEN n % 2 = 0 THEN 'exec-' || CAST(top AS VARCHAR)
       ELSE billing_period || '_' || CASE WHEN n % 3 = 0 THEN CAST(top AS VARCHAR) ELSE 'unknown' END END, 1,
       'cur/feed/metadata/BILLING_PERIOD=' || billing_period || '/feed-Manifest.json' FROM m""",
)
def manifest_version_ids(spark, folder):
    both = _manifests(spark, folder, "v1").unionByName(_manifests(spark, folder, "v2"))
    return both.select("billing_period", "version", "version_id", "file_count", "key")


@query(
    "manifest_range",
    MANIFESTS
    + """SELECT billing_period, 'asm-' || CAST(top AS VARCHAR) AS version_id FROM m
WHERE billing_period >= '1996-03' AND billing_period <= '1999-11'""",
)
def manifest_range(spark, folder):
    chosen = _manifests(spark, folder, "v1", "1996-03", "1999-11")
    return chosen.select("billing_period", "version_id")


@query(
    "report_files",
    MANIFESTS
    + """SELECT billing_period, 0 AS position, 'bkt' AS bucket, 'cur/' || CAST(top AS VARCHAR) || '-1.csv.gz' AS key,
       'csv' AS format FROM m
UNION ALL SELECT billing_period, 1, 'bkt', 'cur/' || CAST(top AS VARCHAR) || '-2.csv', 'csv' FROM m
UNION ALL SELECT billing_period, 0, 'other', 'data/' || CAST(top AS VARCHAR) || '.parquet', 'parquet' FROM m""",
)
def report_files(spark, folder):
    both = _manifests(spark, folder, "v1").unionByName(_manifests(spark, folder, "v2"))
    return M.report_files(both).drop("version_id")


@query(
    "pending_periods",
    MANIFESTS
    + """SELECT billing_period, 'asm-' || CAST(top AS VARCHAR) AS version_id FROM m
WHERE (billing_period, top) NOT IN (SELECT (strftime(o_orderdate, '%Y-%m'), o_orderkey) FROM orders
                                    WHERE o_orderstatus = 'F')""",
)
def pending_periods(spark, folder):
    # A version is loaded when its own order is finished.
    orders = table(spark, folder, "orders")
    loads = orders.where(F.col("o_orderstatus") == "F").select(
        F.lit("aws").alias("vendor"),
        F.lit("feed").alias("export_name"),
        S.billing_period(F.col("o_orderdate")).alias("billing_period"),
        F.concat(F.lit("asm-"), F.col("o_orderkey").cast("string")).alias("version_id"),
        F.lit(True).alias("load_completed"),
    )
    asked = _manifests(spark, folder, "v1").withColumns(
        {"vendor": F.lit("aws"), "export_name": F.lit("feed")}
    )
    return state.pending_versions(asked, loads).select("billing_period", "version_id")


@query(
    "manifest_quality",
    MANIFESTS
    + """, k AS (SELECT billing_period, n, top, 'cur/feed/' || strftime(first_day, '%Y%m%d') || '-'
       || strftime(first_day + INTERVAL 1 MONTH, '%Y%m%d') || '/feed-Manifest.json' AS key FROM m)
SELECT 'manifest_' || field AS rule, billing_period, 1 AS n_rows, key AS sample
FROM k, (SELECT unnest(['charset', 'compression', 'contentType', 'reportId', 'reportName']) AS field)
UNION ALL SELECT 'manifest_account', billing_period, 1, key FROM k WHERE n % 2 = 1
UNION ALL SELECT 'report_file_exists', billing_period, COUNT(*), MIN(f) FROM (
  SELECT billing_period, top, 'cur/' || CAST(top AS VARCHAR) || '-2.csv' AS f FROM k)
  WHERE top IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1, 2""",
)
def manifest_quality(spark, folder):
    # Partial orders lack their second report file.
    orders = table(spark, folder, "orders")
    stem = F.concat(F.lit("cur/"), F.col("o_orderkey").cast("string"))
    listing = orders.select(
        F.lit("bkt").alias("bucket"),
        F.explode(
            F.when(F.col("o_orderstatus") == "P", F.array(F.concat(stem, F.lit("-1.csv.gz")))).otherwise(
                F.array(F.concat(stem, F.lit("-1.csv.gz")), F.concat(stem, F.lit("-2.csv")))
            )
        ).alias("key"),
    )
    return quality.manifest_report(_manifests(spark, folder, "v1"), listing)


# ---- imports -------------------------------------------------------------------------
def _raw_lines(spark, folder):
    """Line items as text under raw report names; a period is a year of shipping."""
    shipped = F.col("l_shipdate")
    return table(spark, folder, "lineitem").select(
        F.concat(F.date_format(shipped, "yyyy"), F.lit("-01")).alias("feed_period"),
        F.lpad(F.col("l_orderkey").cast("string"), 12, "0").alias("lineItem/UsageAccountId"),
        S.iso_text(shipped).alias("lineItem/UsageStartDate"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("lineItem/UnblendedCost"),
        F.col("l_quantity").cast("decimal(12,2)").cast("string").alias("lineItem/UsageAmount"),
        F.concat(F.lit('say "'), F.col("l_linestatus"), F.lit('", ok')).alias("lineItem/Operation"),
        F.col("l_returnflag").alias("resourceTags/user:Owner"),
    )


INGEST_SQL = """SELECT strftime(l_shipdate, '%Y') || '-01' AS billing_period, COUNT(*) AS n,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS cost,
       CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS usage_amount,
       COUNT(DISTINCT l_orderkey) AS accounts, MIN(lpad(CAST(l_orderkey AS VARCHAR), 12, '0')) AS first_account,
       COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS tagged,
       MAX(strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')) AS last_start,
       MIN('say "' || l_linestatus || '", ok') AS first_operation
FROM lineitem GROUP BY 1"""


@query("csv_ingest", INGEST_SQL)
def csv_ingest(spark, folder):
    """Write drifting gzip reports, import them, and sum the unified view."""
    root = scratch_folder(spark)
    raw = _raw_lines(spark, folder)
    tag = "resourceTags/user:Owner"
    plain = raw.where(F.col(tag) != "R").drop(tag)
    tagged = raw.where(F.col(tag) == "R").select("feed_period", *reversed(raw.columns[1:]))
    for name, lines in (("plain", plain), ("tagged", tagged)):
        writer = lines.write.partitionBy("feed_period").option("header", "true")
        writer.option("escape", '"').option("compression", "gzip").csv(f"{root}/reports/{name}")
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv.gz")
        .load(f"{root}/reports")
    )
    period = F.regexp_extract("path", r"feed_period=(\d{4}-\d{2})", 1)
    manifests = (
        listing.select(period.alias("billing_period"), F.col("path"))
        .groupBy("billing_period")
        .agg(F.sort_array(F.collect_list("path")).alias("report_keys"))
        .select(
            F.lit("").alias("bucket"),
            F.col("billing_period").alias("key"),
            "billing_period",
            F.lit("v1").alias("version"),
            F.lit("first").alias("version_id"),
            "report_keys",
            F.size("report_keys").cast("long").alias("file_count"),
        )
    )
    lake = BillingLake(spark, f"{root}/lake", "aws", "star")
    import_export(lake, manifests, lambda _, key: key, periods_at_once=8)
    return (
        lake.unified_view()
        .groupBy("billing_period")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("line_item_unblended_cost").alias("cost"),
            F.sum("line_item_usage_amount").alias("usage_amount"),
            F.count_distinct("line_item_usage_account_id").alias("accounts"),
            F.min("line_item_usage_account_id").alias("first_account"),
            F.count("resource_tags_user_owner").alias("tagged"),
            F.max("line_item_usage_start_date").alias("last_start"),
            F.min("line_item_operation").alias("first_operation"),
        )
    )


@query(
    "period_replacement",
    """SELECT CASE l_returnflag WHEN 'A' THEN '2024-01' ELSE '2024-02' END AS billing_period,
       CASE l_returnflag WHEN 'A' THEN 'second' ELSE 'first' END AS version_id, COUNT(*) AS n,
       CAST(SUM(CASE WHEN l_returnflag = 'A' THEN 2 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS cost
FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY 1, 2""",
)
def period_replacement(spark, folder):
    """Three periods: one restated, one with a failed restatement, one emptied."""
    lake = BillingLake(spark, scratch_folder(spark), "aws", "star")
    item = table(spark, folder, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)")

    def lines(flag, factor=1):
        of_flag = item.where(F.col("l_returnflag") == flag)
        return of_flag.select("l_orderkey", (price * factor).cast("decimal(14,2)").alias("cost"))

    def broken():
        return lines("N", 2).withColumn("l_orderkey", F.raise_error(F.lit("broken file")).cast("long"))

    for period, flag in (("2024-01", "A"), ("2024-02", "N"), ("2024-03", "R")):
        lake.replace_period(lambda flag=flag: lines(flag), period, "first", "v1", 1)
    lake.replace_period(lambda: lines("A", 2), "2024-01", "second", "v1", 1)
    try:
        lake.replace_period(broken, "2024-02", "second", "v1", 1)
    except Exception as error:
        if "broken file" not in str(error):
            raise
    lake.replace_period(lambda: lines("R").where(F.col("cost").isNull()), "2024-03", "second", "v1", 1)
    return (
        lake.unified_view()
        .groupBy("billing_period", "version_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("cost").alias("cost"))
    )


@query(
    "compacted_state",
    """SELECT CASE l_returnflag WHEN 'A' THEN '2024-01' ELSE '2024-02' END AS billing_period,
       CASE l_returnflag WHEN 'A' THEN 'v2' ELSE 'v1' END AS version_id, COUNT(*) AS n, 6 AS events
FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2""",
)
def compacted_state(spark, folder):
    """Two periods are loaded, the log is compacted, one is restated after it; a fresh lake reads them."""
    lines = table(spark, folder, "lineitem").select("l_returnflag")
    root = scratch_folder(spark)
    lake = BillingLake(spark, root, "aws", "compacted")
    lake.replace_period(lambda: lines.where("l_returnflag = 'N'"), "2024-01", "v1", "f1", 1)
    lake.replace_period(lambda: lines.where("l_returnflag = 'R'"), "2024-02", "v1", "f1", 1)
    lake.compact_events()
    load = lake.start_load("2024-01", "v2", "f1", 1)
    rows, schema = lake.write_load(lines.where("l_returnflag = 'A'"), "2024-01", "v2", load)
    BillingLake(spark, root, "aws", "compacted").compact_events()  # while the load is open
    lake.complete_load("2024-01", "v2", load, rows, schema)
    fresh = BillingLake(spark, root, "aws", "compacted")
    served = fresh.unified_view().groupBy("billing_period", "version_id").agg(F.count(F.lit(1)).alias("n"))
    return served.withColumn("events", F.lit(fresh.events().count()).cast("int"))


@query(
    "unreadable_values",
    """SELECT l_returnflag, COUNT(*) AS n, COUNT(CASE WHEN l_linenumber < 7 THEN 1 END) AS readable,
       COUNT(CASE WHEN l_linenumber = 7 THEN 1 END) AS kept, MIN(CASE WHEN l_linenumber = 7 THEN 'bad '
         || l_linestatus END) AS least_kept
FROM lineitem GROUP BY 1""",
)
def unreadable_values(spark, folder):
    item = table(spark, folder, "lineitem")
    raw = item.select(
        F.col("l_returnflag").alias("lineItem/LineItemType"),
        F.when(F.col("l_linenumber") == 7, F.concat(F.lit("bad "), F.col("l_linestatus")))
        .otherwise(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
        .alias("lineItem/UnblendedCost"),
    )
    typed = typed_columns(raw)
    kept = F.try_element_at("unreadable_values", F.lit("line_item_unblended_cost"))
    return typed.groupBy(F.col("line_item_line_item_type").alias("l_returnflag")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("line_item_unblended_cost").alias("readable"),
        F.count(kept).alias("kept"),
        F.min(kept).alias("least_kept"),
    )


@query(
    "report_union",
    """SELECT 'lineItem_UnblendedCost,product_name,resourceTags_user:Owner' AS header, n, with_owner, with_name
FROM (SELECT (SELECT COUNT(*) FROM orders) + (SELECT COUNT(*) FROM part) AS n,
       (SELECT COUNT(*) FROM orders) AS with_owner, (SELECT COUNT(*) FROM part) AS with_name)""",
)
def report_union_query(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("resourceTags/user:Owner"),
        F.col("o_totalprice").alias("lineItem/UnblendedCost"),
    )
    part = table(spark, folder, "part").select(
        F.col("p_name").alias("product/name"), F.col("p_retailprice").alias("lineItem/UnblendedCost")
    )
    whole = clean_columns(report_union([orders, part]))
    return whole.agg(
        F.lit(",".join(whole.columns)).alias("header"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("`resourceTags_user:Owner`") != "").alias("with_owner"),
        F.count_if(F.col("product_name") != "").alias("with_name"),
    )


@query(
    "canonical_columns",
    """SELECT CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS line_item_unblended_cost,
       CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS line_item_usage_amount,
       MAX(l_returnflag) AS line_item_line_item_type, MIN(strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'))
         AS line_item_usage_start_date, COUNT(DISTINCT l_partkey) AS line_item_resource_id
FROM lineitem""",
)
def canonical_columns_query(spark, folder):
    """Raw, cleaned, squashed, snake and prefix-less names all end in the canonical one."""
    item = table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").cast("decimal(12,2)").alias("lineItem/UnblendedCost"),
        F.col("l_quantity").cast("string").alias("lineItem_UsageAmount"),
        F.col("l_returnflag").alias("lineitem_lineitemtype"),
        F.col("l_shipdate").cast("string").alias("usage_start_date"),
        F.col("l_partkey").alias("line_item_resource_id"),
    )
    lines = typed_columns(item)
    return lines.agg(
        F.sum("line_item_unblended_cost").alias("line_item_unblended_cost"),
        F.sum("line_item_usage_amount").alias("line_item_usage_amount"),
        F.max("line_item_line_item_type").alias("line_item_line_item_type"),
        F.min("line_item_usage_start_date").alias("line_item_usage_start_date"),
        F.count_distinct("line_item_resource_id").alias("line_item_resource_id"),
    )
