import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cur_files import BASE, line
from spendloom.operators import allocation as N
from spendloom.operators import focus, quality
from spendloom.sources.gcp import recent_gcp_lines, standard_gcp_lines
from spendloom.sources.reports import typed_columns


def cur(spark, *records):
    names = list(dict.fromkeys(k for r in records for k in r))
    ddl = ", ".join(f"`{n}` string" for n in names)
    raw = spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], ddl)
    return typed_columns(raw).withColumn("billing_period", F.date_format("bill_billing_period_start_date", "yyyy-MM"))


# ---- FOCUS ----
def test_focus_mappings(spark):
    lines = cur(spark, line(lineItem__NetUnblendedCost="8", lineItem__LineItemType="DiscountedUsage"),
                line(lineItem__NetUnblendedCost="7", lineItem__LineItemType="Fee"))
    basic = focus.focus_basic(lines).first()
    assert (basic["ServiceName"], basic["BilledCost"], basic["EffectiveCost"], basic["UsageUnit"]) == ("AmazonEC2", D("9.5"), D(8), "BoxUsage:t3.micro")
    got = focus.focus_extended(lines).collect()
    assert [(r["effective_cost"], r["charge_category"]) for r in got] == [(D("10.0000000001"), "Other"), (D(7), "Other")]
    assert got[0]["billing_period"] == dt.datetime(2024, 1, 1) and got[0]["billing_period_end"] == dt.datetime(2024, 1, 5, 4)
    record = focus.focus_record(focus.focus_extended(lines), "AWS").first()
    assert record["BillingPeriodEnd"] == dt.datetime(2024, 2, 1) and record["ListUnitPrice"] == D("4.0")
    assert record["ServiceCategory"] == "Storage" and record["Tags"] == {}


def test_typed_focus(rows):
    raw = rows("BilledCost string, BillingPeriodStart string, Tags string, Region string",
               ("1.5", "2024-01-01T00:00:00Z", '{"Owner": "a"}', "r"), ("x", "", "", None))
    got = focus.typed_focus(raw).collect()
    assert tuple(got[0]) == (D("1.5"), dt.datetime(2024, 1, 1), {"Owner": "a"}, "r")
    assert got[1]["BilledCost"] is None and got[1]["BillingPeriodStart"] is None


def test_service_mapping_never_repeats_lines(rows):
    lines = rows("provider string, s string, c int", ("aws", "A", 1), ("gcp", "A", 2), ("aws", None, 3))
    mapping = rows("provider string, service string, standard_service string", ("aws", "A", "X"), ("aws", "A", "X"))
    got = focus.with_standard_service(lines, mapping, "s").orderBy("c").collect()
    assert [r["standard_service"] for r in got] == ["X", "A", None]


def test_gcp_and_unified_vendors(spark, rows, utc):
    ddl = ("billing_account_id string, service struct<description:string>, sku struct<description:string>, project struct<id:string>, "
           "usage_start_time timestamp, usage_end_time timestamp, cost decimal(28,10), currency string, usage struct<amount:decimal(28,10),unit:string>")
    export = rows(ddl, ("acc", ("Compute Engine",), ("core",), None, utc(2024, 1, 31, 5), utc(2024, 1, 31, 6), None, "USD", (D(2), "h")),
                  ("acc", ("BigQuery",), ("q",), ("p1",), utc(2024, 1, 2), utc(2024, 1, 2, 1), D(3), "USD", (D(1), "h")),
                  ("acc", ("BigQuery",), ("q",), ("p1",), utc(2024, 1, 1, 23), utc(2024, 1, 2), D(4), "USD", (D(1), "h")))
    recent = recent_gcp_lines(export, dt.date(2024, 2, 1))
    got = standard_gcp_lines(recent).collect()
    assert [(r["resource_id"], r["billed_cost"], r["usage_start_time"]) for r in got] == [
        ("unknown", D(0), "2024-01-31T05:00:00"), ("p1", D(3), "2024-01-02T00:00:00")]
    assert got[0]["billing_period"] == dt.date(2024, 1, 31) and got[0]["vendor"] == "gcp"
    mine = focus.column_mapper("mine", {"billing_period": F.lit("2024-01"), "billed_cost": "cost"})
    all_costs = focus.unified_costs(
        {"aws": cur(spark, line(lineItem__NetUnblendedCost="8")), "gcp": standard_gcp_lines(recent), "mine": rows("cost int", (5,))}, {"mine": mine})
    assert all_costs.columns == list(focus.UNIFIED_COLUMNS)
    sums = {r[0]: r[1] for r in all_costs.groupBy("provider").agg(F.sum("billed_cost")).collect()}
    assert sums == {"aws": D("10.0000000001"), "gcp": D(3), "mine": D(5)}
    with pytest.raises(ValueError):
        focus.unified_costs({"nobody": recent})


# ---- quality ----
def report(df):
    return {(r["rule"], r["billing_period"]): (r["n_rows"], r["sample"]) for r in df.collect()}


def test_clean_lines_pass(spark):
    assert quality.quality_report(cur(spark, BASE)).count() == 0


def test_each_rule(spark):
    bad = {
        "lineItem/LineItemType": ("Nope", "line_item_type_known"),
        "product/servicecode": ("AmazonX", "service_known"),
        "lineItem/ProductCode": ("AmazonS3", "product_code_matches"),
        "product/ProductName": ("AmazonS3", "product_name_matches"),
        "lineItem/UnblendedCost": ("abc", "line_item_unblended_cost_numeric"),
        "lineItem/UsageAmount": ("-1", "usage_not_negative"),
        "lineItem/CurrencyCode": ("EUR", "line_item_currency_code_is_usd"),
        "pricing/currency": (None, "pricing_currency_is_usd"),
        "lineItem/UsageStartDate": ("yesterday", "line_item_usage_start_date_iso"),
        "lineItem/ResourceId": ("arn:aws:short", "resource_is_arn"),
        "identity/LineItemId": ("A" * 50, "line_item_id_shape"),
        "product/region": ("moon-1", "region_known"),
        "lineItem/AvailabilityZone": ("eu-west-1a", "zone_in_region"),
    }
    for column, (value, rule) in bad.items():
        got = report(quality.quality_report(cur(spark, BASE, {**BASE, column: value})))
        assert (rule, "2024-01") in got and got[rule, "2024-01"][0] == 1, rule
    assert report(quality.quality_report(cur(spark, line(lineItem__LineItemType="Fee")))) == {("usage_present", "2024-01"): (1, None)}
    digits = report(quality.quality_report(cur(spark, {**BASE, "identity/LineItemId": "1" * 50})))
    assert ("line_item_id_shape", "2024-01") in digits


def test_schema_rules(spark):
    assert quality.missing_columns(BASE) == []
    header = [c for c in BASE if c != "pricing/unit"] + ["odd"]
    got = {(r["rule"], r["sample"]) for r in quality.schema_report(spark, header).collect()}
    assert got == {("required_column", "pricing/unit"), ("column_name_shape", "odd")}


def test_focus_rules(rows):
    ddl = "BillingPeriodStart timestamp, ServiceName string, ResourceId string, BilledCost string, Provider string"
    df = rows(ddl, (dt.datetime(2024, 1, 1), "EC2", "r", "1", "AWS"), (dt.datetime(2024, 1, 1), "Moon", "", "-1", "GCP"),
              (dt.datetime(2024, 1, 1), "S3", "r", "x", "AWS"))
    got = {k[0]: v[0] for k, v in report(quality.focus_quality_report(df)).items()}
    assert got == {"ServiceName_known": 1, "ResourceId_filled": 1, "BilledCost_not_negative": 1, "BilledCost_numeric": 1, "Provider_expected": 1}


def test_comparison(rows):
    a = rows("s string, x int, y int", ("a", 1, 1), ("b", 1, 1))
    b = rows("s string, x int", *[(str(i), 1) for i in range(5)])
    got = quality.compare_datasets(a, b, "s").first()
    assert (got["records_ratio"], got["services_ok"], got["columns_ok"]) == (2.5, True, False)
    assert quality.compare_datasets(a.where("false"), b, "s").first()["records_ratio"] is None


# ---- allocation ----
def test_proportional_allocation_is_whole(rows):
    df = rows("billing_period string, owner string, cost decimal(12,2)", ("p1", "a", D(30)), ("p1", "b", D(10)), ("p1", "", D(8)),
              ("p1", None, D(4)), ("p2", None, D(5)))
    got = {(r["billing_period"], r["owner"]): r["allocated_cost"] for r in N.allocate_proportional(df, "owner", "cost").collect()}
    assert got == {("p1", "a"): 39.0, ("p1", "b"): 13.0, ("p2", "unallocated"): 5.0}
    direct = {(r[0], r[1]): r[2] for r in N.allocate_direct(df, "owner", "cost").collect()}
    assert direct["p1", "unallocated"] == D(12)
    weights = rows("billing_period string, owner string, weight int", ("p1", "x", 1), ("p1", "y", 3))
    split = {(r[0], r[1]): r[2] for r in N.allocate_by_weights(df, weights, "cost").collect()}
    assert split == {("p1", "x"): 13.0, ("p1", "y"): 39.0, ("p2", "unallocated"): 5.0}


def test_tags(rows):
    df = rows("own map<string,string>, acc map<string,string>", ({"Env": "a", "env ": "b", "X": "1"}, {"env": "z", "Team": "t"}), (None, None))
    tags = N.inherited_tags(N.normalised_tags(F.col("own")), N.normalised_tags(F.col("acc")))
    assert [r[0] for r in df.select(tags).collect()] == [{"team": "t", "env": "a", "x": "1"}, {}]


def test_tiny_lines_are_not_lost_in_conversion(rows):
    lines = rows("billing_period string, currency string, cost decimal(28,10)", *[("p1", "EUR", D("0.0000004"))] * 1000, ("p1", "EUR", D("0.0000000001")))
    rates = rows("currency string, billing_period string, rate decimal(8,4)", ("EUR", "p1", D("1.5")))
    exact = N.in_currency(lines, rates, "cost", scale=None)
    assert exact.agg(F.sum("converted_cost")).first()[0] == D("0.00060000015")
    text = lines.withColumn("cost", F.col("cost").cast("string"))
    assert N.in_currency(text, rates, "cost", scale=None).agg(F.sum("converted_cost")).first()[0] == D("0.00060000015")
    # A line rounded on its own is rounded after the rate.
    one = rows("billing_period string, currency string, cost decimal(28,10)", ("p1", "EUR", D("0.0000004")))
    assert N.in_currency(one, rates, "cost").first()["converted_cost"] == D("0.000001")


def test_currency_reconciliation_budget(rows):
    lines = rows("billing_period string, currency string, cost decimal(12,2)", ("p1", "USD", D(1)), ("p1", "EUR", D(2)), ("p2", "EUR", D(3)))
    rates = rows("currency string, billing_period string, rate decimal(8,4)", ("EUR", "p1", D("1.1")), ("EUR", "p1", D("1.1")))
    assert sorted(str(r["converted_cost"]) for r in N.in_currency(lines, rates, "cost").collect()) == ["1.000000", "2.200000", "None"]
    other = rows("billing_period string, c decimal(12,2)", ("p1", D(3)), ("p3", D(1)))
    got = {r["billing_period"]: (r["difference"], r["reconciled"]) for r in N.reconciliation(lines, other, "cost", "c").collect()}
    assert got == {"p1": (D(0), False), "p2": (D(-3), False), "p3": (D(1), False)}
    budgets = rows("currency string, budget int", ("EUR", 3), ("USD", 9))
    assert [tuple(r)[:2] for r in N.budget_breaches(lines, budgets, "currency", "cost").collect()] == [("p2", "EUR")]
    shares = {r["cost_centre"]: r["share"] for r in N.chargeback(lines.where("billing_period='p1'"), F.nullif(F.col("currency"), F.lit("EUR")), "cost").collect()}
    assert shares == {"USD": pytest.approx(1 / 3), "unallocated": pytest.approx(2 / 3)}


def test_anomaly_and_forecast(rows, utc):
    days = [utc(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    df = rows("k string, ts timestamp, cost decimal(12,2)", *[("a", d, D(100 + i % 3)) for i, d in enumerate(days[:-1])], ("a", days[-1], D(500)))
    got = N.daily_anomalies(df, "k", "cost", "ts", 30, 3.0).collect()
    assert [(r["date"], r["cost"]) for r in got] == [(dt.date(2024, 2, 9), 500.0)]
    monthly = rows("k string, ts timestamp, cost decimal(12,2)", *[("a", utc(2023, m, 3), D(10 * m)) for m in range(1, 13)])
    trend = N.cost_forecast(monthly, "k", "cost", "ts").first()
    assert trend["months"] == 12 and trend["next_cost"] == pytest.approx(130) and trend["slope"] == pytest.approx(10)


def test_mart_is_partitioned_by_month(spark, rows, tmp_path):
    unified = rows("provider string, billing_period string, service_name string, account_id string, charge_category string, usage_quantity int, billed_cost decimal(12,2), effective_cost decimal(12,2)",
                   ("aws", "2024-01", "s", "1", "Usage", 1, D(2), D(3)), ("aws", "2024-01", "s", "1", "Usage", 1, D(2), D(3)), ("gcp", "2024-02", "s", "1", "Usage", 1, D(2), D(3)))
    path = f"file://{tmp_path}/mart"
    N.write_mart(N.monthly_mart(unified, ("provider",)), path)
    back = spark.read.parquet(path)
    assert back.where("billing_period = '2024-01'").first()["billed_cost"] == D(4)
    plan = back.where("billing_period = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(billing_period" in plan
