import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from spendloom.functions.median import exact_median
from spendloom.plans import analytics as A

TEXT = f"{A.COST} string, {A.SERVICE} string, bill_billing_period_start_date timestamp, {A.START} timestamp, {A.USAGE} string, {A.BLENDED} decimal(28,10), line_item_usage_type string, line_item_resource_id string, identity_time_interval string, line_item_usage_account_id string"


@pytest.fixture
def lines(rows, utc):
    def row(cost, service, month, day, usage="1", blended="0", kind="k", resource="r"):
        return (cost, service, utc(2024, month, 1), utc(2024, month, day, 23), usage, D(blended), kind, resource,
                f"2024-{month:02d}-{day:02d}T23:00:00Z/x", "001")
    return rows(TEXT, row("10.50", "S3", 1, 3, blended="1.0000000001"), row("150.25", "EC2", 1, 3, "2.5", "2"),
                row("12.60", "S3", 2, 9, "", "3"), row("", "S3", 2, 9), row(None, "EC2", 3, 1), row("0.0049", None, 1, 4),
                row("-3", "Tax", 2, 9, "x", kind="t"), row("123456789.999", "EC2", 4, 1, kind="big"))


def test_monthly_and_daily(lines):
    got = {r[0].month: r[1] for r in A.monthly_cost(lines).collect()}
    assert got == {1: D("160.75"), 2: D("9.60"), 4: D("123456790.00")}
    exact = {r[0].month: r[1] for r in A.monthly_cost(lines, scale=None).collect()}
    assert exact[1] == D("160.7549") and exact[4] == D("123456789.999")
    assert [(r[0], r[1]) for r in A.daily_cost(lines).collect()][:2] == [(dt.date(2024, 1, 3), D("160.75")), (dt.date(2024, 1, 4), D("0.00"))]
    assert [r[0] for r in A.monthly_cost_by_interval_text(lines).collect()] == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert A.monthly_cost_by_interval_text(lines).first()[1] == D("160.755")
    assert A.daily_blended_cost(lines).first()[1] == D("3.0000000001")


def test_services(lines):
    assert [tuple(r) for r in A.top_services(lines, 2).collect()] == [("EC2", D("123456940.25")), ("S3", D("23.10"))]
    assert [r[0] for r in A.top_services_at_three_decimals(lines).collect()] == ["EC2", "S3", None, "Tax"]
    assert [r[0] for r in A.top_services_blended(lines, 2).collect()] == ["S3", "EC2"]
    assert [tuple(r) for r in A.services_by_records(lines).collect()] == [("EC2", 3), ("S3", 3), ("Tax", 1)]
    assert [r[0] for r in A.usage_type_cost(lines).collect()] == ["big", "k"]
    assert A.cost_by_account(lines).first()["line_items"] == 6
    used = A.resource_usage(lines, "S3").collect()
    assert [tuple(r) for r in used] == [("r", "k", D("2.00"), D("23.10"))]


def test_profiles(lines):
    assert tuple(A.dataset_profile(lines).first()) == (8, 3, 5)
    stats = A.cost_stats(lines).first()
    assert stats["min_cost"] == D("0.0049") and stats["median_cost"] == D("12.60")
    usage = A.usage_stats(lines).first()
    assert (usage["min_usage"], usage["max_usage"], usage["usage_records"], usage["median_usage"]) == (1, D("2.5"), 6, 1)
    empty = A.cost_stats(lines.where("false")).first()
    assert tuple(empty) == (None, None, None, None)


def test_since(lines):
    assert A.lines_since(lines, "2024-02-09").count() == 5


@pytest.mark.parametrize("kind", ["decimal(28,10)", "decimal(12,2)", "decimal(38,10)"])
@pytest.mark.parametrize("bins,small", [(4, 1), (7, 3), (1 << 16, 10), (1 << 16, 10**6)])
def test_median_against_sorting(rows, kind, bins, small):
    cases = [
        [1], [1, 2], [5, 5, 5, 5], [1, 1, 1, 9], [-7, -3, 0, 2, 2, 2, 100000], [D("0.01"), D("-9999999.99"), D("9999999.99"), 3],
        [1, 1, 1000000, 1000000], [7] * 30 + [1, 2, 3, 900, 901],
    ]
    for values in cases[::2] if bins == 4 else cases:
        values = [D(v) for v in values]
        got = exact_median(rows(f"v {kind}", *[(v,) for v in values], (None,)), "v", bins, small)
        ordered = sorted(values)
        half = len(ordered) // 2
        want = ordered[half] if len(ordered) % 2 else (ordered[half - 1] + ordered[half]) / 2
        assert got == want, values


def test_median_wants_decimals(rows):
    assert exact_median(rows("v decimal(5,1)", (None,)), "v") is None
    with pytest.raises(TypeError):
        exact_median(rows("v double", (1.5,)), "v")


def test_scans_read_only_what_a_report_needs(spark, tmp_path, lines):
    lines.write.parquet(f"file://{tmp_path}/l")
    plan = A.top_services(spark.read.parquet(f"file://{tmp_path}/l"))._jdf.queryExecution().executedPlan().toString()
    scan = [l for l in plan.split("\n") if "FileScan" in l][0]
    assert "ReadSchema: struct<line_item_unblended_cost:string,product_product_name:string>" in scan
    assert "IsNotNull(product_" in scan and "TakeOrderedAndProject" in plan
