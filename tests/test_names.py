import pytest
from pyspark.sql import functions as F

from spendloom.functions import names
from spendloom.functions.fixed_values import REQUIRED_REPORT_COLUMNS

CASES = [
    ("production-account", "production_account"),
    ("PRODUCTION-ACCOUNT", "production_account"),
    ("prod account", "prod_account"),
    ("prod/account", "prod_account"),
    ("prod\\account", "prod_account"),
    ("prod@account!", "prodaccount"),
    ("prod#$%account", "prodaccount"),
    ("prod.account", "prodaccount"),
    ("prod___account", "prod_account"),
    ("_prod_", "export_prod"),
    ("__prod__account__", "export_prod_account"),
    ("123account", "export_123account"),
    ("1-prod", "export_1_prod"),
    ("999", "export_999"),
    ("", "export"),
    ("---", "export"),
    ("@#$%", "export"),
    ("a" * 100, "a" * 50),
    ("a b c\x1cd", "a_b_c_d"),
    ("a" * 49 + "-b", "a" * 49 + "_"),
]


def test_table_names(rows):
    df = rows("n string", *[(n,) for n, _ in CASES])
    got = {r[0]: r[1] for r in df.select("n", names.table_name(F.col("n"))).collect()}
    assert got == dict(CASES)


def test_period_table_names_and_back(rows):
    cases = [
        ("production", "2024-01", "production_2024_01"),
        ("dev-account", "2024-12", "dev_account_2024_12"),
        ("TEST EXPORT", "2023-06", "test_export_2023_06"),
        ("123-export", "2024-01", "export_123_export_2024_01"),
    ]
    df = rows("e string, p string, want string", *cases)
    name = names.period_table_name(F.col("e"), F.col("p"))
    for row in df.select("want", "p", name.alias("got"), names.period_of_table(name).alias("b")).collect():
        assert row["got"] == row["want"] and row["b"] == row["p"]
    assert rows("n string", ("solo",)).select(names.period_of_table(F.col("n"))).first()[0] == "unknown"


def test_canonical_names():
    assert names.canonical_name("lineItem/UnblendedCost") == "line_item_unblended_cost"
    assert names.canonical_name("lineItem_UnblendedCost") == "line_item_unblended_cost"
    assert names.canonical_name("resourceTags/user:CostCenter") == "resource_tags_user_cost_center"
    assert names.canonical_name("product/servicecode") == "product_servicecode"
    got = names.canonical_columns(["lineitem_unblendedcost", "unblended_cost_x", "usage_amount"])
    assert got["lineitem_unblendedcost"] == "line_item_unblended_cost"
    assert got["usage_amount"] == "line_item_usage_amount"
    # "operation" and "region" style short names stay as they are unless unambiguous
    assert names.name_aliases()["product_name"] == "product_product_name"


def test_every_form_of_every_required_column_meets():
    for raw in REQUIRED_REPORT_COLUMNS:
        want = names.canonical_name(raw)
        for form in (raw, raw.replace("/", "_"), want, raw.replace("/", "_").lower()):
            assert names.canonical_columns([form])[form] == want


def test_collisions_are_errors(rows):
    with pytest.raises(ValueError, match="both become"):
        names.canonical_columns(["product/region", "product_region"])
    assert names.canonical_columns(
        ["product/region", "product_region"], {"product_region": "product_region_2"}
    )["product_region"] == "product_region_2"
    df = rows("`a/b` int, c int", (1, 2))
    assert names.clean_columns(df).columns == ["a_b", "c"]
    with pytest.raises(ValueError):
        names.clean_columns(rows("`a/b` int, a_b int", (1, 2)))


def test_report_column_order():
    got = names.report_column_order(
        ["zzz", "pricing/unit", "lineItem/B", "lineItem/A", "bill/X", "identity/Y",
         "resourceTags/user:T", "product/p", "reservation/r", "savingsPlans/s"]
    )
    assert got == [
        "identity/Y", "bill/X", "lineItem/A", "lineItem/B", "product/p", "pricing/unit",
        "reservation/r", "savingsPlans/s", "resourceTags/user:T", "zzz",
    ]
