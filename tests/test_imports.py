"""Life of a period: scan with drift, replace, fail, restart, reset, empty reload."""

import datetime as dt
from decimal import Decimal as D

import pytest

from cur_files import BASE, csv_text, line, put, put_manifest_v1, put_manifest_v2
from spendloom.operators.lake import BillingLake
from spendloom.plans.imports import import_export
from spendloom.sources import reports as R
from spendloom.sources.manifests import list_manifests


class Feed:
    def __init__(self, spark, folder, export="prod"):
        self.spark, self.folder, self.export = spark, folder, export
        self.lake = BillingLake(spark, f"file://{folder}/lake", "aws", export)
        self.locate = R.path_template(f"file://{folder}/s3/{{bucket}}/{{key}}")

    def csv(self, key, records, columns=None):
        columns = columns or list(dict.fromkeys(c for r in records for c in r)) or None
        put(f"{self.folder}/s3", "bkt", key, csv_text(records, columns) if records else csv_text([BASE]).split("\n")[0] + "\n")
        return key

    def manifest(self, period, version, keys):
        put_manifest_v1(f"{self.folder}/s3", period, version, keys, export=self.export)

    def run(self, version="v1", **kw):
        found = list_manifests(self.spark, f"file://{self.folder}/s3/bkt", "bkt", "cur", self.export, version)
        return import_export(self.lake, found, self.locate, **kw)

    def costs(self):
        view = self.lake.unified_view()
        if "line_item_unblended_cost" not in view.columns:
            return {}
        out = {}
        for r in view.select("billing_period", "line_item_unblended_cost").collect():
            out.setdefault(r[0], []).append(r[1])
        return {k: sorted(v) for k, v in out.items()}


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def test_drifting_columns_never_shift(feed):
    a = feed.csv("a.csv", [line(lineItem__UnblendedCost="1")])
    reordered = list(reversed([*BASE, "resourceTags/user:Owner"]))
    b = feed.csv("b.csv.gz", [line(lineItem__UnblendedCost="2", **{"resourceTags__user:Owner": "me"})], reordered)
    feed.manifest("2024-01", "v1", [a, b])
    assert feed.run() == {"2024-01": 2}
    got = feed.lake.period_view("2024-01").orderBy("line_item_unblended_cost").collect()
    assert [r["line_item_unblended_cost"] for r in got] == [D(1), D(2)]
    assert [r["resource_tags_user_owner"] for r in got] == [None, "me"]
    assert all(r["line_item_usage_account_id"] == "012345678901" for r in got)
    assert all(r["line_item_usage_start_date"] == dt.datetime(2024, 1, 5, 3) for r in got)
    assert all(r["identity_line_item_id"] == BASE["identity/LineItemId"] for r in got)


def test_quotes_line_breaks_and_unreadable_values(feed):
    key = feed.csv("a.csv", [
        line(lineItem__Operation='say "hi", twice\nplease', lineItem__UnblendedCost="oops"),
        line(lineItem__UnblendedCost=""),
    ])
    feed.manifest("2024-01", "v1", [key])
    assert feed.run() == {"2024-01": 2}
    got = feed.lake.unified_view().collect()
    assert {r["line_item_operation"] for r in got} == {'say "hi", twice\nplease', "RunInstances"}
    assert [r["line_item_unblended_cost"] for r in got] == [None, None]
    kept = [r[R.UNREADABLE] for r in got if r[R.UNREADABLE]]
    assert kept == [{"line_item_unblended_cost": "oops"}]


def test_repeated_column_names_and_empty_files(feed):
    put(f"{feed.folder}/s3", "bkt", "a.csv", "lineItem/UnblendedCost,product/region,product/Region\n1,x,y\n")
    put(f"{feed.folder}/s3", "bkt", "b.csv", "")
    feed.manifest("2024-01", "v1", ["a.csv", "b.csv"])
    assert feed.run() == {"2024-01": 1}
    row = feed.lake.unified_view().first()
    assert (row["product_region"], row["product_region_1"]) == ("x", "y")


def test_no_value_is_lost_in_typing(rows):
    df = rows("`lineItem/UnblendedCost` double, `lineItem/UsageAmount` string, other int", (float("nan"), "1e", 7), (2.5, "3", None))
    got = R.typed_columns(df).collect()
    assert got[0][R.UNREADABLE] == {"line_item_unblended_cost": "NaN", "line_item_usage_amount": "1e"}
    assert (got[1]["line_item_unblended_cost"], got[1]["line_item_usage_amount"], got[1][R.UNREADABLE]) == (D("2.5"), D(3), None)
    assert got[0]["other"] == "7"


def test_a_file_listed_twice_is_read_twice(feed):
    key = feed.csv("a.csv", [BASE])
    feed.manifest("2024-01", "v1", [key, key])
    assert feed.run() == {"2024-01": 2}


def test_ragged_rows_fail(feed):
    put(f"{feed.folder}/s3", "bkt", "bad.csv", csv_text([BASE]) + "only,three,fields\n")
    feed.manifest("2024-01", "v1", ["bad.csv"])
    with pytest.raises(Exception):
        feed.run()


def test_loaded_versions_are_skipped_and_newer_ones_replace(feed):
    feed.manifest("2024-01", "v1", [feed.csv("a.csv", [line(lineItem__UnblendedCost="1")] * 2)])
    feed.manifest("2024-02", "w1", [feed.csv("b.csv", [line(lineItem__UnblendedCost="5")])])
    assert feed.run() == {"2024-01": 2, "2024-02": 1}
    assert feed.run() == {}
    feed.manifest("2024-01", "v2", [feed.csv("c.csv", [line(lineItem__UnblendedCost="3")])])
    assert feed.run() == {"2024-01": 1}
    assert feed.costs() == {"2024-01": [D(3)], "2024-02": [D(5)]}
    state = {(r["billing_period"], r["version_id"]): r for r in feed.lake.state().collect()}
    assert state["2024-01", "v1"]["current_version"] is False and state["2024-01", "v1"]["load_completed"]
    assert state["2024-01", "v2"]["current_version"] is True
    assert [tuple(r)[:2] for r in feed.lake.superseded_loads().collect()] == [("2024-01", "v1")]
    assert feed.run(reset=True, periods_at_once=2) == {"2024-01": 1, "2024-02": 1}
    assert feed.costs() == {"2024-01": [D(3)], "2024-02": [D(5)]}


def test_views_for_sql_users(feed, spark):
    feed.manifest("2024-01", "v1", [feed.csv("a.csv", [line(lineItem__UnblendedCost="1.5")])])
    feed.manifest("2024-02", "v1", [feed.csv("b.csv.gz", [line(lineItem__UnblendedCost="2"), line(product__sku="x")])])
    feed.run(spread_over=3)
    assert feed.lake.register_views() == ["prod_2024_01", "prod_2024_02", "prod_unified"]
    assert spark.sql("SELECT sum(line_item_unblended_cost) FROM prod_2024_01").first()[0] == D("1.5")
    assert "product_sku" not in spark.table("prod_2024_01").columns
    assert spark.sql("SELECT count(*) FROM prod_unified WHERE billing_period = '2024-02'").first()[0] == 2


def test_a_period_filter_prunes_and_counts_need_no_columns(feed):
    feed.manifest("2024-01", "v1", [feed.csv("a.csv", [BASE])])
    feed.manifest("2024-02", "v1", [feed.csv("b.csv", [BASE])])
    feed.run()
    chosen = feed.lake.unified_view().where("billing_period = '2024-02'").select("line_item_unblended_cost")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(billing_period" in plan and plan.count("FileScan") == 1
    assert "ReadSchema: struct<line_item_unblended_cost:decimal(28,10)>" in plan
    assert chosen.count() == 1


def test_identical_lines_are_kept(feed):
    feed.manifest("2024-01", "v1", [feed.csv("a.csv", [BASE, BASE])])
    feed.run()
    assert feed.lake.unified_view().count() == 2
    assert feed.lake.unified_view(distinct=True).drop("load_id").count() == 1


def test_empty_version_empties_the_period(feed):
    feed.manifest("2024-01", "v1", [feed.csv("a.csv", [BASE])])
    feed.run()
    feed.manifest("2024-01", "v2", [feed.csv("empty.csv", [])])
    assert feed.run() == {"2024-01": 0}
    assert feed.lake.unified_view().count() == 0
    feed.manifest("2024-01", "v3", [])
    assert feed.run() == {"2024-01": 0}
    assert feed.lake.current_loads().first()["version_id"] == "v3"


def test_failure_keeps_the_previous_version_and_restart_works(feed):
    feed.manifest("2024-01", "v1", [feed.csv("a.csv", [line(lineItem__UnblendedCost="1")])])
    feed.run()
    feed.manifest("2024-01", "v2", ["missing.csv"])
    feed.manifest("2024-02", "w1", [feed.csv("b.csv", [BASE])])
    with pytest.raises(Exception):
        feed.run()
    assert feed.costs() == {"2024-01": [D(1)]}
    state = {r["version_id"]: r for r in feed.lake.state().collect()}
    assert state["v1"]["current_version"] and not state["v2"]["current_version"]
    assert not state["v2"]["load_completed"] and "missing.csv" in state["v2"]["error_message"]
    assert "w1" not in state
    feed.csv("missing.csv", [line(lineItem__UnblendedCost="2")])
    assert feed.run() == {"2024-01": 1, "2024-02": 1}
    state = {r["version_id"]: r for r in feed.lake.state().collect()}
    assert state["v2"]["current_version"] and state["v2"]["error_message"] is None
    assert feed.costs()["2024-01"] == [D(2)]


def test_unknown_format_is_a_failed_load(feed):
    feed.manifest("2024-01", "v1", ["x.json"])
    with pytest.raises(Exception, match="cannot tell the format"):
        feed.run()
    assert "cannot tell the format" in feed.lake.state().first()["error_message"]


def test_parquet_v2_with_other_types_and_digit_versions(feed, spark):
    spark.createDataFrame([(1.25, 7, "2024-01-05 03:00:00")], "line_item_unblended_cost double, extra int, line_item_usage_start_date string").write.parquet(
        f"file://{feed.folder}/s3/bkt/one.parquet")
    spark.createDataFrame([("x", 2)], "extra string, `lineItem/UsageAmount` int").write.parquet(
        f"file://{feed.folder}/s3/bkt/two.parquet")
    for period, file, version in (("2024-01", "one.parquet", "0042"), ("2024-02", "two.parquet", "0043")):
        put_manifest_v2(f"{feed.folder}/s3", period, {"executionId": version, "dataFiles": [f"s3://bkt/{file}"]})
    assert feed.run("v2") == {"2024-01": 1, "2024-02": 1}
    got = feed.lake.unified_view().orderBy("billing_period").collect()
    assert [(r["billing_period"], r["version_id"], r["extra"]) for r in got] == [("2024-01", "0042", "7"), ("2024-02", "0043", "x")]
    assert got[0]["line_item_unblended_cost"] == D("1.25") and got[1]["line_item_usage_amount"] == D(2)


def test_parquet_files_of_one_period_may_disagree_on_types(feed, spark):
    for name, ddl, row in (("one", "extra int, a string", (7, "p")), ("two", "extra string, b double", ("x", 1.5)), ("six", "extra int, a string", (8, "q"))):
        spark.createDataFrame([row], ddl).write.parquet(f"file://{feed.folder}/s3/bkt/{name}.parquet")
    put_manifest_v2(f"{feed.folder}/s3", "2024-01", {"executionId": "e", "dataFiles": [f"s3://bkt/{n}.parquet" for n in ("one", "two", "six")]})
    assert feed.run("v2") == {"2024-01": 3}
    got = feed.lake.unified_view().select("extra", "a", "b").collect()
    assert sorted(map(tuple, got), key=str) == [("7", "p", None), ("8", "q", None), ("x", None, 1.5)]


def test_exports_with_like_names_stay_apart(spark, tmp_path):
    one, two = Feed(spark, str(tmp_path), "prod"), Feed(spark, str(tmp_path), "prod_eu")
    one.manifest("2024-01", "v1", [one.csv("a.csv", [BASE])])
    two.manifest("2024-01", "v1", [two.csv("b.csv", [BASE, BASE])])
    assert one.run() == {"2024-01": 1} and two.run() == {"2024-01": 2}
    assert one.lake.unified_view().count() == 1 and two.lake.unified_view().count() == 2


def test_compacted_events_say_the_same(feed):
    feed.manifest("2024-01", "v1", [feed.csv("a.csv", [BASE])])
    feed.run()
    before = sorted(map(tuple, feed.lake.state().collect()))
    feed.lake.compact_events(f"file://{feed.folder}/lake/state/events_2")
    assert sorted(map(tuple, feed.lake.state().collect())) == before
    assert feed.run() == {}


def test_loads_after_a_compaction_are_seen_by_new_readers(feed, spark):
    feed.manifest("2024-01", "v1", [feed.csv("a.csv", [BASE])])
    feed.run()
    old = feed.lake

    def anew():
        return type(old)(spark, f"file://{feed.folder}/lake", old.vendor, old.export_name)

    other = type(old)(spark, f"file://{feed.folder}/lake", old.vendor, "other")
    old.compact_events(f"file://{feed.folder}/lake/state/events_2")
    feed.manifest("2024-01", "v2", [feed.csv("b.csv", [BASE, BASE, BASE])])
    assert feed.run() == {"2024-01": 3}
    # An export whose object was made before the compaction loads after it.
    other.replace_period(lambda: spark.range(5).withColumnRenamed("id", "n"), "2024-01", "o1", "f", 1)
    for _ in range(2):
        assert anew().unified_view().count() == 3 and [r["version_id"] for r in anew().current_loads().collect()] == ["v2"]
        assert anew().all_events().count() == 6 and other.unified_view().count() == 5
        anew().compact_events()
    # A compaction cut off before its marker changes nothing.
    spark.createDataFrame([], "x int").write.parquet(f"file://{feed.folder}/lake/state/generations/cut")
    assert anew().all_events().count() == 6


def test_union_by_name_widens(rows):
    a, b = rows("x int, y int", (1, 2)), rows("X string, z double", ("s", 1.5))
    got = R.union_by_name([a, b])
    assert got.columns == ["x", "y", "z"]
    assert sorted(map(tuple, got.collect()), key=str) == [("1", 2, None), ("s", None, 1.5)]
    assert R.union_by_name([a, a]).count() == 2 and R.union_by_name([a, a], distinct=True).count() == 1
    c, d = rows("x long", (1,)), rows("x decimal(10,2)", (D("1.50"),))
    assert dict(R.union_by_name([c, d]).dtypes)["x"] == "decimal(22,2)"
    assert dict(R.union_by_name([rows("x int", (1,)), rows("x double", (1.5,))]).dtypes)["x"] == "double"


def test_blank_first_lines_do_not_hide_a_file(feed):
    put(f"{feed.folder}/s3", "bkt", "a.csv", "\nlineItem/UnblendedCost,product/sku\n1,x\n2,y\n")
    put(f"{feed.folder}/s3", "bkt", "b.csv", "lineItem/UnblendedCost,product/sku\n3,z\n")
    put(f"{feed.folder}/s3", "bkt", "c.csv", "\n\n")
    feed.manifest("2024-01", "v1", ["a.csv", "b.csv", "c.csv"])
    assert feed.run() == {"2024-01": 3}
    assert feed.costs() == {"2024-01": [D(1), D(2), D(3)]}


def test_digits_past_the_tenth_decimal_stay_visible(rows):
    cost = "line_item_unblended_cost"
    texts = ("0.00000000004", "1e-11", "1.5", "2.50000000000000", "1e-30", "12.00000000001", "0.0", "1e3", "0." + "0" * 25 + "3")
    got = R.typed_columns(rows("`lineItem/UnblendedCost` string", *[(text,) for text in texts])).collect()
    kept = [(r[R.UNREADABLE] or {}).get(cost) for r in got]
    assert kept == [texts[0], texts[1], None, None, texts[4], texts[5], None, None, texts[8]]
    assert [r[cost] for r in got][:4] == [D(0), D(0), D("1.5"), D("2.5")]


def test_a_reports_own_period_column_is_kept(feed):
    put(f"{feed.folder}/s3", "bkt", "a.csv", "billing_period,lineItem/UnblendedCost\nJanuary,1\n")
    feed.manifest("2024-01", "v1", ["a.csv"])
    feed.run()
    row = feed.lake.unified_view().first()
    assert (row["billing_period"], row["report_billing_period"]) == ("2024-01", "January")


def test_exports_of_one_view_name_raise(spark, tmp_path):
    one, two = Feed(spark, str(tmp_path), "prod-eu"), Feed(spark, str(tmp_path), "prod_eu")
    one.manifest("2024-01", "v1", [one.csv("a.csv", [BASE])])
    one.run()
    assert one.lake.register_views() == ["prod_eu_2024_01", "prod_eu_unified"]
    two.manifest("2024-01", "v1", [two.csv("b.csv", [BASE])])
    two.run()
    with pytest.raises(ValueError, match="one view name"):
        two.lake.register_views()
