import json

import pytest
from pyspark.sql import functions as F

from cur_files import put, put_manifest_v1, put_manifest_v2
from spendloom.sources import manifests as M


def read(spark, root, version="v1", **kw):
    return M.list_manifests(spark, f"file://{root}/bkt", "bkt", "cur", "prod", version, **kw)


def test_v1_listing_is_filtered_and_sorted(spark, tmp_path):
    for period in ("2024-03", "2024-01", "2024-02"):
        put_manifest_v1(tmp_path, period, f"asm-{period}", [f"k-{period}.csv"])
    put(tmp_path, "bkt", "cur/prod/20240101-20240201/other-Manifest.json", "{}")
    put(tmp_path, "bkt", "cur/prod/some/prod-Manifest.json", "{}")
    put(tmp_path, "bkt", "cur/prod/cur/prod/20240101-20240201/prod-Manifest.json", "{}")
    got = read(spark, tmp_path, start="2024-01", end="2024-02").collect()
    assert [(r["billing_period"], r["version_id"], r["report_keys"]) for r in got] == [
        ("2024-01", "asm-2024-01", ["k-2024-01.csv"]), ("2024-02", "asm-2024-02", ["k-2024-02.csv"])]
    assert got[0]["key"] == "cur/prod/20240101-20240201/prod-Manifest.json"
    assert read(spark, tmp_path).count() == 3
    assert read(spark, tmp_path, end="2023-12").count() == 0


def test_v2_ids_and_files(spark, tmp_path):
    put_manifest_v2(tmp_path, "2024-01", {"executionId": "ex1", "dataFiles": ["s3://o/a.parquet"]})
    put_manifest_v2(tmp_path, "2024-02", {"lastModified": "t9", "reportKeys": ["x.csv"]})
    put_manifest_v2(tmp_path, "2024-03", {"executionId": ""})
    got = read(spark, tmp_path, "v2").collect()
    assert [(r["version_id"], r["report_keys"]) for r in got] == [
        ("ex1", ["s3://o/a.parquet"]), ("2024-02_t9", []), ("2024-03_unknown", [])]
    files = M.report_files(read(spark, tmp_path, "v2")).collect()
    assert [(f["bucket"], f["key"], f["format"]) for f in files] == [("o", "a.parquet", "parquet")]


def test_without_data_nothing_is_known(rows):
    df = rows(f"version string, billing_period string, data struct<{M.MANIFEST_FIELDS.strip()}>",
              ("v1", "2024-01", None), ("v2", "2024-01", None))
    got = M.identified(df).collect()
    assert [(r["version_id"], r["report_keys"], r["file_count"]) for r in got] == [(None, [], 0)] * 2


def test_keys_are_matched_literally_and_whole(rows):
    df = rows("key string, content string",
              ("cur/pr.d/20240101-20240201/pr.d-Manifest.json", "{}"),
              ("cur/prod/20240101-20240201/prod-Manifest.json", "{}"),
              ("cur/pr.d/20240101-20240201/pr.d-Manifest.json.bak", "{}"))
    got = M.select_manifests(df, "b", "cur", "pr.d").collect()
    assert [r["key"] for r in got] == ["cur/pr.d/20240101-20240201/pr.d-Manifest.json"]


def test_broken_json_names_the_key(spark, tmp_path):
    key = put_manifest_v1(tmp_path, "2024-01", "a", [])
    put(tmp_path, "bkt", key, '{"assemblyId": ')
    with pytest.raises(Exception, match="cannot parse manifest " + key):
        read(spark, tmp_path).select("data").collect()


def test_uris_and_formats(rows):
    df = rows("k string", ("s3://b/x/k.parquet",), ("y/k.csv.gz",), ("k.csv",))
    got = df.select(M.report_bucket(F.col("k"), F.lit("dflt")), M.report_object_key(F.col("k")),
                    M.report_format(M.report_object_key(F.col("k")))).collect()
    assert [tuple(r) for r in got] == [("b", "x/k.parquet", "parquet"), ("dflt", "y/k.csv.gz", "csv"), ("dflt", "k.csv", "csv")]
    bad = rows("k string", ("s3://b",))
    with pytest.raises(Exception, match="no object key"):
        bad.select(M.report_bucket(F.col("k"), F.lit("d"))).collect()
    with pytest.raises(Exception, match="cannot tell the format"):
        rows("k string", ("x.json",)).select(M.report_format(F.col("k"))).collect()
    assert rows("k string", ("x.json",)).select(M.report_format(F.col("k"), "csv")).first()[0] == "csv"


def test_ranges_want_whole_periods():
    with pytest.raises(ValueError):
        M.in_period_range(F.lit("2024-01"), "2024-01-15", None)


def test_manifest_body_survives(spark, tmp_path):
    put_manifest_v1(tmp_path, "2024-01", "a", ["k.csv"], columns=[{"category": "identityColumns", "name": "identity/X"}],
                    billingPeriod={"start": "2024-01-01", "end": "2024-02-01"})
    data = read(spark, tmp_path).first()["data"]
    assert data["billingPeriod"]["start"] == "2024-01-01" and data["columns"][0]["name"] == "identity/X"


def test_an_export_without_objects_has_no_manifests(spark, tmp_path):
    assert read(spark, tmp_path).count() == 0
