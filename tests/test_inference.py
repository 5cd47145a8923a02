"""Types inferred from values, headers of many files, Parquet types through an import."""

import random
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.operators import quality
from spendloom.sources import inference as I
from spendloom.sources.reports import csv_headers, scan_reports

CASES = {
    "whole": (["1", "-20", "", None], "bigint"),
    "largest": (["9223372036854775807"], "bigint"),
    "wide": (["9223372036854775808", "1"], "decimal(20,0)"),
    "too_wide": (["1" * 39], "string"),
    "code": (["12", "007"], "string"),
    "zero": (["0", "10"], "bigint"),
    "signed": (["+5"], "string"),
    "amount": (["1.50", "-1234.5", "7"], "decimal(6,2)"),
    "tiny": (["0.0000000001", "123"], "decimal(13,10)"),
    "too_long": (["1" * 30, "0." + "1" * 20], "string"),
    "double": (["1e5", "2.5", "3"], "double"),
    "double_or_id": (["1e5", "1234567890123456"], "string"),
    "day": (["2024-02-29", None], "date"),
    "no_day": (["2023-02-29"], "string"),
    "moment": (["2024-02-29", "2024-03-01T05:00:00Z"], "timestamp"),
    "flag": (["true", "FALSE", ""], "boolean"),
    "mixed": (["true", "1"], "string"),
    "nothing": (["", None], "string"),
    "words": (["a", "1"], "string"),
}


def test_types_of_values(spark):
    longest = max(len(values) for values, _ in CASES.values())
    rows = [tuple((values + [None] * longest)[i] for values, _ in CASES.values()) for i in range(longest)]
    df = spark.createDataFrame(rows, ", ".join(f"{name} string" for name in CASES))
    found = {row.column_name: row.column_type for row in I.inferred_types(I.column_states(df)).collect()}
    assert found == {name: kind for name, (_, kind) in CASES.items()}


def test_states_join_in_any_order(spark):
    """States of parts, merged in any order or twice, are the state of the whole."""
    rng = random.Random(7)
    pool = [value for values, _ in CASES.values() for value in values]
    rows = [(rng.choice("abc"), rng.choice(pool), rng.choice(["1", "22", "3.5"])) for _ in range(120)]
    df = spark.createDataFrame(rows, "month string, x string, y string")
    whole = {tuple(row) for row in I.column_states(df.drop("month")).collect()}
    months = I.column_states(df, ["month"]).drop("month")
    twice = [months.where("column_name = 'y'"), months, months.orderBy(F.desc("kinds"))]
    assert {tuple(row) for row in I.merged_states(twice).collect()} == whole
    assert {tuple(row) for row in I.merged_states([months]).collect()} == whole


def test_declared_types_join_with_values(spark):
    stored = spark.createDataFrame([(1, Decimal("1.250"), None)], "N int, Amount decimal(9,3), day date")
    text = spark.createDataFrame([("12345678901", "12345678.5", "2024-01-01T00:00:00Z")], "n string, amount string, day string")
    found = {r.column_name: r.column_type for r in I.inferred_types(I.merged_states([I.column_states(stored, declared=True), I.column_states(text)])).collect()}
    assert found == {"n": "bigint", "amount": "decimal(11,3)", "day": "timestamp"}


def test_inferred_columns_keep_their_values(spark):
    df = spark.createDataFrame([("007", "1.50", ""), ("12", "-2", "2024-01-01")], "code string, cost string, day string")
    got = I.as_inferred(df, I.inferred_schema(spark, [df]))
    assert [f.dataType for f in got.schema] == [T.StringType(), T.DecimalType(3, 2), T.DateType()]
    assert [row.code for row in got.collect()] == ["007", "12"] and got.where("day IS NULL").count() == 1
    assert I.inferred_schema(spark, []) == {}


def jobs(spark, run):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_headers_of_many_files_take_the_jobs_of_few(spark, tmp_path):
    want = {}
    for i in range(60):
        path = str(tmp_path / f"a b%{i}.csv")
        names = ("lineItem/X", f"c,{i}", 'say "x"')
        lines = "﻿\n\n" * (i % 2) + 'lineItem/X,"c,' + f'{i}","say ""x"""\n' + "1,2,3\n" * i
        (tmp_path / f"a b%{i}.csv").write_text(lines)
        want[path] = names
    empty = tmp_path / "empty.csv"
    empty.write_text("\n\n")
    want[str(empty)] = ()
    assert csv_headers(spark, list(want)) == want
    # Above a number of paths Spark lists them in a job of its own.
    assert jobs(spark, lambda: csv_headers(spark, list(want))) <= jobs(spark, lambda: csv_headers(spark, list(want)[:2])) + 1
    assert csv_headers(spark, []) == {}


def test_reports_of_both_formats_with_inferred_types(spark, tmp_path):
    (tmp_path / "one.csv").write_text("lineItem/UnblendedCost,n,code\n1.00000000001,5,007\n2,6,8\n")
    spark.createDataFrame([(Decimal("1.5"), 7, "9")], "`lineItem/UnblendedCost` decimal(9,2), n int, code string").write.parquet(str(tmp_path / "two"))
    files = [(str(tmp_path / "one.csv"), "csv"), (str(tmp_path / "two"), "parquet")]
    got = scan_reports(spark, files, infer_types=True)
    assert got.schema["n"].dataType == T.LongType() and got.schema["code"].dataType == T.StringType()
    assert sorted(row.n for row in got.collect()) == [5, 6, 7]
    assert [row.n for row in got.where("unreadable_values IS NOT NULL").collect()] == [5]  # the eleventh decimal


def test_imports_can_check_headers(spark, tmp_path):
    (tmp_path / "one.csv").write_text("lineItem/UnblendedCost,owner\n1,x\n")
    files = [(str(tmp_path / "one.csv"), "csv")]
    with pytest.raises(ValueError, match="misnamed \\['owner'\\]"):
        scan_reports(spark, files, check_header=quality.require_columns)
    report = quality.header_report(spark, csv_headers(spark, [files[0][0]]), {files[0][0]: "2024-01"}).collect()
    assert {(r.rule, r.n_rows) for r in report} == {("required_column", 1), ("column_name_shape", 1)}
