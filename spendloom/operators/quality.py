"""Data-quality rules; every report is (rule, billing_period, n_rows, sample).

All row rules are found in one pass over the lines.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.functions import fixed_values as V
from spendloom.functions.names import canonical_name
from spendloom.functions.scalars import amount
from spendloom.sources.manifests import report_files
from spendloom.sources.reports import UNREADABLE

REPORT_FIELDS = "rule string, billing_period string, n_rows long, sample string"


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule where ``broken`` is true; ``sample`` shows such a row."""

    name: str
    columns: tuple[str, ...]
    broken: Column
    sample: str


def _filled(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("")) != ""


def _not(condition: Column) -> Column:
    """Negation where an unknown condition counts as not met."""
    return ~F.coalesce(condition, F.lit(False))


def _not_a_number(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    unreadable = _filled(column) & amount(column).isNull()
    if UNREADABLE in df.columns:
        return unreadable | F.coalesce(F.map_contains_key(UNREADABLE, name), F.lit(False))
    return unreadable


def _not_a_time(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        broken = F.lit(False)
    else:
        shaped = column.contains("T") & column.contains("Z")
        broken = _filled(column) & (_not(shaped) | column.try_cast("timestamp").isNull())
    if UNREADABLE in df.columns:
        return broken | F.coalesce(F.map_contains_key(UNREADABLE, name), F.lit(False))
    return broken


def line_rules(df: DataFrame) -> list[Rule]:
    """The row rules of canonical line items whose columns the frame has."""
    kind, code, name, service = map(
        F.col,
        (
            "line_item_line_item_type",
            "line_item_product_code",
            "product_product_name",
            "product_servicecode",
        ),
    )
    arn, line_id = F.col("line_item_resource_id"), F.col("identity_line_item_id")
    region, zone = F.col("product_region"), F.col("line_item_availability_zone")
    arn_ok = arn.startswith("arn:aws:") & (F.size(F.split(arn, ":")) >= V.ARN_MIN_PARTS)
    id_ok = (
        (F.length(line_id) == V.LINE_ITEM_ID_LENGTH)
        & (F.lower(line_id) == line_id)
        & line_id.rlike("[a-z]")
    )

    def rule(label: str, columns: str, broken, sample: str) -> list[Rule]:
        names = tuple(columns.split())
        if not set(names) <= set(df.columns):
            return []
        return [Rule(label, names, broken() if callable(broken) else broken, sample)]

    rules = [
        *rule("line_item_type_known", kind_name := "line_item_line_item_type",
              _not(kind.isin(*V.LINE_ITEM_TYPES)), kind_name),
        *rule("service_known", "product_servicecode",
              _not(service.isin(*V.PRODUCT_CODES)), "product_servicecode"),
        *rule("product_code_matches", "line_item_product_code product_servicecode",
              ~code.eqNullSafe(service), "line_item_product_code"),
        *rule("product_name_matches", "product_product_name product_servicecode",
              ~name.eqNullSafe(service), "product_product_name"),
    ]
    for column in ("line_item_usage_amount", "line_item_unblended_cost", "line_item_blended_cost"):
        rules += rule(f"{column}_numeric", column, lambda c=column: _not_a_number(df, c), column)
    usage = "line_item_usage_amount"
    rules += rule("usage_not_negative", usage, lambda: amount(F.col(usage)) < 0, usage)
    for column in ("line_item_currency_code", "pricing_currency"):
        rules += rule(
            f"{column}_is_{V.CURRENCY.lower()}", column, ~F.col(column).eqNullSafe(V.CURRENCY), column
        )
    for column in map(canonical_name, V.TIMESTAMP_COLUMNS):
        rules += rule(f"{column}_iso", column, lambda c=column: _not_a_time(df, c), column)
    rules += rule(
        "resource_is_arn", "line_item_resource_id", _filled(arn) & _not(arn_ok), "line_item_resource_id"
    )
    rules += rule("line_item_id_shape", "identity_line_item_id", _not(id_ok), "identity_line_item_id")
    rules += rule(
        "region_known", "product_region", _filled(region) & _not(region.isin(*V.REGIONS)), "product_region"
    )
    rules += rule(
        "zone_in_region",
        "product_region line_item_availability_zone",
        _filled(region) & _filled(zone) & _not(zone.startswith(region)),
        "line_item_availability_zone",
    )
    return rules


def focus_rules(df: DataFrame) -> list[Rule]:
    """The row rules of FOCUS records whose columns the frame has."""
    have = set(df.columns)
    rules = [
        Rule(f"{c}_filled", (c,), _not(_filled(F.col(c))), c)
        for c in V.FOCUS_REQUIRED_COLUMNS
        if c in have
    ]
    for c in ("UsageQuantity", "BilledCost", "EffectiveCost"):
        if c in have:
            rules.append(Rule(f"{c}_numeric", (c,), _not_a_number(df, c), c))
            rules.append(Rule(f"{c}_not_negative", (c,), amount(F.col(c)) < 0, c))
    if "ServiceName" in have:
        known = F.col("ServiceName").isin(*V.FOCUS_SERVICES)
        rules.append(Rule("ServiceName_known", ("ServiceName",), _not(known), "ServiceName"))
    for c, value in (("Provider", "AWS"), ("BillingCurrency", V.CURRENCY)):
        if c in have:
            rules.append(Rule(f"{c}_expected", (c,), ~F.col(c).eqNullSafe(value), c))
    return rules


def rule_report(df: DataFrame, period: Column, rules: list[Rule]) -> DataFrame:
    """Violations of all rules per billing period, found in one pass over the rows.

    Only violations go on.  Equal samples are counted together first, by hash and
    before the shuffle, so the sort that a least text needs sees distinct ones only.
    """
    marks = [
        F.when(
            r.broken,
            F.struct(F.lit(r.name).alias("rule"), F.col(r.sample).cast("string").alias("sample")),
        )
        for r in rules
    ]
    found = (
        df.select(period.alias("billing_period"), F.explode(F.array(*marks)).alias("found"))
        .where(F.col("found").isNotNull())
        .select("found.rule", "billing_period", "found.sample")
    )
    samples = found.groupBy("rule", "billing_period", "sample").agg(F.count(F.lit(1)).alias("n"))
    return samples.groupBy("rule", "billing_period").agg(
        F.sum("n").alias("n_rows"), F.min("sample").alias("sample")
    )


def periods_without_usage(lines: DataFrame, period: Column) -> DataFrame:
    """Periods none of whose lines is of type ``Usage``, as report rows."""
    usage = F.coalesce((F.col("line_item_line_item_type") == "Usage").cast("int"), F.lit(0))
    return (
        lines.groupBy(period.alias("billing_period"))
        .agg(F.max(usage).alias("usage"))
        .where(F.col("usage") == 0)
        .select(
            F.lit("usage_present").alias("rule"),
            "billing_period",
            F.lit(1).cast("long").alias("n_rows"),
            F.lit(None).cast("string").alias("sample"),
        )
    )


def quality_report(lines: DataFrame, period: str = "billing_period") -> DataFrame:
    """All line-item rules, and that every period has a ``Usage`` line."""
    report = rule_report(lines, F.col(period), line_rules(lines))
    if "line_item_line_item_type" not in lines.columns:
        return report
    return report.unionByName(periods_without_usage(lines, F.col(period)))


def focus_quality_report(records: DataFrame) -> DataFrame:
    period = F.date_format(F.col("BillingPeriodStart").try_cast("timestamp"), "yyyy-MM")
    return rule_report(records, period, focus_rules(records))


def missing_columns(columns: Iterable[str]) -> list[str]:
    """Required report columns that a raw or canonical header lacks."""
    have = {canonical_name(c) for c in columns}
    return [c for c in V.REQUIRED_REPORT_COLUMNS if canonical_name(c) not in have]


def misnamed_columns(columns: Iterable[str]) -> list[str]:
    """Raw report columns that are not of the form category/name."""
    return [c for c in columns if c and "/" not in c]


def schema_report(spark, columns: Iterable[str]) -> DataFrame:
    """The two rules on a raw header as report rows; no data is read."""
    columns = list(columns)
    rows = [("required_column", None, 1, c) for c in missing_columns(columns)]
    rows += [("column_name_shape", None, 1, c) for c in misnamed_columns(columns)]
    return spark.createDataFrame(rows, REPORT_FIELDS)


def require_columns(columns: Iterable[str]) -> None:
    """Fail an import whose report header lacks required columns or has misnamed ones."""
    columns = list(columns)
    missing, misnamed = missing_columns(columns), misnamed_columns(columns)
    if missing or misnamed:
        raise ValueError(f"report header: missing {missing}, misnamed {misnamed}")


def header_report(spark, headers: Mapping[str, Iterable[str]], period: Mapping[str, str]) -> DataFrame:
    """The two rules on the headers of files: per period and rule, the files that break it and the least column named."""
    kind = "file string, billing_period string, columns array<string>"
    files = spark.createDataFrame([(path, period[path], list(names)) for path, names in headers.items()], kind)
    broken = [
        (path, "required_column", name) for path, names in headers.items() for name in missing_columns(names)
    ] + [(path, "column_name_shape", name) for path, names in headers.items() for name in misnamed_columns(names)]
    found = spark.createDataFrame(broken, "file string, rule string, name string")
    return (
        files.join(found, "file")
        .groupBy("rule", "billing_period")
        .agg(F.count_distinct("file").alias("n_rows"), F.min("name").alias("sample"))
        .select("rule", "billing_period", "n_rows", "sample")
    )


# ---- manifests -------------------------------------------------------------------
def manifest_report(manifests: DataFrame, objects: DataFrame | None = None) -> DataFrame:
    """Completeness of parsed v1 manifests; with ``objects`` (bucket, key) also of files."""
    data = F.col("data")
    start, end = F.col("data.billingPeriod.start"), F.col("data.billingPeriod.end")
    columns = F.col("data.columns")
    misshapen = F.exists(
        columns,
        lambda c: _not(c["category"].endswith("Columns")) | _not(c["name"].contains("/")),
    )
    rules = [
        Rule(f"manifest_{name}", (), data.getField(name).isNull(), "key")
        for name in V.REQUIRED_MANIFEST_FIELDS
    ]
    rules += [
        Rule("manifest_period_start", (), _not(start.contains(F.col("billing_period"))), "key"),
        Rule("manifest_period_end", (), end.isNull(), "key"),
        Rule("manifest_columns_listed", (), _not(F.size(columns) > 0), "key"),
        Rule("manifest_column_shape", (), F.coalesce(misshapen, F.lit(False)), "key"),
        Rule("manifest_files_listed", (), _not(F.size("data.reportKeys") > 0), "key"),
    ]
    report = rule_report(manifests, F.col("billing_period"), rules)
    if objects is None:
        return report
    missing = (
        report_files(manifests)
        .join(objects.select("bucket", "key"), ["bucket", "key"], "left_anti")
        .groupBy("billing_period")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min("key").alias("sample"))
        .select(F.lit("report_file_exists").alias("rule"), "billing_period", "n_rows", "sample")
    )
    return report.unionByName(missing)


# ---- comparison of data sets -------------------------------------------------------
def compare_datasets(
    baseline: DataFrame, candidate: DataFrame, service: str, min_services: int = 5
) -> DataFrame:
    """One row: sizes of both data sets, their ratios and the two verdicts."""

    def profile(df: DataFrame, label: str) -> DataFrame:
        return df.agg(
            F.lit(label).alias("side"),
            F.lit(len(df.columns)).cast("long").alias("columns"),
            F.count(F.lit(1)).alias("records"),
            F.count_distinct(service).alias("services"),
        )

    def side(label: str, name: str) -> Column:
        return F.max(F.when(F.col("side") == label, F.col(name))).alias(f"{label}_{name}")

    both = profile(baseline, "baseline").unionByName(profile(candidate, "candidate"))
    sizes = both.agg(
        *[side(s, n) for s in ("baseline", "candidate") for n in ("columns", "records", "services")]
    )

    def ratio(name: str) -> Column:
        divisor = F.nullif(F.col(f"baseline_{name}"), F.lit(0))
        return (F.col(f"candidate_{name}") / divisor).alias(f"{name}_ratio")

    return sizes.select(
        "*",
        ratio("columns"),
        ratio("records"),
        ratio("services"),
        (F.col("candidate_columns") >= F.col("baseline_columns") * 0.8).alias("columns_ok"),
        (F.col("candidate_services") >= min_services).alias("services_ok"),
    )
