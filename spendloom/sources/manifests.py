"""Discovery of billing exports through their manifests, as DataFrames."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST_FIELDS = """
    assemblyId string, executionId string, lastModified string, account string,
    reportKeys array<string>, dataFiles array<string>,
    columns array<struct<category:string,name:string,type:string>>,
    billingPeriod struct<start:string,end:string>, bucket string, compression string,
    contentType string, charset string, reportId string, reportName string
"""
_CORRUPT = "_corrupt"


def manifest_key_pattern(prefix: str, export_name: str, cur_version: str) -> str:
    """Regular expression of the manifest keys of one export; its group is the period."""
    where = re.escape(f"{prefix}/{export_name}/")
    file = re.escape(f"{export_name}-Manifest.json")
    if cur_version == "v1":
        return rf"^{where}(\d{{8}})-\d{{8}}/{file}$"
    return rf"^{where}metadata/BILLING_PERIOD=(\d{{4}}-\d{{2}})/{file}$"


def period_of_key(key: Column, pattern: str, cur_version: str) -> Column:
    """Billing period a manifest key names; v1 names the first day of it."""
    found = F.regexp_extract(key, pattern, 1)
    if cur_version == "v1":
        return F.concat_ws("-", F.substring(found, 1, 4), F.substring(found, 5, 2))
    return found


def in_period_range(period: Column, start: str | None, end: str | None) -> Column:
    """Inclusive range over ``YYYY-MM`` text; either end may be open."""
    for bound in (start, end):
        if bound is not None and not re.fullmatch(r"\d{4}-\d{2}", bound):
            raise ValueError(f"billing period {bound!r} is not of the form YYYY-MM")
    inside = F.lit(True)
    if start is not None:
        inside = inside & (period >= start)
    if end is not None:
        inside = inside & (period <= end)
    return inside


def select_manifests(
    objects: DataFrame,
    bucket: str,
    prefix: str,
    export_name: str,
    cur_version: str = "v1",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Objects ``(key, content)`` -> the export's manifests in range, by period."""
    pattern = manifest_key_pattern(prefix, export_name, cur_version)
    period = period_of_key(F.col("key"), pattern, cur_version)
    matches = F.col("key").rlike(pattern)
    return (
        objects.where(matches)
        .select(
            F.lit(bucket).alias("bucket"),
            "key",
            period.alias("billing_period"),
            F.lit(cur_version).alias("version"),
            # Filters may be reordered: other objects' content must never reach the parser.
            F.when(matches, F.col("content")).alias("content"),
        )
        .where(in_period_range(F.col("billing_period"), start, end))
        .orderBy("billing_period")
    )


def manifest_objects(spark: SparkSession, bucket_root: str, prefix: str, export_name: str) -> DataFrame:
    """The manifest files below an export's folder: ``key`` (relative to the bucket) and text."""
    root = bucket_root.rstrip("/")
    tail = re.sub(r"^[a-z0-9]+:/*", "/", root)
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*-Manifest.json")
    )
    try:
        files = reader.load(f"{root}/{prefix}/{export_name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "key string, content string")
    inside = F.regexp_extract("path", re.escape(tail) + r"/(.*)$", 1)
    return files.select(inside.alias("key"), F.decode("content", "UTF-8").alias("content"))


def parse_manifests(manifests: DataFrame) -> DataFrame:
    """Add the parsed ``data``; unreadable JSON fails the query and names the key."""
    fields = T.StructType.fromDDL(MANIFEST_FIELDS)
    schema = T.StructType([*fields.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = manifests.withColumn("data", F.from_json("content", schema, options))
    broken = F.col("content").isNotNull() & (
        F.col("data").isNull() | F.col(f"data.{_CORRUPT}").isNotNull()
    )
    failure = F.raise_error(F.concat(F.lit("cannot parse manifest "), F.col("key")))
    return parsed.withColumn(
        "data", F.when(broken, failure.cast(fields)).otherwise(F.col("data").dropFields(_CORRUPT))
    )


def report_keys(version: Column, data: Column) -> Column:
    """Report files a manifest lists; the two versions use different fields."""
    listed = F.when(version == "v2", data.getField("dataFiles")).otherwise(
        data.getField("reportKeys")
    )
    return F.coalesce(listed, F.array().cast("array<string>"))


def version_id(version: Column, billing_period: Column, data: Column) -> Column:
    """The vendor's id of this state of the period; NULL without manifest data."""
    execution = data.getField("executionId")
    fallback = F.concat_ws(
        "_", billing_period, F.coalesce(data.getField("lastModified"), F.lit("unknown"))
    )
    v2 = F.when(execution != "", execution).otherwise(fallback)
    return F.when(
        data.isNotNull(),
        F.when(version == "v1", data.getField("assemblyId")).when(version == "v2", v2),
    )


def identified(manifests: DataFrame) -> DataFrame:
    """Add ``version_id``, ``report_keys`` and ``file_count`` to parsed manifests."""
    data, version = F.col("data"), F.col("version")
    return manifests.select(
        "*",
        version_id(version, F.col("billing_period"), data).alias("version_id"),
        report_keys(version, data).alias("report_keys"),
        F.size(report_keys(version, data)).cast("long").alias("file_count"),
    )


def report_bucket(report_key: Column, default_bucket: Column) -> Column:
    return F.when(
        report_key.startswith("s3://"), _uri_part(report_key, 1)
    ).otherwise(default_bucket)


def report_object_key(report_key: Column) -> Column:
    return F.when(report_key.startswith("s3://"), _uri_part(report_key, 2)).otherwise(report_key)


def _uri_part(uri: Column, group: int) -> Column:
    shape = r"^s3://([^/]*)/(.*)$"
    failure = F.raise_error(F.concat(F.lit("no object key in "), uri)).cast("string")
    return F.when(uri.rlike(shape), F.regexp_extract(uri, shape, group)).otherwise(failure)


def report_format(object_key: Column, override: str | None = None) -> Column:
    """``csv`` or ``parquet`` from the file name unless stated."""
    if override:
        return F.lit(override)
    failure = F.raise_error(F.concat(F.lit("cannot tell the format of "), object_key))
    return (
        F.when(object_key.endswith(".parquet"), "parquet")
        .when(object_key.endswith(".csv.gz") | object_key.endswith(".csv"), "csv")
        .otherwise(failure.cast("string"))
    )


def report_files(manifests: DataFrame, export_format: str | None = None) -> DataFrame:
    """One row per report file: bucket, key and format, in manifest order."""
    listed = manifests.select(
        "billing_period",
        "version_id",
        F.col("bucket").alias("manifest_bucket"),
        F.posexplode("report_keys").alias("position", "report_key"),
    )
    located = listed.select(
        "billing_period",
        "version_id",
        "position",
        report_bucket(F.col("report_key"), F.col("manifest_bucket")).alias("bucket"),
        report_object_key(F.col("report_key")).alias("key"),
    )
    return located.withColumn("format", report_format(F.col("key"), export_format))


def list_manifests(
    spark: SparkSession,
    bucket_root: str,
    bucket: str,
    prefix: str,
    export_name: str,
    cur_version: str = "v1",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """An export's manifests in a period range, parsed and identified."""
    objects = manifest_objects(spark, bucket_root, prefix, export_name)
    chosen = select_manifests(objects, bucket, prefix, export_name, cur_version, start, end)
    return identified(parse_manifests(chosen))
