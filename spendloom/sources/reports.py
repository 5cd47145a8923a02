"""Scans of report files whose columns drift from file to file."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.functions.fixed_values import AMOUNT_COLUMNS, TIMESTAMP_COLUMNS
from spendloom.functions.names import canonical_columns, canonical_name, report_column_order
from spendloom.functions.scalars import AMOUNT, TAGS
from spendloom.sources.inference import as_inferred, inferred_schema

UNREADABLE = "unreadable_values"
_HEADER_READERS = 16

_TYPED = {canonical_name(n): AMOUNT for n in AMOUNT_COLUMNS} | {
    canonical_name(n): T.TimestampType() for n in TIMESTAMP_COLUMNS
}


# ---- union by name -------------------------------------------------------------
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def _as_decimal(kind: T.DataType) -> T.DecimalType:
    return kind if isinstance(kind, T.DecimalType) else T.DecimalType(_WHOLE_DIGITS[type(kind)], 0)


def common_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """A type that holds the values of both; text when nothing narrower does."""
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    if isinstance(left, _WHOLE) and isinstance(right, _WHOLE):
        return max(left, right, key=lambda k: _WHOLE.index(type(k)))
    exact = (*_WHOLE, T.DecimalType)
    if isinstance(left, exact) and isinstance(right, exact):
        a, b = _as_decimal(left), _as_decimal(right)
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    floating = (T.FloatType, T.DoubleType)
    if isinstance(left, (*exact, *floating)) and isinstance(right, (*exact, *floating)):
        return T.DoubleType()
    dated = (T.DateType, T.TimestampType)
    if isinstance(left, dated) and isinstance(right, dated):
        return T.TimestampType()
    return T.StringType()


def _as_type(name: str, kind: T.DataType, wanted: T.DataType) -> Column:
    column = F.col(f"`{name}`")
    if kind == wanted:
        return column
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(kind, nested) and isinstance(wanted, T.StringType):
        return F.to_json(column).alias(name)
    return column.cast(wanted).alias(name)


def union_by_name(frames: Iterable[DataFrame], distinct: bool = False) -> DataFrame:
    """All rows of all frames; missing columns are NULL, differing types are widened."""
    frames = list(frames)
    kinds: dict[str, T.DataType] = {}
    spelling: dict[str, str] = {}
    for frame in frames:
        for field in frame.schema:
            key = field.name.lower()
            spelling.setdefault(key, field.name)
            known = kinds.get(key)
            kinds[key] = field.dataType if known is None else common_type(known, field.dataType)
    aligned = [
        frame.select(
            *[
                _as_type(f.name, f.dataType, kinds[f.name.lower()]).alias(spelling[f.name.lower()])
                for f in frame.schema
            ]
        )
        for frame in frames
    ]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)
    return _distinct(whole) if distinct else whole


def report_union(frames: Iterable[DataFrame]) -> DataFrame:
    """All raw report rows with all columns in report order; missing values are empty text."""
    whole = union_by_name(frames)
    ordered = [F.col(f"`{name}`").cast("string").alias(name) for name in report_column_order(whole.columns)]
    return whole.select(*ordered).fillna("")


def _distinct(df: DataFrame) -> DataFrame:
    """``distinct`` that also takes map columns, compared as sorted entries."""
    maps = [f.name for f in df.schema if isinstance(f.dataType, T.MapType)]
    entries = {name: F.array_sort(F.map_entries(f"`{name}`")) for name in maps}
    back = {name: F.map_from_entries(f"`{name}`") for name in maps}
    return df.withColumns(entries).distinct().withColumns(back) if maps else df.distinct()


# ---- scans ---------------------------------------------------------------------
def _unique(names: Iterable[str]) -> tuple[str, ...]:
    """Number the repeats of a column name, whatever their case."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        repeat = seen.get(name.lower(), 0)
        seen[name.lower()] = repeat + 1
        out.append(f"{name}_{repeat}" if repeat else name)
    return tuple(out)


def csv_headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """Column names of each CSV file: its first line that is not blank; none without such a line.

    One job for all files.  Lines of a split are read in order, and splits know where they begin, so the first
    line is a minimum, which tasks combine before the shuffle; no line is sorted.
    """
    if not paths:
        return {}
    lines = spark.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start")
    filled = lines.where(F.trim(F.translate("value", "\ufeff\t\r", "")) != "")
    place = F.struct("file_block_start", F.monotonically_increasing_id())
    first = filled.select("value", "file_path", place.alias("place")).groupBy("file_path").agg(F.min_by("value", "place").alias("line"))
    found = {_path_text(unquote(row["file_path"])): next(csv.reader([row["line"].lstrip("\ufeff")])) for row in first.collect()}
    return {path: tuple(found.get(_path_text(path), ())) for path in paths}


def _path_text(path: str) -> str:
    """A path without its scheme's slashes, which readers and callers write differently."""
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):/+", lambda m: "/" if m[1] == "file" else f"{m[1]}:/", path)


def scan_csv(
    spark: SparkSession, paths: list[str], header: tuple[str, ...], multi_line: bool = True
) -> DataFrame:
    """CSV files (plain or gzip) that share one header, every column as text.

    Ragged rows and a header other than the expected one fail the scan.  Quoted
    line breaks are kept; give ``multi_line=False`` to split large plain files
    that are known to have none.
    """
    names = _unique(header)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return (
        spark.read.option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", str(multi_line).lower())
        # Repeated names are numbered here, so those headers cannot be checked again.
        .option("enforceSchema", str(names != header).lower())
        .option("mode", "FAILFAST")
        .schema(schema)
        .csv(paths)
    )


def scan_parquet(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet files as one frame; where types disagree, files are scanned per schema."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    with ThreadPoolExecutor(_HEADER_READERS) as pool:
        schemas = list(pool.map(lambda path: spark.read.parquet(path).schema, paths))
    by_schema: dict[T.StructType, list[str]] = {}
    for path, schema in zip(paths, schemas):
        by_schema.setdefault(schema, []).append(path)
    return union_by_name(
        spark.read.schema(schema).parquet(*group) for schema, group in by_schema.items()
    )


def typed_columns(
    df: DataFrame, overrides: Mapping[str, str] | None = None, declared: bool = False
) -> DataFrame:
    """Canonical names; known amounts and times typed, other scalar columns as text, or as ``declared``.

    A value that is not what its column should hold becomes NULL there and is kept
    as text in the ``unreadable_values`` map, so none is lost.  An amount with digits
    past the tenth decimal is rounded there, and kept as text in that map as well.
    """
    names = canonical_columns(df.columns, overrides)
    columns, bad = [], []
    for field in df.schema:
        raw, name = F.col(f"`{field.name}`"), names[field.name]
        wanted = _TYPED.get(name)
        if wanted is not None:
            value = raw.try_cast(wanted)
            columns.append(value.alias(name))
            text = raw.cast("string")
            lost = raw.isNotNull() & value.isNull()
            if isinstance(field.dataType, T.StringType):
                lost = lost & (raw != "")
            if isinstance(wanted, T.DecimalType) and field.dataType != wanted:
                exact = text.try_cast(T.DecimalType(38, 20))
                finer = exact.isNotNull() & (exact != value)
                if isinstance(field.dataType, T.StringType):
                    # Below the twentieth decimal a digit is still seen in the text.
                    tiny = (exact == 0) & text.rlike("^[^eE]*[1-9]")
                    finer = finer | (value.isNotNull() & tiny) | text.rlike(r"^[^eE.]*\.\d{10}\d*[1-9]\d*\s*$")
                lost = lost | F.coalesce(finer, F.lit(False))
            if field.dataType != wanted:
                bad.append((lost, F.create_map(F.lit(name), text)))
        elif declared or isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            columns.append(raw.alias(name))
        else:
            columns.append(raw.cast("string").alias(name))
    if bad:
        none = F.create_map().cast(TAGS)
        any_lost = reduce(lambda a, b: a | b, [lost for lost, _ in bad])
        kept = F.map_concat(*[F.when(lost, entry).otherwise(none) for lost, entry in bad])
        columns.append(F.when(any_lost, kept).alias(UNREADABLE))
    return df.select(*columns)


def scan_reports(
    spark: SparkSession,
    files: Iterable[tuple[str, str]],
    overrides: Mapping[str, str] | None = None,
    multi_line: bool = True,
    spread_over: int | None = None,
    infer_types: bool = False,
    check_header: Callable[[tuple[str, ...]], None] | None = None,
) -> DataFrame | None:
    """All report files ``(path, format)`` of one period as typed line items.

    CSV columns go by position, so files are scanned per distinct header.  Parquet
    columns keep their declared types.  With ``infer_types``, one more pass over the
    CSV files finds the types of their other columns; without it they are text.
    ``check_header`` sees each distinct header before a line is read, and may raise.
    """
    files = list(files)
    texts = [path for path, kind in files if kind == "csv"]
    parquet = [path for path, kind in files if kind == "parquet"]
    by_header: dict[tuple[str, ...], list[str]] = {}
    headers = csv_headers(spark, texts)
    for path in texts:
        by_header.setdefault(headers[path], []).append(path)
    by_header.pop((), None)  # files without even a header
    scans = [scan_csv(spark, paths, header, multi_line) for header, paths in by_header.items()]
    stored = [scan_parquet(spark, parquet)] if parquet else []
    if check_header:
        for header in [*by_header, *[tuple(scan.columns) for scan in stored]]:
            check_header(header)
    if infer_types:
        kinds = inferred_schema(spark, scans)
        for i, scan in enumerate(scans):
            # Known amounts and times are read from their text, which may hold digits that a column can't.
            known = {n.lower() for n, name in canonical_columns(scan.columns, overrides).items() if name in _TYPED}
            scans[i] = as_inferred(scan, {n: kind for n, kind in kinds.items() if n not in known})
    typed = [(scan, infer_types) for scan in scans] + [(scan, True) for scan in stored]
    if not typed:
        return None
    if spread_over:
        typed = [(scan.repartition(spread_over), declared) for scan, declared in typed]
    return union_by_name(typed_columns(scan, overrides, declared) for scan, declared in typed)


def path_template(template: str) -> Callable[[str, str], str]:
    """``s3a://{bucket}/{key}`` -> function of bucket and key."""
    return lambda bucket, key: template.format(bucket=bucket, key=key)
