"""Column types of drifting report files, inferred from all of their values in one pass.

What a column has held is a set of shapes: kinds of value, lengths of the whole part, lengths of the
fraction.  A set is two bit masks, so the join of two sets is a bitwise OR: it is commutative, associative
and idempotent, a task combines its rows before the shuffle, and the states of files or months are kept
and merged in any order, with those of Parquet columns, whose declared type is their state.  A type is
read off a state at the end; it holds every value exactly, or it is text.

A value counts as text as soon as a number could not give it back: leading zeros, a plus sign, more than 38
digits.  An empty value has no shape.  Times may be written as an ISO date, or date and time with or
without a zone.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOOLEAN, WHOLE, DECIMAL, DOUBLE, DATE, TIMESTAMP, TEXT = (1 << i for i in range(7))
_LENGTH_BIT = 8  # a whole part of n digits sets bit 8 + n of the first mask, a fraction of n digits bit n of the second
_MOST_DIGITS = 38
_LARGEST_LONG = str((1 << 63) - 1)
_EXACT_DOUBLE_DIGITS = 15
_WHOLE = r"^-?(0|[1-9]\d*)$"
_DECIMAL = r"^-?(0|[1-9]\d*)\.\d+$"
_DOUBLE = r"^-?\d+(\.\d+)?[eE][+-]?\d+$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?$"
STATE = "column_name string, kinds bigint, scales bigint"
_DECLARED_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _bit(length: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), length)


def _shape(text: Column) -> tuple[Column, Column]:
    """(kinds and whole lengths, fraction lengths) of one value."""
    digits = F.regexp_replace(text, "^-", "")
    whole = F.length(F.substring_index(digits, ".", 1))
    fraction = F.when(F.contains(digits, F.lit(".")), F.length(F.substring_index(digits, ".", -1))).otherwise(0)
    # Nineteen digits may pass the largest long; they count as twenty then.
    long_digits = whole + F.when((whole == len(_LARGEST_LONG)) & (digits > _LARGEST_LONG), 1).otherwise(0)
    number = text.rlike(_WHOLE) | text.rlike(_DECIMAL)
    fits = whole + fraction <= _MOST_DIGITS
    kind = (
        F.when(text.isNull() | (text == ""), 0)
        .when(number & ~fits, TEXT)
        .when(text.rlike(_WHOLE), F.lit(WHOLE).cast("long").bitwiseOR(_bit(long_digits + _LENGTH_BIT)))
        .when(number, F.lit(DECIMAL).cast("long").bitwiseOR(_bit(whole + _LENGTH_BIT)))
        .when(text.rlike(_DOUBLE) & text.try_cast("double").isNotNull(), DOUBLE)
        .when(text.rlike(_DATE) & text.try_cast("date").isNotNull(), DATE)
        .when(text.rlike(_TIMESTAMP) & text.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .when(F.lower(text).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )
    return kind.cast("long"), F.when(number & fits, _bit(fraction)).otherwise(0).cast("long")


def declared_state(kind: T.DataType) -> tuple[int, int]:
    """The state of a column whose type is declared."""
    if type(kind) in _DECLARED_DIGITS:
        return WHOLE | 1 << _LENGTH_BIT + _DECLARED_DIGITS[type(kind)], 1
    if isinstance(kind, T.DecimalType):
        return (DECIMAL if kind.scale else WHOLE) | 1 << _LENGTH_BIT + kind.precision - kind.scale, 1 << kind.scale
    simple = {T.BooleanType: BOOLEAN, T.FloatType: DOUBLE, T.DoubleType: DOUBLE, T.DateType: DATE, T.TimestampType: TIMESTAMP, T.NullType: 0}
    return simple.get(type(kind), TEXT), 0


def column_states(df: DataFrame, by: Sequence[str] = (), declared: bool = False) -> DataFrame:
    """(by..., column_name, kinds, scales): the state of each column of a scan, by the given columns.

    One aggregation over all columns, whatever their number; typed columns are not read for it, nor is text
    that a file declares to be text (``declared``, as Parquet does and CSV can't).
    """
    fields = [field for field in df.schema if field.name not in by]
    masks, entries = [], []
    for i, field in enumerate(fields):
        if isinstance(field.dataType, T.StringType) and not declared:
            kinds, scales = _shape(F.col(f"`{field.name}`"))
            masks += [F.bit_or(kinds).alias(f"kinds_{i}"), F.bit_or(scales).alias(f"scales_{i}")]
            own = [F.coalesce(F.col(f"{mask}_{i}"), F.lit(0).cast("long")) for mask in ("kinds", "scales")]
        else:
            own = [F.lit(mask).cast("long") for mask in declared_state(field.dataType)]
        entries.append(F.struct(F.lit(field.name).alias("column_name"), own[0].alias("kinds"), own[1].alias("scales")))
    if not fields:
        return df.sparkSession.createDataFrame([], T.StructType([*[df.schema[name] for name in by], *T.StructType.fromDDL(STATE).fields]))
    summed = df.groupBy(*by).agg(*(masks or [F.count(F.lit(1)).alias("n")]))
    return summed.select(*by, F.inline(F.array(*entries)))


def merged_states(states: Iterable[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """The join of states of any files or months, by the given columns; names that differ in case are one column."""
    whole = reduce(DataFrame.unionByName, states)
    named = whole.withColumn("column_name", F.lower("column_name"))
    return named.groupBy(*by, "column_name").agg(F.bit_or("kinds").alias("kinds"), F.bit_or("scales").alias("scales"))


def type_name(kinds: Column, scales: Column) -> Column:
    """The narrowest type that holds every value of a state, by its SQL name."""

    def longest(mask: Column) -> Column:
        return F.length(F.bin(mask)) - 1

    def only(*allowed: int) -> Column:
        return kind.bitwiseAND(F.lit(~sum(allowed) & (2 * TEXT - 1))) == 0

    kind = kinds.bitwiseAND(F.lit(2 * TEXT - 1))
    lengths = F.shiftright(kinds, _LENGTH_BIT)
    whole, fraction = longest(lengths), F.when(scales > 0, longest(scales)).otherwise(0)
    has_double, has_decimal = kind.bitwiseAND(F.lit(DOUBLE)) != 0, kind.bitwiseAND(F.lit(DECIMAL)) != 0
    exact = F.concat(F.lit("decimal("), F.greatest(whole + fraction, F.lit(1)), F.lit(","), fraction, F.lit(")"))
    number = (
        F.when(has_double & ((lengths == 0) | (whole + fraction <= _EXACT_DOUBLE_DIGITS)), "double")
        .when(has_double | (whole + fraction > _MOST_DIGITS), "string")
        .when(has_decimal, exact)
        .when(whole <= len(_LARGEST_LONG), "bigint")
        .otherwise(exact)
    )
    return (
        F.when(kind == 0, "string")
        .when(only(BOOLEAN), "boolean")
        .when(only(DATE), "date")
        .when(only(DATE, TIMESTAMP), "timestamp")
        .when(only(WHOLE, DECIMAL, DOUBLE), number)
        .otherwise("string")
    )


def inferred_types(states: DataFrame) -> DataFrame:
    """States with their type's SQL name instead of the masks."""
    named = type_name(F.col("kinds"), F.col("scales")).alias("column_type")
    return states.select(*[name for name in states.columns if name not in ("kinds", "scales")], named)


def inferred_schema(spark: SparkSession, frames: Iterable[DataFrame]) -> dict[str, T.DataType]:
    """Type of each column, by lower-case name, over all rows of all frames: one job, one driver row per column."""
    frames = list(frames)
    if not frames:
        return {}
    rows = inferred_types(merged_states(map(column_states, frames))).collect()
    return {row["column_name"]: T.DataType.fromDDL(row["column_type"]) for row in rows}


def as_inferred(df: DataFrame, schema: dict[str, T.DataType]) -> DataFrame:
    """Text columns as their inferred types; empty values of other types are NULL."""
    columns = []
    for field in df.schema:
        column, wanted = F.col(f"`{field.name}`"), schema.get(field.name.lower())
        if isinstance(field.dataType, T.StringType) and wanted is not None and not isinstance(wanted, T.StringType):
            column = F.nullif(column, F.lit("")).cast(wanted)
        columns.append(column.alias(field.name))
    return df.select(*columns)
