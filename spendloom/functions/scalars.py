"""Column expressions of the billing domain; everything stays inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.functions.fixed_values import COMPUTE_SERVICES, HOURLY_SERVICES, SERVICE_NAMES

AMOUNT = T.DecimalType(28, 10)
TAGS = T.MapType(T.StringType(), T.StringType())


# ---- money ---------------------------------------------------------------------
def amount(value: Column) -> Column:
    """Text or number -> the stored amount type; NULL when it is not a number."""
    return value.try_cast(AMOUNT)


def rounded(value: Column, scale: int) -> Column:
    """``CAST(value AS DECIMAL(p, scale))`` with room for any stored amount.

    Rounds each value like the narrow cast does, but a value too large for the
    narrow type is kept instead of failing the query.
    """
    return value.try_cast(T.DecimalType(19 + scale, scale))


def amount_of(df: DataFrame, name: str, scale: int | None = None) -> Column:
    """The column as an exact number, each value rounded to ``scale`` if one is given.

    A column already stored at that scale or less is used as it is: no cast per row.
    """
    kept = df.schema[name].dataType
    if isinstance(kept, T.DecimalType) and kept.scale <= (AMOUNT.scale if scale is None else scale):
        return F.col(name)
    return amount(F.col(name)) if scale is None else rounded(F.col(name), scale)


def has_amount(df: DataFrame, name: str) -> Column:
    """The column holds a number: pushed-down NOT NULL, and for text also readable."""
    present = F.col(name).isNotNull()
    if isinstance(df.schema[name].dataType, T.StringType):
        return present & (F.col(name) != "") & amount(F.col(name)).isNotNull()
    return present


def unit_rate(cost: Column, usage: Column) -> Column:
    """Cost per unit at ten decimals; 0 without usage."""
    quotient = F.round(cost / F.when(usage > 0, usage), 10)
    return F.when(usage > 0, quotient).otherwise(F.lit(0)).cast(AMOUNT)


# ---- time ----------------------------------------------------------------------
def month_start(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def billing_period(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def period_start(period: Column) -> Column:
    return F.to_date(F.concat(period, F.lit("-01")))


def period_end(period: Column) -> Column:
    """First day of the following month."""
    return F.add_months(period_start(period), 1)


def interval_start(interval: Column) -> Column:
    return F.element_at(F.split(interval, "/"), 1).try_cast("timestamp")


def interval_end(interval: Column) -> Column:
    return F.try_element_at(F.split(interval, "/"), F.lit(2)).try_cast("timestamp")


def time_interval(start: Column, end: Column) -> Column:
    return F.concat_ws("/", iso_text(start), iso_text(end))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp")


# ---- text ----------------------------------------------------------------------
def instance_type(usage_type: Column, default: str) -> Column:
    """Last ``:`` part of a usage type, the default when there is none."""
    return F.when(
        usage_type.contains(":"), F.element_at(F.split(usage_type, ":"), -1)
    ).otherwise(F.lit(default))


def arn_parts(arn: Column) -> Column:
    """Struct of an ARN's fields; the resource keeps any further ``:``."""
    parts = F.split(arn, ":", 6)

    def part(index: int) -> Column:
        return F.try_element_at(parts, F.lit(index))

    return F.struct(
        part(2).alias("partition"),
        part(3).alias("service"),
        part(4).alias("region"),
        part(5).alias("account"),
        part(6).alias("resource"),
    )


def short_id(version_id: Column, length: int = 8) -> Column:
    return F.substring(version_id, 1, length)


# ---- tags ----------------------------------------------------------------------
def tags_from_json(text: Column) -> Column:
    return F.from_json(text, TAGS)


def tags_from_columns(columns: Mapping[str, str]) -> Column:
    """Wide tag columns ``{tag: column}`` -> map of the tags that are set."""
    if not columns:
        return F.create_map().cast(TAGS)
    wide = F.map_from_arrays(
        F.array(*[F.lit(tag) for tag in columns]),
        F.array(*[F.col(f"`{name}`").cast("string") for name in columns.values()]),
    )
    return F.map_filter(wide, lambda _, value: value.isNotNull() & (value != ""))


# ---- classification ------------------------------------------------------------
def effective_cost(line_item_type: Column, unblended: Column, net_unblended: Column) -> Column:
    return F.when(line_item_type == "DiscountedUsage", unblended).otherwise(net_unblended)


def charge_category(line_item_type: Column) -> Column:
    return F.when(
        line_item_type.isin("Usage", "Tax", "Credit"), line_item_type
    ).otherwise(F.lit("Other"))


def service_category(service: Column) -> Column:
    return F.when(service.isin(*COMPUTE_SERVICES), F.lit("Compute")).otherwise(F.lit("Storage"))


def usage_unit(service: Column) -> Column:
    return F.when(service.isin(*HOURLY_SERVICES), F.lit("Hours")).otherwise(F.lit("GB"))


def standard_service_name(
    provider: str, raw: Column, names: Mapping[tuple[str, str], str] = SERVICE_NAMES
) -> Column:
    """Common service name of one provider's name; the name itself when unmapped."""
    known = {service: common for (vendor, service), common in names.items() if vendor == provider}
    if not known:
        return raw
    lookup = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, raw), raw)


def load_status(completed: Column, error_message: Column) -> Column:
    return (
        F.when(completed, F.lit("Complete"))
        .when(F.coalesce(error_message, F.lit("")) != "", F.lit("Failed"))
        .otherwise(F.lit("In Progress"))
    )
