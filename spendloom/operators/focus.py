"""Vendor line items -> the vendor-neutral FOCUS columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.functions import scalars as S
from spendloom.functions.scalars import AMOUNT
from spendloom.sources.reports import union_by_name


def focus_basic(lines: DataFrame) -> DataFrame:
    """The eight-column mapping; columns keep the types they are stored with."""
    return lines.select(
        F.col("bill_billing_period_start_date").alias("BillingPeriod"),
        F.col("product_product_name").alias("ServiceName"),
        F.col("line_item_resource_id").alias("ResourceId"),
        F.col("line_item_usage_amount").alias("UsageQuantity"),
        F.col("line_item_usage_type").alias("UsageUnit"),
        F.col("line_item_unblended_cost").alias("ListCost"),
        F.col("line_item_net_unblended_cost").alias("EffectiveCost"),
        F.col("line_item_blended_cost").alias("BilledCost"),
    )


def focus_extended(lines: DataFrame) -> DataFrame:
    """Billing month, usage bounds, service, resource, account, costs, usage and category."""
    kind = F.col("line_item_line_item_type")
    unblended = F.col("line_item_unblended_cost")
    return lines.select(
        S.month_start(F.col("line_item_usage_start_date")).alias("billing_period"),
        F.col("line_item_usage_start_date").alias("billing_period_start"),
        F.col("line_item_usage_end_date").alias("billing_period_end"),
        F.col("line_item_product_code").alias("service_name"),
        F.col("line_item_resource_id").alias("resource_id"),
        F.col("line_item_usage_account_id").alias("account_id"),
        unblended.alias("billed_cost"),
        S.effective_cost(kind, unblended, F.col("line_item_net_unblended_cost")).alias(
            "effective_cost"
        ),
        F.col("line_item_usage_amount").alias("usage_quantity"),
        F.col("pricing_unit").alias("usage_unit"),
        S.charge_category(kind).alias("charge_category"),
    )


def focus_record(
    extended: DataFrame, provider: str, currency: str = "USD", tags: Column | None = None
) -> DataFrame:
    """FOCUS-named record with derived period bounds, category and unit rates."""
    period = S.billing_period(F.col("billing_period"))
    service = F.col("service_name")
    return extended.select(
        S.period_start(period).cast("timestamp").alias("BillingPeriodStart"),
        S.period_end(period).cast("timestamp").alias("BillingPeriodEnd"),
        F.col("billing_period_start").alias("ChargePeriodStart"),
        F.col("billing_period_end").alias("ChargePeriodEnd"),
        service.alias("ServiceName"),
        S.service_category(service).alias("ServiceCategory"),
        F.col("resource_id").alias("ResourceId"),
        F.col("usage_quantity").alias("UsageQuantity"),
        S.usage_unit(service).alias("UsageUnit"),
        F.col("billed_cost").alias("BilledCost"),
        F.col("effective_cost").alias("EffectiveCost"),
        S.unit_rate(F.col("billed_cost"), F.col("usage_quantity")).alias("ListUnitPrice"),
        S.unit_rate(F.col("effective_cost"), F.col("usage_quantity")).alias("EffectiveUnitPrice"),
        F.lit(currency).alias("BillingCurrency"),
        F.lit(provider).alias("Provider"),
        F.col("account_id").alias("BillingAccountId"),
        (F.create_map().cast(S.TAGS) if tags is None else tags).alias("Tags"),
        F.col("charge_category").alias("ChargeCategory"),
    )


# ---- fixed values: typed columns of a FOCUS record read from text ----------------
FOCUS_TIMES = (
    "BillingPeriodStart", "BillingPeriodEnd", "ChargePeriodStart", "ChargePeriodEnd",
)
FOCUS_AMOUNTS = (
    "UsageQuantity", "PricingQuantity", "ConsumedQuantity", "BilledCost", "EffectiveCost",
    "ListCost", "ListUnitPrice", "ContractedUnitPrice", "EffectiveUnitPrice",
)


def typed_focus(raw: DataFrame) -> DataFrame:
    """FOCUS text columns -> times, amounts and a tag map; the rest stays text."""
    changes = {c: F.col(c).try_cast("timestamp") for c in FOCUS_TIMES if c in raw.columns}
    changes |= {c: S.amount(F.col(c)) for c in FOCUS_AMOUNTS if c in raw.columns}
    if "Tags" in raw.columns:
        changes["Tags"] = S.tags_from_json(F.col("Tags"))
    return raw.withColumns(changes) if changes else raw


# ---- service names ---------------------------------------------------------------
def with_standard_service(lines: DataFrame, mapping: DataFrame, service: str) -> DataFrame:
    """Add ``standard_service`` from a mapping table (provider, service, standard_service).

    ``lines`` carry ``provider``.  Unmapped names pass through.  The mapping is
    reduced to one row per name first, so a repeated name never repeats a line.
    """
    unique = mapping.groupBy(
        F.col("provider").alias("_provider"), F.col("service").alias("_service")
    ).agg(F.min("standard_service").alias("_standard"))
    on = (lines["provider"] == F.col("_provider")) & (lines[service] == F.col("_service"))
    return (
        lines.join(unique, on, "left")
        .withColumn("standard_service", F.coalesce("_standard", service))
        .drop("_provider", "_service", "_standard")
    )


# ---- vendors ---------------------------------------------------------------------
VendorMapper = Callable[[DataFrame], DataFrame]

# Common columns every vendor is mapped to.
UNIFIED_COLUMNS = (
    "provider", "billing_period", "service_name", "resource_id", "account_id",
    "usage_quantity", "usage_unit", "billed_cost", "effective_cost", "currency",
    "charge_category",
)


def column_mapper(provider: str, columns: Mapping[str, Column | str]) -> VendorMapper:
    """A mapper from a table of expressions; unmapped columns are NULL."""

    def expression(name: str) -> Column:
        given = columns.get(name)
        if given is None:
            return F.lit(None).cast("string").alias(name)
        return (F.col(given) if isinstance(given, str) else given).alias(name)

    def mapper(lines: DataFrame) -> DataFrame:
        amounts = ("usage_quantity", "billed_cost", "effective_cost")
        mapped = lines.select(
            F.lit(provider).alias("provider"),
            *[expression(name) for name in UNIFIED_COLUMNS if name != "provider"],
        )
        return mapped.withColumns({name: S.amount(F.col(name)) for name in amounts})

    return mapper


def _aws(lines: DataFrame) -> DataFrame:
    extended = focus_extended(lines)
    return column_mapper(
        "aws",
        {
            name: name for name in UNIFIED_COLUMNS if name in extended.columns
        }
        | {"billing_period": S.billing_period(F.col("billing_period")), "currency": F.lit("USD")},
    )(extended)


def _gcp(lines: DataFrame) -> DataFrame:
    """Flat standard GCP lines (see ``sources.gcp``)."""
    return column_mapper(
        "gcp",
        {
            "billing_period": S.billing_period(F.col("billing_period")),
            "service_name": "service_name",
            "resource_id": "resource_id",
            "account_id": "billing_account_id",
            "usage_quantity": "usage_amount",
            "usage_unit": "usage_unit",
            "billed_cost": "billed_cost",
            "effective_cost": "effective_cost",
            "currency": "currency",
            "charge_category": F.lit("Usage"),
        },
    )(lines)


def _azure(lines: DataFrame) -> DataFrame:
    """Cost-details export columns of Azure."""
    return column_mapper(
        "azure",
        {
            "billing_period": S.billing_period(F.col("Date")),
            "service_name": "MeterCategory",
            "resource_id": "ResourceId",
            "account_id": "SubscriptionId",
            "usage_quantity": "Quantity",
            "usage_unit": "UnitOfMeasure",
            "billed_cost": "CostInBillingCurrency",
            "effective_cost": "CostInBillingCurrency",
            "currency": "BillingCurrency",
            "charge_category": "ChargeType",
        },
    )(lines)


VENDORS: dict[str, VendorMapper] = {"aws": _aws, "gcp": _gcp, "azure": _azure}


def unified_costs(
    frames: Mapping[str, DataFrame], vendors: Mapping[str, VendorMapper] | None = None
) -> DataFrame:
    """All vendors' lines in the common columns; ``vendors`` adds or replaces mappers."""
    mappers = {**VENDORS, **(vendors or {})}
    unknown = sorted(set(frames) - set(mappers))
    if unknown:
        raise ValueError(f"no mapper for vendor {', '.join(unknown)}")
    return union_by_name(mappers[vendor](lines) for vendor, lines in frames.items())
