"""Load state: an append-only event log folded to one row per version.

The fold uses order-aware aggregates, so each key is combined before the shuffle
and no key's events are ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.functions.names import period_table_name
from spendloom.functions.scalars import load_status, short_id

EVENT_FIELDS = """
    vendor string, export_name string, billing_period string, version_id string,
    load_id string, event string, seq long, ts timestamp, file_count long,
    row_count long, data_format_version string, error_message string, load_schema string
"""
STARTED, COMPLETED, FAILED = "started", "completed", "failed"
PERIOD_KEY = ["vendor", "export_name", "billing_period"]
VERSION_KEY = [*PERIOD_KEY, "version_id"]


def fold_events(events: DataFrame) -> DataFrame:
    """Event log -> load state, one row per version of a period.

    A restart clears completion and error but keeps the current flag, the row
    count and the format of the first start; a failure leaves the current flag,
    and only a restart clears its message.
    Current is the version of the period's last completed load.
    """
    started = F.when(F.col("event") == STARTED, F.col("seq"))
    completed = F.when(F.col("event") == COMPLETED, F.col("seq"))
    failed = F.when(F.col("event") == FAILED, F.col("seq"))
    versions = events.groupBy(*VERSION_KEY).agg(
        F.min_by("data_format_version", started).alias("data_format_version"),
        F.max_by("ts", started).alias("load_timestamp"),
        F.max_by("file_count", started).alias("file_count"),
        F.max_by("row_count", completed).alias("row_count"),
        F.max_by("event", "seq").alias("last_event"),
        F.max_by("error_message", failed).alias("last_error"),
        (F.max(failed) > F.coalesce(F.max(started), F.lit(0))).alias("failed_since_start"),
    )
    current = (
        events.where(F.col("event") == COMPLETED)
        .groupBy(*PERIOD_KEY)
        .agg(F.max_by("version_id", "seq").alias("version_id"))
        .withColumn("is_current", F.lit(True))
    )
    return versions.join(current, VERSION_KEY, "left").select(
        *VERSION_KEY,
        "data_format_version",
        F.coalesce("is_current", F.lit(False)).alias("current_version"),
        "load_timestamp",
        (F.col("last_event") == COMPLETED).alias("load_completed"),
        "row_count",
        "file_count",
        F.when(F.col("failed_since_start"), F.col("last_error")).alias("error_message"),
    )


def current_loads(events: DataFrame) -> DataFrame:
    """The load each period is served from: its last completed one."""
    load = F.struct("version_id", "load_id", "row_count", "load_schema")
    return (
        events.where(F.col("event") == COMPLETED)
        .groupBy(*PERIOD_KEY)
        .agg(F.max_by(load, "seq").alias("load"))
        .select(*PERIOD_KEY, "load.*")
    )


def completed_versions(state: DataFrame) -> DataFrame:
    return state.where("load_completed").select(*VERSION_KEY)


def is_version_loaded(state: DataFrame, versions: DataFrame) -> DataFrame:
    """The versions (by key columns) whose load is complete."""
    return versions.join(completed_versions(state), VERSION_KEY, "left_semi")


def pending_versions(versions: DataFrame, state: DataFrame, reset: bool = False) -> DataFrame:
    """Versions still to load; all of them after a reset."""
    if reset:
        return versions
    return versions.join(completed_versions(state), VERSION_KEY, "left_anti")


def current_versions(state: DataFrame, vendor: str, export_name: str) -> DataFrame:
    """Current version of every period of an export, latest period first."""
    return (
        state.where(
            (F.col("vendor") == vendor)
            & (F.col("export_name") == export_name)
            & F.col("current_version")
        )
        .select(
            "billing_period",
            "version_id",
            "data_format_version",
            "load_timestamp",
            "row_count",
            "file_count",
        )
        .orderBy(F.desc("billing_period"))
    )


def version_history(
    state: DataFrame, vendor: str, export_name: str, billing_period: str
) -> DataFrame:
    """All versions of one period, last started first."""
    return (
        state.where(
            (F.col("vendor") == vendor)
            & (F.col("export_name") == export_name)
            & (F.col("billing_period") == billing_period)
        )
        .drop(*PERIOD_KEY)
        .orderBy(F.desc("load_timestamp"), F.desc("version_id"))
    )


def show_state(
    state: DataFrame, vendor: str, export_name: str, billing_period: str | None = None
) -> DataFrame:
    """The state report: current versions, or one period's history with its status."""
    if billing_period is None:
        return current_versions(state, vendor, export_name).withColumn(
            "version_id", short_id(F.col("version_id"), 40)
        )
    history = version_history(state, vendor, export_name, billing_period)
    return history.select(
        short_id(F.col("version_id"), 40).alias("version_id"),
        "data_format_version",
        "current_version",
        load_status(F.col("load_completed"), F.col("error_message")).alias("status"),
        "row_count",
        "load_timestamp",
        "error_message",
    )


# ---- catalogue of period tables -------------------------------------------------
def period_tables(loads: DataFrame) -> DataFrame:
    """Catalogue: one table per loaded period of an export, with its rows and version.

    Tables carry their export, so an export never claims the tables of another one
    whose name starts alike, and the unified view is not among them.
    """
    return loads.select(
        *PERIOD_KEY,
        period_table_name(F.col("export_name"), F.col("billing_period")).alias("table_name"),
        F.col("row_count").alias("rows"),
        "version_id",
    )


def tables_of_export(tables: DataFrame, vendor: str, export_name: str) -> DataFrame:
    return tables.where(
        (F.col("vendor") == vendor) & (F.col("export_name") == export_name)
    ).orderBy("table_name")


def load_summary(tables: DataFrame, state: DataFrame) -> DataFrame:
    """Each period table with its rows, current version and its export's total."""
    current = state.where("current_version").select(
        *PERIOD_KEY, short_id(F.col("version_id")).alias("version")
    )
    totals = tables.groupBy("vendor", "export_name").agg(F.sum("rows").alias("total_rows"))
    return (
        tables.drop("version_id")
        .join(current, PERIOD_KEY, "left")
        .join(totals, ["vendor", "export_name"])
    )


def table_name_collisions(tables: DataFrame) -> DataFrame:
    """Table names that more than one export or period ended up with."""
    return (
        tables.groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("owners"), F.min("export_name").alias("example"))
        .where("owners > 1")
    )


def loaded_exports(state: DataFrame) -> DataFrame:
    """Exports with a completed load."""
    return state.where("load_completed").select("vendor", "export_name").distinct()


def exports_catalogue(state: DataFrame, tables: DataFrame) -> DataFrame:
    """Loaded exports with their number of tables and rows, and their vendor's exports."""
    exports = loaded_exports(state)
    sizes = tables.groupBy("vendor", "export_name").agg(
        F.count(F.lit(1)).alias("tables"), F.sum("rows").alias("total_rows")
    )
    per_vendor = exports.groupBy("vendor").agg(F.count(F.lit(1)).alias("vendor_exports"))
    return (
        exports.join(sizes, ["vendor", "export_name"], "left")
        .join(per_vendor, "vendor")
        .select(
            "vendor",
            "export_name",
            F.coalesce("tables", F.lit(0).cast("long")).alias("tables"),
            F.coalesce("total_rows", F.lit(0).cast("long")).alias("total_rows"),
            "vendor_exports",
        )
        .orderBy("vendor", "export_name")
    )
