"""The import job: find new versions of billing periods and replace those periods."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.operators.lake import BillingLake
from spendloom.operators.state import pending_versions
from spendloom.sources.manifests import report_files
from spendloom.sources.reports import scan_reports


def pending_manifests(lake: BillingLake, manifests: DataFrame, reset: bool = False) -> DataFrame:
    """Identified manifests whose version is not loaded yet, by period."""
    keyed = manifests.withColumns(
        {
            "vendor": F.lit(lake.vendor),
            "export_name": F.lit(lake.export_name),
            "version_id": F.coalesce(
                "version_id",
                F.raise_error(F.concat(F.lit("no version id in "), F.col("key"))).cast("string"),
            ),
        }
    )
    return pending_versions(keyed, lake.state(), reset)


def import_export(
    lake: BillingLake,
    manifests: DataFrame,
    locate: Callable[[str, str], str],
    reset: bool = False,
    export_format: str | None = None,
    overrides: Mapping[str, str] | None = None,
    multi_line: bool = True,
    periods_at_once: int = 1,
    spread_over: int | None = None,
    infer_types: bool = False,
    check_header: Callable[[tuple[str, ...]], None] | None = None,
) -> dict[str, int]:
    """Load every pending period; rows per loaded period.

    ``locate`` turns bucket and key into a path.  Periods load one after another,
    and the first failure ends the import; a backfill may load several at once.
    A gzip file is read by one task; ``spread_over`` shares the typing and writing
    of its lines among that many.  ``infer_types`` types the other columns of CSV
    reports, too; ``check_header`` (such as ``quality.require_columns``) may fail a load
    by its header.
    """
    pending = pending_manifests(lake, manifests, reset).select(
        "bucket", "billing_period", "version_id", "version", "report_keys", "file_count"
    )
    # One row per period, with its file list.
    wanted = sorted(pending.collect(), key=lambda row: row["billing_period"])

    def load(manifest) -> tuple[str, int]:
        def lines() -> DataFrame | None:
            one = lake.spark.createDataFrame([manifest], pending.schema)
            files = report_files(one, export_format).orderBy("position").collect()
            paths = [(locate(f["bucket"], f["key"]), f["format"]) for f in files]
            return scan_reports(lake.spark, paths, overrides, multi_line, spread_over, infer_types, check_header)

        period = manifest["billing_period"]
        rows = lake.replace_period(
            lines, period, manifest["version_id"], manifest["version"], manifest["file_count"]
        )
        return period, rows

    if periods_at_once == 1:
        return dict(load(manifest) for manifest in wanted)
    with ThreadPoolExecutor(periods_at_once) as pool:
        return dict(pool.map(load, wanted))
