"""A mart kept up to date from the load state: only periods served from another load are built again.

Every row of the mart names the load it was built from, so the mart itself tells what is stale.  A refresh
overwrites just the partitions of stale periods, in one write.  Each gets a row with no line items as well, which
readers leave out, so a period that has lost its lines is known, too.  A refresh that fails is done again by the
next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.operators.lake import BillingLake

MARKED = "line_items"  # the column that is 0 in the row which only tells the load


def built_from(mart: DataFrame) -> DataFrame:
    """(billing_period, load_id) of the periods a mart holds, emptied ones included."""
    return mart.groupBy(F.col("billing_period").cast("string").alias("billing_period")).agg(F.max("load_id").alias("load_id"))


def _stored(lake: BillingLake, path: str) -> DataFrame | None:
    place = lake.spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/billing_period=*/part-*")
    if not place.getFileSystem(lake.spark._jsc.hadoopConfiguration()).globStatus(place):
        return None
    return lake.spark.read.option("mergeSchema", "true").parquet(path).withColumn("billing_period", F.col("billing_period").cast("string"))


def stale_loads(lake: BillingLake, path: str) -> list:
    """The current load of each period that the mart lacks or holds from another load; a row for each period."""
    current = lake.current_loads()
    mart = _stored(lake, path)
    if mart is not None:
        built = built_from(mart).withColumnRenamed("load_id", "_built")
        current = current.join(built, "billing_period", "left").where(F.col("_built").isNull() | (F.col("_built") != F.col("load_id"))).drop("_built")
    return current.orderBy("billing_period").collect()


def refresh_mart(lake: BillingLake, path: str, build: Callable[[DataFrame], DataFrame]) -> list[str]:
    """Bring the mart at ``path`` up to date; the periods that were built again.

    ``build`` turns lines (with billing_period and load_id) into the mart's rows, which must keep both and
    have ``line_items``.  It sees the lines of stale periods only; other periods' files are not read.
    """
    stale = stale_loads(lake, path)
    if not stale:
        return []
    # A row of no line items for each of them: a period without rows would not be overwritten.
    markers = [(load["billing_period"], load["load_id"], 0) for load in stale]
    rows = lake.spark.createDataFrame(markers, f"billing_period string, load_id string, {MARKED} long")
    served = [load for load in stale if load["row_count"] > 0]
    if served:
        rows = build(lake.lines_of(served)).unionByName(rows, allowMissingColumns=True)
    # Range partitions keep a small period in one file and split a large one.
    keys = [name for name in ("billing_period", "service_name", "account_id") if name in rows.columns]
    writer = rows.repartitionByRange(*keys).write.partitionBy("billing_period").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return [load["billing_period"] for load in stale]


def read_mart(lake: BillingLake, path: str) -> DataFrame | None:
    """The mart's rows, or None before the first refresh."""
    mart = _stored(lake, path)
    return None if mart is None else mart.where(F.col(MARKED) > 0)
