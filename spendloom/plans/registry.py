"""Named queries over the star-schema test tables, each with the SQL it must equal.

Every query reads whole tables.  Money is exact inside the queries and turned into
plain doubles, and times into text, only in the last step, where two engines meet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PLANS: dict[str, Query] = {}  # the same, without the last step for comparison
ORACLE: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that yields the same rows."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(build(spark, folder))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        PLANS[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register
