"""Storage of loads: immutable folders, made visible by a state event.

``<root>/data/vendor=…/export_name=…/billing_period=…/version_id=…/load_id=…`` is
written once.  The ``completed`` event is the commit: a period is served from the
load of its last such event, so a replacement is atomic, a failed load stays
invisible and an empty new version empties its period.  One writer per export.

The log is a folder per append below ``<root>/state/events`` and, after compactions, numbered
generations: each holds the events of the appends its marker below ``<root>/state/complete`` names.
The marker is written last.  Readers take the newest complete generation and the appends it does
not name, so an append made during or after a compaction, by any writer, is never lost.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid
from collections.abc import Callable, Iterable
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.functions.fixed_values import UNIFIED_SUFFIX
from spendloom.functions.names import table_name
from spendloom.operators.state import (
    COMPLETED,
    EVENT_FIELDS,
    FAILED,
    STARTED,
    current_loads,
    fold_events,
)
from spendloom.sources.reports import union_by_name

ROWS_PER_FILE = 5_000_000
MARKER = "path string, batches array<string>"
_LOAD_COLUMNS = ("billing_period", "version_id", "load_id")


class BillingLake:
    """The loads of one export and their state."""

    def __init__(self, spark: SparkSession, root: str, vendor: str, export_name: str):
        self.spark = spark
        self.vendor = vendor
        self.export_name = export_name
        self.events_path = f"{root}/state/events"
        self._generations = f"{root}/state/generations"
        self._markers = f"{root}/state/complete"
        self._place = f"vendor={quote(vendor, safe='')}/export_name={quote(export_name, safe='')}"
        self.data_path = f"{root}/data/{self._place}"
        self._event_schema = T.StructType.fromDDL(EVENT_FIELDS)
        self._lock = threading.Lock()
        self._seq: int | None = None

    # ---- state -----------------------------------------------------------------
    def _listed(self, pattern: str) -> list[str]:
        """Paths of the folders that match, in order."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return sorted(status.getPath().toString() for status in found or [])

    def _generation(self) -> tuple[int, str | None, list[str]]:
        """(number, folder, names of the appends it holds) of the newest complete generation."""
        done = self._listed(f"{self._markers}/generation=*/part-*")
        if not done:
            return 0, None, []
        marker = done[-1].rsplit("/", 1)[0]
        row = self.spark.read.schema(MARKER).parquet(marker).first()
        return int(marker.rsplit("=", 1)[1]), row["path"], list(row["batches"])

    def _log(self) -> tuple[DataFrame, int, list[str]]:
        """(events of every export below the root, newest generation, names of the appends read)."""
        # Appends are listed first: one of them may be in the generation as well, none in neither.
        # An append is one file, so it is there as a whole or not at all.
        files = self._listed(f"{self.events_path}/vendor=*/export_name=*/batch=*/part-*")
        number, path, held = self._generation()
        known = set(held)
        names = {folder: folder.rsplit("batch=", 1)[1] for folder in sorted({file.rsplit("/", 1)[0] for file in files})}
        fresh = [folder for folder, name in names.items() if name not in known]
        reader = self.spark.read.schema(self._event_schema)
        parts = [reader.parquet(path)] if path else []
        if fresh:
            parts.append(reader.option("basePath", self.events_path).parquet(*fresh))
        rows = [part.select(*self._event_schema.names) for part in parts]
        rows = rows or [self.spark.createDataFrame([], self._event_schema)]
        log = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
        return log, number, sorted(known | set(names.values()))

    def all_events(self) -> DataFrame:
        """Events of every export below the root."""
        return self._log()[0]

    def events(self) -> DataFrame:
        return self.all_events().where(
            (F.col("vendor") == self.vendor) & (F.col("export_name") == self.export_name)
        )

    def state(self) -> DataFrame:
        return fold_events(self.events())

    def _next_seq(self, count: int) -> int:
        with self._lock:
            if self._seq is None:
                self._seq = self.events().agg(F.max("seq")).first()[0] or 0
            first = self._seq + 1
            self._seq += count
            return first

    def append_events(self, events: Iterable[dict]) -> None:
        """Append events of this export, in order."""
        events = list(events)
        if not events:
            return
        first, now = self._next_seq(len(events)), dt.datetime.now(dt.timezone.utc)
        rows = []
        for offset, event in enumerate(events):
            whole = {
                "vendor": self.vendor,
                "export_name": self.export_name,
                "seq": first + offset,
                "ts": now,
                **event,
            }
            rows.append(tuple(whole.get(name) for name in self._event_schema.names))
        # A folder of its own per append, so that writers never share a commit.
        folder = f"{self.events_path}/{self._place}/batch={uuid.uuid4().hex}"
        frame = self.spark.createDataFrame(rows, self._event_schema)
        frame.drop("vendor", "export_name").coalesce(1).write.parquet(folder)

    def start_load(self, period: str, version_id: str, format_version: str, files: int) -> str:
        load_id = uuid.uuid4().hex
        self.append_events(
            [
                {
                    "event": STARTED,
                    "billing_period": period,
                    "version_id": version_id,
                    "load_id": load_id,
                    "data_format_version": format_version,
                    "file_count": files,
                }
            ]
        )
        return load_id

    def complete_load(
        self, period: str, version_id: str, load_id: str, row_count: int, schema: str | None
    ) -> None:
        self.append_events(
            [
                {
                    "event": COMPLETED,
                    "billing_period": period,
                    "version_id": version_id,
                    "load_id": load_id,
                    "row_count": row_count,
                    "load_schema": schema,
                }
            ]
        )

    def fail_load(self, period: str, version_id: str, load_id: str, message: str) -> None:
        self.append_events(
            [
                {
                    "event": FAILED,
                    "billing_period": period,
                    "version_id": version_id,
                    "load_id": load_id,
                    "error_message": message,
                }
            ]
        )

    def compact_events(self, new_path: str | None = None) -> None:
        """Rewrite the many small event files as a new generation of the log, for all readers.

        ``new_path`` may name its folder.
        """
        log, number, batches = self._log()
        if not batches:
            return
        place = new_path or f"{self._generations}/{uuid.uuid4().hex}"
        places = ["vendor", "export_name", "batch"]
        rewritten = log.withColumn("batch", F.lit("compacted"))
        rewritten.repartition(*places[:2]).write.partitionBy(*places).parquet(place)
        marker = self.spark.createDataFrame([(place, batches)], MARKER).coalesce(1)
        marker.write.mode("errorifexists").parquet(f"{self._markers}/generation={number + 1:09d}")

    # ---- data ------------------------------------------------------------------
    def load_path(self, period: str, version_id: str, load_id: str) -> str:
        values = zip(_LOAD_COLUMNS, (period, version_id, load_id))
        return "/".join([self.data_path, *[f"{n}={quote(v, safe='')}" for n, v in values]])

    def write_load(
        self, lines: DataFrame | None, period: str, version_id: str, load_id: str
    ) -> tuple[int, str | None]:
        """Write one load; (rows, schema), the rows counted while they are written."""
        if lines is None:
            return 0, None
        # These names come from the folder; a report's own columns of those names are renamed.
        kept = lines.withColumnsRenamed({name: f"report_{name}" for name in _LOAD_COLUMNS})
        rows = Observation()
        counted = kept.observe(rows, F.count(F.lit(1)).alias("n"))
        (
            counted.write.mode("errorifexists")
            .option("maxRecordsPerFile", ROWS_PER_FILE)
            .parquet(self.load_path(period, version_id, load_id))
        )
        return rows.get["n"], counted.schema.json()

    def replace_period(
        self,
        make_lines: Callable[[], DataFrame | None],
        period: str,
        version_id: str,
        format_version: str,
        files: int,
    ) -> int:
        """Load a version of a period and serve the period from it; its row count.

        A failure, in making the frame or in writing it, is recorded and raised.
        """
        load_id = self.start_load(period, version_id, format_version, files)
        try:
            rows, schema = self.write_load(make_lines(), period, version_id, load_id)
        except Exception as error:
            self.fail_load(period, version_id, load_id, str(error))
            raise
        self.complete_load(period, version_id, load_id, rows, schema)
        return rows

    def current_loads(self) -> DataFrame:
        return current_loads(self.events())

    def _served_loads(self, start: str | None = None, end: str | None = None) -> list:
        """The current loads that have rows, one driver row per period."""
        loads = self.current_loads().where(F.col("row_count") > 0)
        if start is not None:
            loads = loads.where(F.col("billing_period") >= start)
        if end is not None:
            loads = loads.where(F.col("billing_period") <= end)
        return loads.orderBy("billing_period").collect()

    def _read(self, loads: list, distinct: bool = False) -> DataFrame:
        """Rows of the given loads; those with one schema share one scan."""
        by_schema: dict[str, list[str]] = {}
        for load in loads:
            path = self.load_path(load["billing_period"], load["version_id"], load["load_id"])
            by_schema.setdefault(load["load_schema"], []).append(path)
        places = T.StructType([T.StructField(name, T.StringType()) for name in _LOAD_COLUMNS])
        if not by_schema:
            return self.spark.createDataFrame([], places)
        scans = []
        for schema, paths in by_schema.items():
            fields = T.StructType.fromJson(json.loads(schema)).fields + places.fields
            reader = self.spark.read.schema(T.StructType(fields)).option("basePath", self.data_path)
            scans.append(reader.parquet(*paths))
        return union_by_name(scans, distinct)

    def unified_view(
        self, start: str | None = None, end: str | None = None, distinct: bool = False
    ) -> DataFrame:
        """Rows of all current loads, or those of a period range."""
        return self._read(self._served_loads(start, end), distinct)

    def lines_of(self, loads: list) -> DataFrame:
        """Rows of the given loads, as ``current_loads`` lists them; no other files are read."""
        return self._read(loads)

    def period_view(self, period: str) -> DataFrame:
        """One period's rows, with that period's columns only."""
        return self.unified_view(period, period)

    def register_views(self) -> list[str]:
        """Temp views for SQL users: one per period and the unified one; their names."""
        loads = self._served_loads()
        names = self.all_events().select("export_name").distinct()
        own = table_name(F.lit(self.export_name))
        same = names.where((table_name(F.col("export_name")) == own) & (F.col("export_name") != self.export_name))
        if (other := same.first()) is not None:
            raise ValueError(f"exports {self.export_name} and {other[0]} have one view name")
        export = self.spark.range(1).select(own).first()[0]
        views = {f"{export}_{load['billing_period'].replace('-', '_')}": [load] for load in loads}
        views[f"{export}{UNIFIED_SUFFIX}"] = loads
        for name, served in views.items():
            self._read(served).createOrReplaceTempView(name)
        return list(views)

    def superseded_loads(self) -> DataFrame:
        """Completed loads no period is served from any more; their folders may go."""
        return (
            self.events()
            .where(F.col("event") == COMPLETED)
            .join(self.current_loads().select("load_id"), "load_id", "left_anti")
            .select(*_LOAD_COLUMNS)
        )
