import random

import pytest
from pyspark.sql import functions as F

from spendloom.operators import state as Z

FIELDS = ["vendor", "export_name", "billing_period", "version_id", "load_id", "event", "seq", "ts",
          "file_count", "row_count", "data_format_version", "error_message", "load_schema"]


def events_of(spark, utc, steps):
    """steps: (export, period, version, event, value)"""
    rows = []
    for seq, (export, period, version, event, value) in enumerate(steps, 1):
        row = dict.fromkeys(FIELDS)
        row.update(vendor="aws", export_name=export, billing_period=period, version_id=version,
                   load_id=f"l{seq}", event=event, seq=seq, ts=utc(2024, 1, 1, 0, 0, seq % 60, seq))
        if event == "started":
            row.update(file_count=value, data_format_version=f"v{value}")
        elif event == "completed":
            row.update(row_count=value)
        else:
            row.update(error_message=f"e{value}")
        rows.append(tuple(row[f] for f in FIELDS))
    return spark.createDataFrame(rows, Z.EVENT_FIELDS)


def model(steps):
    """Direct update rules, one event at a time."""
    state = {}
    for export, period, version, event, value in steps:
        key = (export, period, version)
        if event == "started":
            row = state.setdefault(key, dict(format=f"v{value}", current=False, rows=None))
            row.update(files=value, completed=False, error=None)
        elif event == "completed":
            for other, row in state.items():
                if other[:2] == key[:2] and other != key:
                    row["current"] = False
            state[key].update(completed=True, current=True, rows=value)
        else:
            state[key].update(completed=False, error=f"e{value}")
    return state


def snapshot(df):
    return {(r["export_name"], r["billing_period"], r["version_id"]): dict(
        format=r["data_format_version"], current=r["current_version"], rows=r["row_count"],
        files=r["file_count"], completed=r["load_completed"], error=r["error_message"])
        for r in df.collect()}


@pytest.mark.parametrize("seed", range(6))
def test_fold_equals_the_update_rules(spark, utc, seed):
    rng = random.Random(seed)
    steps, open_keys = [], []
    for _ in range(120):
        key = (rng.choice(["a", "a_b"]), rng.choice(["2024-01", "2024-02"]), rng.choice(["x", "y", "z"]))
        if open_keys and rng.random() < 0.6:
            done = open_keys.pop(rng.randrange(len(open_keys)))
            steps.append((*done, rng.choice(["completed", "failed"]), rng.randrange(1000)))
        else:
            open_keys.append(key)
            steps.append((*key, "started", rng.randrange(9)))
    got = snapshot(Z.fold_events(events_of(spark, utc, steps)))
    assert got == model(steps)


def test_documented_sequences(spark, utc):
    P = ("prod", "2024-01")
    def fold(*steps):
        return snapshot(Z.fold_events(events_of(spark, utc, list(steps))))
    one = fold((*P, "v1", "started", 5), (*P, "v1", "started", 6))
    assert one == {(*P, "v1"): dict(format="v5", current=False, rows=None, files=6, completed=False, error=None)}
    failed = fold((*P, "v1", "started", 5), (*P, "v1", "failed", 1))[(*P, "v1")]
    assert not failed["completed"] and failed["error"] == "e1"
    restarted = fold((*P, "v1", "started", 5), (*P, "v1", "completed", 9), (*P, "v1", "started", 5))[(*P, "v1")]
    assert restarted["current"] and not restarted["completed"] and restarted["rows"] == 9


def test_listings_and_catalogue(spark, utc):
    steps = []
    for export, period, version, rows in [
        ("prod", "2024-01", "v123456789", 1000), ("prod", "2024-01", "v2", 1100), ("prod", "2024-02", "w1", 1500),
        ("prod_eu", "2024-01", "x1", 7),
    ]:
        steps += [(export, period, version, "started", 2), (export, period, version, "completed", rows)]
    steps.append(("only_started", "2024-01", "s", "started", 1))
    events = events_of(spark, utc, steps)
    state = Z.fold_events(events)
    current = Z.current_versions(state, "aws", "prod").collect()
    assert [(r["billing_period"], r["version_id"], r["row_count"]) for r in current] == [("2024-02", "w1", 1500), ("2024-01", "v2", 1100)]
    history = Z.version_history(state, "aws", "prod", "2024-01").collect()
    assert [(r["version_id"], r["current_version"]) for r in history] == [("v2", True), ("v123456789", False)]
    assert [r["status"] for r in Z.show_state(state, "aws", "only_started", "2024-01").collect()] == ["In Progress"]
    assert Z.show_state(state, "aws", "prod").count() == 2
    tables = Z.period_tables(Z.current_loads(events))
    mine = Z.tables_of_export(tables, "aws", "prod").collect()
    assert [(r["table_name"], r["rows"]) for r in mine] == [("prod_2024_01", 1100), ("prod_2024_02", 1500)]
    summary = {r["table_name"]: (r["rows"], r["version"], r["total_rows"]) for r in Z.load_summary(tables, state).collect()}
    assert summary == {"prod_2024_01": (1100, "v2", 2600), "prod_2024_02": (1500, "w1", 2600), "prod_eu_2024_01": (7, "x1", 7)}
    catalogue = [tuple(r) for r in Z.exports_catalogue(state, tables).collect()]
    assert catalogue == [("aws", "prod", 2, 2600, 2), ("aws", "prod_eu", 1, 7, 2)]
    assert Z.table_name_collisions(tables).count() == 0
    asked = events.select(*Z.VERSION_KEY).distinct()
    assert Z.is_version_loaded(state, asked).count() == 4
    assert [r["version_id"] for r in Z.pending_versions(asked, state).collect()] == ["s"]
    assert Z.pending_versions(asked, state, reset=True).count() == 5


def test_table_name_collisions_are_seen(rows):
    tables = Z.period_tables(rows("vendor string, export_name string, billing_period string, row_count long, version_id string",
                                  ("aws", "prod-a", "2024-01", 1, "v"), ("aws", "prod a", "2024-01", 1, "v")))
    assert Z.table_name_collisions(tables).select("table_name", "owners").first()[1] == 2
