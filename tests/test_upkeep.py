"""Restated lines, reciprocal allocation, seasonal costs and mart refreshes, against plain versions."""

import datetime as dt
import random
import statistics
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendloom.operators import marts, reciprocal, restatement, seasonal
from spendloom.operators.lake import BillingLake


def test_restated_lines_equal_a_multiset_difference(spark):
    rng = random.Random(4)

    def version():
        return [(rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", None]), rng.choice(["x", "y", None]), Decimal(rng.randint(0, 2))) for _ in range(60)]

    old, new = version(), version()
    kind = "id string, p string, q string, cost decimal(9,2)"
    got = restatement.restated_lines(spark.createDataFrame(old, kind), spark.createDataFrame(new, kind), "id", "cost", ("p", "q"))
    before, after = Counter(old), Counter(new)
    want = {}
    for key in ("a", "b", "c", None):
        gone = [row for row in (before - after).elements() if row[0] == key]
        come = [row for row in (after - before).elements() if row[0] == key]
        if gone or come:
            pairs = min(len(gone), len(come))
            names = [name for i, name in ((1, "p"), (2, "q")) if Counter(r[i] for r in gone) != Counter(r[i] for r in come)]
            costs = sum(r[3] for r in gone), sum(r[3] for r in come)
            want[key] = (len(come) - pairs, len(gone) - pairs, pairs, *costs, costs[1] - costs[0], names)
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want
    total = restatement.restatement_summary(got).first()
    assert total == (len(want), *(sum(w[i] for w in want.values()) for i in range(3)), sum(w[5] for w in want.values()))


def test_restated_lines_of_drifting_columns(spark):
    old = spark.createDataFrame([("a", 1, "7"), ("b", 2, "8")], "id string, cost int, code string")
    new = spark.createDataFrame([("a", Decimal(1), 7, None), ("b", Decimal(2), 8, "new")], "id string, cost decimal(9,2), code int, more string")
    got = restatement.restated_lines(old, new, "id", "cost", ("code", "more")).collect()
    assert [(r.id, r.changed, r.cost_delta, r.changed_columns) for r in got] == [("b", 1, 0, ["more"])]
    assert restatement.restated_lines(old, old, "id", "cost").count() == 0
    assert restatement.restatement_summary(restatement.restated_lines(old, old, "id", "cost")).first() == (0, 0, 0, 0, 0)


WEIGHTS = [("s1", "s2", 2), ("s1", "o1", 3), ("s2", "s3", 5), ("s2", "s1", 1), ("s2", "o2", 2), ("s3", "s1", 4), ("s3", "o1", 1), ("s3", "s3", 9), ("s1", "o1", 1)]
COSTS = [("m1", "s1", 10), ("m1", "s1", 20), ("m1", "o1", 5), ("m1", None, 4), ("m2", "s3", -7), ("m2", "o9", 3), ("m2", "s2", None)]


def allocated(spark, how, weights=WEIGHTS, *more):
    costs = spark.createDataFrame(COSTS, "billing_period string, centre string, cost int")
    found = how(costs, spark.createDataFrame(weights, "origin string, target string, weight int"), *more).collect()
    return {(r.billing_period, r.owner): (r.own_cost, r.allocated_cost) for r in found}


def test_reciprocal_allocation_solves_the_equations(spark):
    got = allocated(spark, reciprocal.allocate_reciprocal)
    served = ["s1", "s2", "s3"]
    sums = {s: sum(w for a, b, w in WEIGHTS if a == s and b != s) for s in served}

    def share(a, b):
        return sum(w for x, y, w in WEIGHTS if (x, y) == (a, b) and a != b) / sums[a]

    for period in ("m1", "m2"):
        own = Counter()
        for month, centre, cost in COSTS:
            own[centre] += (cost or 0) if month == period else 0
        through = np.eye(3) - np.array([[share(a, b) for a in served] for b in served])
        gross = np.linalg.solve(through, [own[s] for s in served])
        for owner in ("o1", "o2", "o9", None):
            want = own[owner] + (sum(g * share(s, owner) for g, s in zip(gross, served)) if owner in ("o1", "o2") else 0)
            assert got.get((period, owner), (0, 0)) == pytest.approx((own[owner], want), abs=1e-9)
        assert sum(v[1] for k, v in got.items() if k[0] == period) == pytest.approx(sum(own.values()))


def test_step_down_allocation_charges_later_centres_only(spark):
    got = allocated(spark, reciprocal.allocate_step_down, WEIGHTS, ["s2", "s3", "s1"])
    # s2 keeps all its targets; s3 charges s1 and o1; s1 charges o1 alone.
    assert got["m1", "o1"] == pytest.approx((5, 35)) and got["m1", None] == (4, 4) and got["m2", "o1"] == pytest.approx((0, -7))
    with pytest.raises(ValueError, match="no place in the order for s3"):
        allocated(spark, reciprocal.allocate_step_down, WEIGHTS, ["s1", "s2"])


def test_centres_without_an_owner_fail(spark):
    with pytest.raises(ValueError, match="costs of centre s1 reach no owner"):
        allocated(spark, reciprocal.allocate_reciprocal, [("s1", "s2", 1), ("s2", "s1", 1)], 3)
    with pytest.raises(ValueError, match="negative weight from s1"):
        allocated(spark, reciprocal.allocate_reciprocal, [("s1", "o1", -1)])


def folded(costs):
    level = sum(costs[:7]) / 7
    factors, told = [c - level for c in costs[:7]], []
    for n, cost in enumerate(costs[7:]):
        told.append(level + factors[n % 7])
        error = cost - told[-1]
        level, factors[n % 7] = level + error * 0.25, factors[n % 7] + error * 0.125
    return level, factors, told


def test_seasonal_costs_equal_a_plain_fold(spark):
    rng = random.Random(5)
    first = dt.date(2024, 1, 3)
    days = {"a": [100 + 40 * (n % 7 == 2) + rng.random() for n in range(60)], "few": [1.0] * 13, "gap": [5.0] + [0.0] * 20 + [6.0]}
    days["a"][45] += 300
    rows = [(k, dt.datetime.combine(first + dt.timedelta(days=n), dt.time(5)), part) for k, costs in days.items() for n, c in enumerate(costs) if c for part in (c / 2, c / 2)]
    lines = spark.createDataFrame(rows + [("a", None, 9.0), ("a", rows[0][1], None)], "k string, ts timestamp, cost double")
    got = {(r.k, r.date): (r.forecast, r.low, r.high) for r in seasonal.seasonal_forecast(lines, "k", "cost", "ts").collect()}
    want = {("few", None): (None, None, None)}
    odd = {}
    for key in ("a", "gap"):
        costs = days[key]
        level, factors, told = folded(costs)
        errors = [c - t for c, t in zip(costs[7:], told)]
        centre = statistics.median(errors)
        width = 3 * 1.4826 * statistics.median(abs(e - centre) for e in errors)
        for ahead in range(7):
            value = level + factors[(len(costs) + ahead) % 7]
            want[key, first + dt.timedelta(days=len(costs) + ahead)] = (value, value - width, value + width)
        odd |= {(key, first + dt.timedelta(days=n + 7)): (costs[n + 7], told[n]) for n, e in enumerate(errors) if abs(e - centre) > width}
    assert got.keys() == want.keys() and ("a", first + dt.timedelta(days=45)) in odd
    for key, value in want.items():
        assert got[key] == pytest.approx(value, abs=1e-4)
    found = {(r.k, r.date): (r.cost, r.expected) for r in seasonal.seasonal_anomalies(lines, "k", "cost", "ts").collect()}
    assert {k for k in found if k[0] == "a"} == {k for k in odd if k[0] == "a"}
    assert found["a", first + dt.timedelta(days=45)] == pytest.approx(odd["a", first + dt.timedelta(days=45)], abs=1e-4)


def test_a_refresh_reads_changed_periods_only(spark, tmp_path):
    lake = BillingLake(spark, str(tmp_path / "lake"), "aws", "x")
    path, read = str(tmp_path / "mart"), []

    def build(lines):
        read.append({name.split("billing_period=")[1][:7] for name in lines.inputFiles()})
        return lines.groupBy("billing_period", "load_id", "service_name").agg(F.count("*").alias("line_items"), F.sum("cost").alias("cost"))

    def load(period, version, rows):
        frame = spark.createDataFrame(rows, "service_name string, cost int")
        return lake.replace_period(lambda: frame, period, version, "v1", 1)

    def held():
        got, full = marts.read_mart(lake, path), build(lake.unified_view())
        read.pop()
        rows = sorted(got.select("billing_period", "service_name", "line_items", "cost").collect())
        assert rows == sorted(full.select("billing_period", "service_name", "line_items", "cost").collect())
        return len(rows)

    assert marts.refresh_mart(lake, path, build) == [] and marts.read_mart(lake, path) is None
    for period in ("2024-01", "2024-02", "2024-03"):
        load(period, "a", [("s", 1), ("s", 2), ("t", 3)])
    assert marts.refresh_mart(lake, path, build) == ["2024-01", "2024-02", "2024-03"] and held() == 6
    load("2024-02", "b", [("s", 5)])
    load("2024-03", "b", [])
    load("2024-04", "a", [("u", 1)])
    assert marts.refresh_mart(lake, path, build) == ["2024-02", "2024-03", "2024-04"] and held() == 4
    assert read == [{"2024-01", "2024-02", "2024-03"}, {"2024-02", "2024-04"}]
    assert marts.refresh_mart(lake, path, build) == [] and len(read) == 2
    load("2024-01", "b", [])
    assert marts.refresh_mart(lake, path, build) == ["2024-01"] and held() == 2 and len(read) == 2
