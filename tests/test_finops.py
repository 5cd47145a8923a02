"""Sketches, coverage, rates as of a day and tags down a tree, on small tables."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spendloom.operators import account_tree, commitments, rates, sketches


def sketched(df, months):
    return sketches.period_sketches(df.where(F.col("month").isin(months)), F.col("month"), ["user"], ["cost"])


def test_sketches_of_periods_merge_into_those_of_both(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b"]), rng.randint(1, 3000), rng.random() * 100) for _ in range(8000)] + [("a", None, None), (None, 5, 1.0)]
    df = spark.createDataFrame(rows, "month string, user int, cost double")
    both = sketches.merged_sketches(sketched(df, ["a", "b"]))
    at_once = sketches.merged_sketches(sketches.period_sketches(df.where("month IS NOT NULL"), F.lit("x"), ["user"], ["cost"]))
    columns = ["records", sketches.distinct_count("user"), sketches.quantile("cost", 0.25)]
    merged, whole = both.select(*columns).first(), at_once.select(*columns).first()
    assert merged[:2] == whole[:2]  # registers are the same ones
    users = len({user for month, user, _ in rows if month and user})
    costs = sorted(cost for month, _, cost in rows if month and cost is not None)
    assert abs(merged[1] - users) <= sketches.DISTINCT_ERROR * users
    for value in (merged[2], whole[2]):
        assert abs(sum(c <= value for c in costs) / len(costs) - 0.25) <= 2 * sketches.RANK_ERROR


def test_distributions_of_nothing(spark):
    nothing = spark.createDataFrame([], "month string, user int, cost double")
    empty = sketches.merged_sketches(sketched(nothing, ["a"]))
    assert empty.select("records", sketches.distinct_count("user"), sketches.quantile("cost", 0.5)).first() == (None, 0, None)
    got = sketches.compare_distributions(empty, empty, ["user"], ["cost"]).first()
    assert got.user_ok is None and got.cost_ok is None


def hour(day, h):
    return dt.datetime(2024, 1, day) + dt.timedelta(hours=h)


def test_coverage_equals_hour_by_hour(spark):
    rng = random.Random(2)

    def intervals(n):
        rows = []
        for _ in range(n):
            start = rng.randint(0, 60)
            rows.append((rng.choice(["x", "y", None]), hour(1, start), hour(1, start + rng.randint(0, 70)), Decimal(rng.randint(0, 4))))
        return rows

    use, held = intervals(40), intervals(12)
    kind = "service string, start timestamp, end timestamp, amount decimal(9,2)"
    odd = [("x", None, hour(2, 0), Decimal(1)), ("x", hour(2, 0), hour(1, 0), Decimal(1)), ("x", hour(1, 0), hour(2, 0), None)]
    got = commitments.commitment_coverage(spark.createDataFrame(use + odd, kind), spark.createDataFrame(held, kind), "service")
    want = {}
    for key in ("x", "y", None):
        for h in range(0, 24 * 6):
            used, committed = (sum(a for k, s, e, a in rows if k == key and s <= hour(1, h) < e) for rows in (use, held))
            if used or committed:
                sums = want.setdefault((key, hour(1, h).date()), [0, 0, 0])
                for i, x in enumerate((used, committed, min(used, committed))):
                    sums[i] += x
    found = {(r.service, r.date): [r.used_hours, r.committed_hours, r.covered_hours] for r in got.collect()}
    assert {k: v for k, v in found.items() if any(v)} == want


def test_coverage_within_the_hour_and_over_years(spark):
    kind = "service string, start timestamp, end timestamp, amount int"
    use = spark.createDataFrame([("x", dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 0, 36), 2)], kind)
    held = spark.createDataFrame([("x", dt.datetime(2023, 1, 1), dt.datetime(2026, 1, 1), 1)], kind)
    got = {str(r.date): r for r in commitments.commitment_coverage(use, held, "service").collect()}
    assert len(got) == 3 * 365 + 1
    assert got["2024-01-01"][2:] == (Decimal("0.02"), 24, Decimal("0.01"))


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


@pytest.mark.parametrize("oldest", [None, 20])
def test_rates_as_of_equal_the_last_before(spark, oldest):
    rng = random.Random(3)
    given = [(rng.choice(["EUR", "GBP"]), day(rng.randint(40, 400)), Decimal(rng.randint(1, 500)) / 100) for _ in range(30)]
    given += [("EUR", given[0][1], Decimal("9.99")), (None, day(50), Decimal(1)), ("EUR", None, Decimal(1)), ("EUR", day(1), None)]
    asked = [(c, day(n)) for c in ("EUR", "GBP", "CHF") for n in range(0, 500, 7)] + [(None, day(3)), ("EUR", None)]
    days = spark.createDataFrame(asked, "currency string, date date")
    got = rates.rates_as_of(days, spark.createDataFrame(given, "currency string, date date, rate decimal(9,2)"), oldest)
    assert got.columns == ["currency", "date", "rate", "rate_date"]
    want = {}
    for c, d in asked:
        known = [(date, rate) for currency, date, rate in given if None not in (c, d, date, rate) and currency == c and date <= d]
        best = max(known, default=None)
        if best and oldest is not None and (d - best[0]).days > oldest:
            best = None
        want[c, d] = best
    found = {(r.currency, r.date): (r.rate_date, r.rate) if r.rate is not None else None for r in got.collect()}
    assert found == want


KIND = "account string, parent string, tags map<string,string>"


def tree(spark, rows):
    return {r.account: (r.depth, r.tags) for r in account_tree.tags_of_accounts(spark.createDataFrame(rows, KIND)).collect()}


def test_tags_go_down_the_tree(spark):
    chain = [(f"n{i}", f"n{i - 1}" if i else None, {f"k{i % 3}": f"v{i}"} if i % 2 == 0 else None) for i in range(14)]
    got = tree(spark, chain + [("lost", "unknown", {"a": "1"}), ("n3", "n2", {"own": "x"}), (None, None, {"a": "b"})])
    expected = {}
    for i in range(14):
        expected |= {f"k{i % 3}": f"v{i}"} if i % 2 == 0 else {}
        expected |= {"own": "x"} if i == 3 else {}
        assert got[f"n{i}"] == (i, expected)
    assert got["lost"] == (0, {"a": "1"}) and len(got) == 15
    assert tree(spark, []) == {}


@pytest.mark.parametrize("rows", [[("a", "b", None), ("b", "c", None), ("c", "a", None), ("root", None, None)], [("a", "a", None)]])
def test_cycles_of_accounts_fail(spark, rows):
    with pytest.raises(PySparkException, match="is above itself"):
        tree(spark, rows)


def test_two_parents_fail(spark):
    for other in ("c", None):
        with pytest.raises(PySparkException, match="two parents of account a"):
            tree(spark, [("a", "b", None), ("a", other, None)])


def test_lines_get_all_tags(spark):
    accounts = spark.createDataFrame([("root", None, {"team": "core", "env": "x"}), ("leaf", "root", {"env": "dev"})], KIND)
    lines = spark.createDataFrame([("leaf", {"app": "web"}), ("unknown", None)], "acc string, tags map<string,string>")
    got = account_tree.tags_of_lines(lines, accounts, "acc", F.col("tags")).collect()
    assert {r.acc: r.all_tags for r in got} == {"leaf": {"team": "core", "env": "dev", "app": "web"}, "unknown": {}}


def test_a_long_chain_of_accounts_takes_few_rounds(spark, monkeypatch):
    """Depth 200 in eight doublings of reach, nearest tags first; a cycle ends after as many as there are accounts."""
    rounds, further = [], getattr(account_tree, "_further", None)
    monkeypatch.setattr(account_tree, "_further", lambda walked: rounds.append(1) or further(walked), raising=False)
    got = tree(spark, [(f"n{i}", f"n{i - 1}", {f"k{i // 70}": str(i)}) for i in range(201)] + [("n0", "n-1", None)])
    assert got["n200"] == (200, {"k0": "69", "k1": "139", "k2": "200"}) and got["n0"] == (0, {"k0": "0"}) and len(got) == 201
    assert {name: depth for name, (depth, _) in got.items()} == {f"n{i}": i for i in range(201)}
    assert len(rounds) == 8
