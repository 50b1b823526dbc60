"""Parts of a revenue change against every order of the factors, one after the other."""

from __future__ import annotations

from datetime import UTC, datetime
from decimal import Decimal
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplane.operators import decompose, quantiles

KIND = "ordered_at timestamp, item string, quantity int, total_amount decimal(12,2), status string"


def orders(spark, *rows):
    """(month, item, quantity, price in cents, status)."""
    made = [(datetime(2026, month, 3, tzinfo=UTC), item, n, Decimal(n * cents) / 100, status) for month, item, n, cents, status in rows]
    return spark.createDataFrame(made, KIND)


def by_permutations(old, new):
    """Parts of net(new) - net(old) by changing one factor after the other in every order; sides are item: (units, gross, net)."""
    items = sorted(old.keys() | new.keys())

    def factors(mine, other):
        units, others = sum(x[0] for x in mine.values()), sum(x[0] for x in other.values())
        share, price, kept = [], [], []
        for item in items:
            own, its = mine.get(item, (0, 0, 0)), other.get(item, (0, 0, 0))
            share.append(own[0] / units if units else its[0] / others)
            price.append(own[1] / own[0] if own[0] else its[1] / its[0])
            kept.append(own[2] / own[1] if own[1] else its[2] / its[1])
        return [units, np.array(share), np.array(price), np.array(kept)]

    before, after = factors(old, new), factors(new, old)
    parts = np.zeros(4)
    orders_of = list(permutations(range(4)))
    for order in orders_of:
        state = list(before)
        for place in order:
            was = state[0] * (state[1] * state[2] * state[3]).sum()
            state[place] = after[place]
            parts[place] += state[0] * (state[1] * state[2] * state[3]).sum() - was
    return parts / len(orders_of)


CASES = [
    [(1, "a", 4, 1000, "placed"), (1, "b", 2, 500, "cancelled"), (1, "b", 6, 500, "placed"), (2, "a", 3, 1100, "placed"), (2, "b", 9, 450, "returned"), (2, "b", 1, 450, "shipped")],
    [(1, "a", 4, 1000, "placed"), (2, "b", 3, 700, "placed"), (2, "c", 1, 333, "cancelled")],
    [(1, "a", 1, 999, "cancelled"), (2, "a", 7, 999, "placed")],
]


@pytest.mark.parametrize("rows", CASES)
def test_parts_are_means_over_all_orders(spark, rows):
    frame = orders(spark, *rows)
    row = decompose.revenue_decomposition(frame, "item").first()
    sides = []
    for month in (1, 2):
        side: dict = {}
        for _, item, n, cents, status in (r for r in rows if r[0] == month):
            units, gross, net = side.get(item, (0, 0.0, 0.0))
            value = n * cents / 100
            side[item] = (units + n, gross + value, net + value * (status not in ("cancelled", "returned")))
        sides.append(side)
    expected = by_permutations(*sides)
    assert [float(row[name]) for name in decompose.FACTORS] == pytest.approx(expected, abs=0.011)
    assert sum(row[name] for name in decompose.FACTORS) == row["change"] == row["net_new"] - row["net_old"]


def test_months_without_orders_are_all_volume(spark):
    frame = orders(spark, (1, "a", 2, 1000, "placed"), (3, "a", 5, 1000, "placed"))
    rows = {row["month"].month: row for row in decompose.revenue_decomposition(frame, "item").collect()}
    assert [(str(rows[month]["volume"]), str(rows[month]["change"])) for month in (2, 3)] == [("-20.00", "-20.00"), ("50.00", "50.00")]
    assert rows[2]["cancellation_rate_new"] is None and rows[2]["cancellation_rate_old"] == 0.0


@pytest.mark.parametrize("levels", [0, 1, 3])
def test_quantiles_of_odd_groups(spark, levels):
    draw = np.random.default_rng(5)
    groups = {
        "even": draw.random(800).tolist(),
        "heavy tail": (draw.pareto(0.3, 700) * 1e6).tolist(),
        "ties": [1.5] * 300 + [2.5] * 301 + [-7.0],
        "one": [3.25],
        "two": [-1.0, 1e300],
        "infinite": [float("-inf"), -1.0, 0.0, 2.0, float("inf")],
        None: list(map(float, range(100))),
    }
    rows = [(group, value) for group, values in groups.items() for value in values] + [("even", None), ("nothing", None)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(5)
    asked = (0.0, 0.25, 0.5, 0.99, 1.0)
    found = quantiles.exact_quantiles(frame, "g", "v", asked, bins=16, levels=levels).collect()
    assert len(found) == len(groups) * len(asked)
    for row in found:
        ordered = sorted(groups[row["g"]])
        at = row["probability"] * (len(ordered) - 1)
        low, high = ordered[int(at)], ordered[min(int(at) + 1, len(ordered) - 1)]
        expected = low if at == int(at) else low + (high - low) * (at - int(at))
        assert row["rows"] == len(ordered)
        assert row["quantile"] == pytest.approx(expected) or row["g"] == "infinite"


def test_quantiles_run_nothing_before_they_are_used(spark):
    frame = spark.range(5000).select(F.lit("x").alias("g"), (F.col("id") % 977).cast("long").alias("v"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quantiles", "lazy")
    found = quantiles.exact_quantiles(frame, "g", "v", (0.5,))
    assert list(tracker.getJobIdsForGroup("quantiles")) == []
    spark.sparkContext.setJobGroup("", "")
    assert found.first()["quantile"] == float(np.quantile(np.arange(5000) % 977, 0.5))
