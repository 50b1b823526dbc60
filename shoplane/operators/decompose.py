"""Why net revenue moved from one period to the next: volume, mix, price and cancellation, adding up to the change exactly.

Net revenue of a period is units * sum over items of (share of units * price per unit * kept share of revenue). Each of the four
factors is either the old or the new one, which makes sixteen revenues between the two real ones; a factor's part is its mean
effect over all orders in which the factors could change (its Shapley value), so no order is preferred and the parts add up.
Parts are rounded to cents and mix takes what rounding leaves. An item that only one period has keeps the price and kept share of
that one; a period without units takes the other's shares, so all of its change is volume.
"""

from __future__ import annotations

from functools import reduce
from itertools import product
from math import factorial
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplane.functions.scalars import earns, money, total

FACTORS = ("volume", "mix", "price", "cancellation")


def shapley_weights(factor: int) -> dict[tuple[int, ...], float]:
    """What every state of the factors (1: new) counts in the part of ``factor``."""
    weights = {}
    for state in product((0, 1), repeat=len(FACTORS)):
        others = sum(state) - state[factor]
        weight = factorial(others) * factorial(len(FACTORS) - 1 - others) / factorial(len(FACTORS))
        weights[state] = weight if state[factor] else -weight
    return weights


def _cells(orders: DataFrame, item: str) -> DataFrame:
    """Units, gross, net, orders and cancelled orders per month and item; combined before the shuffle, so no month is heavy."""
    month = F.date_trunc("month", "ordered_at").cast("date").alias("month")
    return orders.groupBy(month, F.col(item).alias("item")).agg(
        F.sum("quantity").cast("double").alias("q"),
        total(F.col("total_amount")).alias("g"),
        total(F.when(earns(), F.col("total_amount"))).alias("n"),
        F.count("*").alias("orders"),
        F.count_if(F.col("status") == "cancelled").alias("cancelled"),
    )


def revenue_decomposition(orders: DataFrame, item: str) -> DataFrame:
    """One row per month after the first: the change of net revenue against the month before, its four parts, and cancellation rates."""
    cells = _cells(orders, item)
    names = ("q", "g", "n", "orders", "cancelled")
    own = [F.col(name).alias(f"{name}_new") for name in names] + [F.lit(0).cast(cells.schema[name].dataType).alias(f"{name}_old") for name in names]
    previous = [F.lit(0).cast(cells.schema[name].dataType).alias(f"{name}_new") for name in names] + [F.col(name).alias(f"{name}_old") for name in names]
    both = cells.select("month", "item", *own).unionByName(cells.select(F.add_months("month", 1).alias("month"), "item", *previous))
    paired = both.groupBy("month", "item").agg(*[F.sum(f"{name}_{side}").alias(f"{name}_{side}") for name in names for side in ("old", "new")])
    months = paired.groupBy("month").agg(*[F.sum(f"{name}_{side}").alias(f"{name}_{side}_all") for name in ("q", "n", "orders", "cancelled") for side in ("old", "new")])
    first = cells.agg(F.min("month").alias("_first"), F.max("month").alias("_last"))  # one row
    joined = paired.join(months, "month").join(F.broadcast(first), (F.col("month") > F.col("_first")) & (F.col("month") <= F.col("_last")))

    def either(name: str, of) -> list[Column]:
        """A factor of the old and the new period, each taken from the other where it has none."""
        old, new = of("old"), of("new")
        return [F.coalesce(old, new, F.lit(0.0)).alias(f"{name}_0"), F.coalesce(new, old, F.lit(0.0)).alias(f"{name}_1")]

    def ratio(above: str, below: str):
        return lambda side: F.try_divide(F.col(above.format(side)).cast("double"), F.col(below.format(side)).cast("double"))

    factors = joined.select(
        *months.columns,
        *either("s", ratio("q_{}", "q_{}_all")),
        *either("p", ratio("g_{}", "q_{}")),
        *either("k", ratio("n_{}", "g_{}")),
    )
    between = [F.sum(F.col(f"s_{s}") * F.col(f"p_{p}") * F.col(f"k_{k}")).alias(f"r_{s}{p}{k}") for s, p, k in product((0, 1), repeat=3)]
    summed = factors.groupBy(*months.columns).agg(*between)

    def revenue(state: tuple[int, ...]) -> Column:
        return F.col(("q_old_all", "q_new_all")[state[0]]) * F.col("r_" + "".join(map(str, state[1:])))

    parts = {}
    for place, name in enumerate(FACTORS):
        weighted = [F.lit(weight) * revenue(state) for state, weight in shapley_weights(place).items()]
        parts[name] = money(reduce(add, weighted).cast("decimal(28,8)"))
    change = (F.col("n_new_all") - F.col("n_old_all")).cast("decimal(28,2)")
    mix = (change - parts["volume"] - parts["price"] - parts["cancellation"]).cast("decimal(28,2)")
    rates = [F.round(F.try_divide(F.col(f"cancelled_{side}_all"), F.col(f"orders_{side}_all")), 4).alias(f"cancellation_rate_{side}") for side in ("old", "new")]
    return summed.select(
        "month",
        F.col("n_old_all").alias("net_old"),
        F.col("n_new_all").alias("net_new"),
        change.alias("change"),
        parts["volume"].alias("volume"),
        mix.alias("mix"),
        parts["price"].alias("price"),
        parts["cancellation"].alias("cancellation"),
        *rates,
    )
