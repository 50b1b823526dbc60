"""The question set straight from the published marts, and how long it takes."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplane.operators.daily import day_over_day, on_every_day, rolling_value, volume_anomalies
from shoplane.operators.quantiles import exact_quantiles
from shoplane.plans import questions
from shoplane.sources.tables import Lake


def answers(lake: Lake, top: int = 10, trend_days: int = 7) -> dict[str, DataFrame]:
    """Every question by name.

    Questions about days read the daily mart, a row per day; the others read the columns they need of the fact table.
    Volume is judged on orders as landed.
    """
    facts, daily = lake.read("fct_orders"), lake.read("fct_daily_revenue")
    line = on_every_day(daily)
    staged = {table: lake.read(f"landed_{table}") for table in ("customers", "products", "orders", "payments")}
    return {
        "daily_revenue": daily.select("day", "orders", "gross_revenue", "net_revenue"),
        "revenue_cuts": questions.revenue_cuts(facts),
        "order_value_per_day": daily.select("day", "orders", "aov"),
        "order_value_trend": rolling_value(line, trend_days),
        "top_customers": questions.top_customers(facts, top),
        "uncovered_orders": questions.uncovered_facts(facts),
        "orphan_summary": questions.orphan_summary(staged),
        "volume_change": day_over_day(line),
        "volume_flags": volume_anomalies(on_every_day(questions.daily_revenue(staged["orders"]))),
    }


def timed_runs(lake: Lake, repeats: int) -> DataFrame:
    """Run every question ``repeats`` times to completion: ``question, run, seconds``."""
    runs = []
    for run in range(repeats):
        for question, answer in answers(lake).items():
            started = time.perf_counter()
            answer.write.format("noop").mode("overwrite").save()
            runs.append((question, run, time.perf_counter() - started))
    return lake.spark.createDataFrame(runs, "question string, run int, seconds double")


def latency(runs: DataFrame) -> DataFrame:
    """p95 and p99 of recorded runs, over all questions (``all``) and per question."""
    both = runs.unionByName(runs.withColumn("question", F.lit("all")))
    return exact_quantiles(both, "question", "seconds", (0.95, 0.99))
