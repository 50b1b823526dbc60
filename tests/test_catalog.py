"""Every query of the lane against its SQL twin, and the fixed expectations at sf0.01; corpus queries have tests of their own."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from oracle import compare, connect
from shoplane.operators import staging
from shoplane.operators.daily import daily_totals, volume_anomalies
from shoplane.plans import catalog, catalog_sql, questions
from shoplane.sources import star

from conftest import TESTDATA

SMALL, MIDDLE = str(TESTDATA / "sf0.001"), str(TESTDATA / "sf0.01")


def _compared(spark, name, connection):
    try:
        query, sql = entry_point.queries()[name], entry_point.oracle_sql()[name]
        return compare(spark, SMALL, query, sql, connection.cursor())
    except Exception as problem:
        return f"{type(problem).__name__}: {problem}"


@pytest.fixture(scope="module")
def differences(request, spark):
    """What differs per query, for the queries this run asks for; small jobs, so several run at a time."""
    asked = [item.callspec.params["name"] for item in request.session.items if item.name.startswith("test_query_equals")]
    connection = connect(SMALL)
    with ThreadPoolExecutor(8) as pool:
        return dict(zip(asked, pool.map(lambda name: _compared(spark, name, connection), asked), strict=True))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_its_sql(differences, name):
    assert differences[name] is None


def test_entry_has_rows(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["day", "orders", "gross_revenue", "net_revenue", "aov"]
    assert frame.count() > 0


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog_sql.oracle_sql())


def test_known_totals(spark):
    clean, spoiled = star.clean_tables(spark, MIDDLE), star.defect_tables(spark, MIDDLE)
    revenue = questions.daily_revenue(clean["orders"]).agg(F.sum("gross_revenue"), F.sum("net_revenue")).first()
    assert tuple(revenue) == (Decimal("49872750.00"), Decimal("29839493.60"))
    assert clean["products"].agg(F.sum("cost")).first()[0] == Decimal("1185941.52")
    assert (spoiled["orders"].count(), spoiled["payments"].count()) == (15016, 14984)
    classes = questions.uncovered_orders(spoiled["orders"], spoiled["payments"]).groupBy("coverage").count()
    assert {row["coverage"]: row["count"] for row in classes.collect()} == {"missing": 48, "under": 16, "over": 48}


def test_known_defect_counts(spark):
    orders = star.defect_orders(spark, MIDDLE)
    counts = orders.agg(
        F.count_if(F.col("customer_id").isNull()),
        F.count_if(F.col("quantity") <= 0),
        F.count_if((F.col("unit_price") < 0) | (F.col("total_amount") < 0)),
        F.count_if(F.col("total_amount") != F.col("unit_price") * F.col("quantity")),
    ).first()
    assert tuple(counts) == (16, 16, 16, 45)
    assert staging.removed_by_dedup(orders).count() == 16


def test_known_anomalies_over_days_with_orders(spark):
    flags = volume_anomalies(daily_totals(star.orders(spark, MIDDLE))).groupBy("flag").count()
    assert {row["flag"]: row["count"] for row in flags.collect()} == {"normal": 2382, "spike": 15, "drop": 2}
