"""Scoring of builds against the ledger: which build could see an incident, and what it said."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest

from shoplane.contracts import DOMAINS, TABLES
from shoplane.operators import defects, scoring
from shoplane.plans import build as builds
from shoplane.session import scratch_path
from shoplane.sources.tables import Lake

from conftest import AS_OF

NOON = datetime(2026, 1, 5, 12, tzinfo=UTC)
REPORT = "check string, severity string, failed_rows bigint, sample string, as_of timestamp"


def hours(n):
    return NOON + timedelta(hours=n)


def reports(spark, *rows):
    """(hours, check, failed rows) as gate reports."""
    return spark.createDataFrame([(check, "error", n, None, hours(at)) for at, check, n in rows], REPORT)


def ledger(spark, *rows):
    return spark.createDataFrame([(key, hours(at)) for key, at in rows], "failure_key string, injected_at timestamp")


def test_an_incident_belongs_to_the_first_build_that_could_see_it(spark):
    seen = reports(spark, (0, "x", 0), (1, "x", 0), (30, "x", 0), (200, "x", 0))
    happened = ledger(spark, ("a", -9000), ("b", 0), ("c", 0.5), ("d", 1), ("e", 1.01), ("f", 29), ("g", 30), ("h", 100), ("i", 201))
    found = {row["failure_key"]: row["as_of"] for row in scoring.assigned(happened, seen).collect()}
    expected = {"a": 0, "b": 0, "c": 1, "d": 1, "e": 30, "f": 30, "g": 30, "h": 200}
    # collected moments are naive and in the zone of this process
    assert {key: None if at is None else at.timestamp() for key, at in found.items()} == {
        **{key: hours(n).timestamp() for key, n in expected.items()},
        "i": None,
    }


def test_precision_recall_and_delay(spark):
    signs = {"p": ("one", "two"), "q": ("two",), "r": ("three",)}
    seen = reports(
        spark,
        *((at, check, n) for at, counts in {1: (1, 0, 0), 2: (1, 4, 0), 3: (1, 4, 0), 4: (0, 5, 0)}.items() for check, n in zip(("one", "two", "three"), counts, strict=True)),
    )
    happened = ledger(spark, ("p", 0.5), ("p", 0.5), ("p", 2.5), ("q", 1.5), ("r", 3.5), ("r", 9))
    rows = {row["failure_key"]: tuple(row)[1:] for row in scoring.score_builds(happened, seen, signs).collect()}
    # p is accused by builds 1, 2 and 4 and struck before 1 and 3; q by 2 and 4; r never
    assert rows == {
        "p": (3, 0, 2, 3, 1, 0.3333, 0.5, 1800.0),
        "q": (1, 0, 1, 2, 1, 0.5, 1.0, 1800.0),
        "r": (2, 1, 1, 0, 0, None, 0.0, 1800.0),
    }


def test_no_builds_and_no_incidents(spark):
    none = reports(spark)
    assert [tuple(row)[:6] for row in scoring.score_builds(ledger(spark, ("p", 0)), none).collect()] == [("p", 1, 1, 0, 0, 0)]
    assert scoring.score_builds(ledger(spark), reports(spark, (0, "orders: contract", 1))).first()["precision"] == 0.0


def test_every_detectable_failure_has_signs():
    assert set(scoring.SIGNS) == set(defects.REGISTRY) - {"multi_failure_cascade"}


def test_recorded_incidents_and_real_builds_are_scored(spark, shop):
    lake, tables, at = Lake(spark, scratch_path(spark, "scored")), dict(shop), AS_OF
    builds.build(lake, tables, at, strict=False)
    for keys in (["negative_price", "orphan_payment"], ["recurring_incident", "malformed_data", "duplicate_order"], ["multi_failure_cascade"]):
        for key in keys:
            done = defects.inject_recorded(lake, tables, key, defects.Context(at + timedelta(minutes=1), seed=5))
            tables = {table: done.tables[table] for table in TABLES}
        at += timedelta(minutes=5)
        written = {table: lake.open(lake.write(rows, f"source_{table}")) for table, rows in tables.items()}
        if "multi_failure_cascade" in keys:
            with pytest.raises(Exception, match="contract|orders"):
                builds.build(lake, written, at, strict=False)
        else:
            builds.build(lake, written, at, DOMAINS, strict=False)
        tables = written
    found = {row["failure_key"]: row for row in scoring.score_builds(lake.ledger(), lake.read_log("gate_reports")).collect()}
    for key in ("negative_price", "orphan_payment", "malformed_data", "duplicate_order", "schema_drift"):
        assert (found[key]["incidents"], found[key]["recall"]) == (1, 1.0), key
    # the same sign shows either: one of two accusations is right
    assert found["negative_price"]["precision"] == found["recurring_incident"]["precision"] == 0.5
    # the contract stopped the build that could have seen the cascade's other parts
    assert found["missing_customer"]["recall"] == 0.0
    assert found["schema_drift"]["mean_delay_seconds"] == 240.0
