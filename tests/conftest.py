from __future__ import annotations

import sys
from datetime import UTC, datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TESTDATA = Path("/root/testdata")
AS_OF = datetime(2026, 1, 15, 12, tzinfo=UTC)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("shoplane-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def shop(spark, tmp_path_factory):
    """A clean shop with a little traffic at the moment of the build, written once."""
    from shoplane.contracts import TABLES
    from shoplane.operators import synth

    folder = tmp_path_factory.mktemp("shop")
    tables = synth.make_baseline(spark, AS_OF, customers=120, products=80, orders=1500)
    tables["orders"] = tables["orders"].unionByName(synth.make_traffic(tables, 3, 7, AS_OF))
    for table in TABLES:
        tables[table].coalesce(2).write.parquet(f"{folder}/{table}")
    return {table: spark.read.parquet(f"{folder}/{table}") for table in TABLES}
