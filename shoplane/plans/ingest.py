"""Landing the source tables a little at a time.

``land_new`` is cheap and runs often: it sees inserts by key. ``land_snapshot`` scans the table and sees updates and
deletes as well, for the source keeps no time of change; it runs on a slower schedule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shoplane.contracts import PRIMARY_KEYS, TABLES
from shoplane.operators.capture import apply_changes, diff, high_mark, new_rows
from shoplane.operators.gates import require_contract
from shoplane.sources.tables import Lake


def landed(lake: Lake, table: str) -> DataFrame | None:
    """Rows landed by key so far."""
    return lake.read_log(f"landed/{table}", TABLES[table])


def land_new(lake: Lake, source: DataFrame, table: str, lookback: int = 0) -> int:
    """Append rows past the highest landed key, or missed within ``lookback`` keys of it; returns the mark used.

    A row that has landed never lands again, so a run that died after its append can simply be repeated.
    """
    require_contract(source, table, TABLES[table])
    key = PRIMARY_KEYS[table]
    source = source.select(*TABLES[table].fieldNames())
    known = landed(lake, table)
    if known is None:
        lake.append(source, f"landed/{table}")
        return 0
    mark = high_mark(known, key)
    lake.append(new_rows(source, known, key, mark, lookback), f"landed/{table}")
    return mark


def land_snapshot(lake: Lake, snapshot: DataFrame, table: str) -> DataFrame:
    """Bring the landed table to ``snapshot`` and return the changes (all inserts the first time).

    Changes are written first; the new table version and the changes become current together.
    """
    require_contract(snapshot, table, TABLES[table])
    key = PRIMARY_KEYS[table]
    snapshot = snapshot.select(*TABLES[table].fieldNames())
    current = lake.read(f"raw_{table}")
    before = snapshot.limit(0) if current is None else current
    changes = lake.write(diff(before, snapshot, key, by_fingerprint=current is not None), f"changes_{table}")
    table_after = snapshot if current is None else apply_changes(current, lake.open(changes), key)
    lake.publish({f"changes_{table}": changes, f"raw_{table}": lake.write(table_after, f"raw_{table}")})
    return lake.open(changes)
