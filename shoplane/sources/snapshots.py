"""Snapshots by key range with a tree of checksums, so that a difference reads only what differs.

Rows lie in parts of ``PART`` keys, sorted by key. Every ``LEAF`` keys have a checksum: the number of their rows and the sums of
two 64-bit row hashes, which no order of rows changes; leaves are added up into parts and parts into a root. A new snapshot is
reduced to its leaves where it is read. Roots, then parts, then the leaves of differing parts are compared; rows are
fetched and joined for differing leaves only, so what is shuffled follows the changes and not the table. Bringing the table to the
new snapshot rewrites the parts that differ and their checksums, the checksums last: a run that dies is repeated, as a part
whose checksum is behind still differs.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplane.operators.capture import apply_changes, changes_between
from shoplane.sources.keyed import replace
from shoplane.sources.tables import Lake

#: Keys per part and per leaf.
PART, LEAF = 1 << 20, 1 << 8
SUM = "decimal(38,0)"


def _range(key: str, width: int) -> Column:
    return F.floor(F.col(key) / width).cast("bigint")


def leaves(rows: DataFrame, key: str, part: int = PART, leaf: int = LEAF) -> DataFrame:
    """part, leaf, n, low, high of every range of ``leaf`` keys that has rows; which columns are NULL is hashed as well."""
    columns = sorted(rows.columns)
    values = [*[F.col(name) for name in columns], *[F.col(name).isNull() for name in columns]]
    hashed = rows.select(
        _range(key, part).alias("part"),
        _range(key, leaf).alias("leaf"),
        *[F.xxhash64(F.lit(salt), *values).alias(name) for salt, name in ((0, "low"), (1, "high"))],
    )
    return hashed.groupBy("part", "leaf").agg(F.count("*").alias("n"), *[_sum_of(name).alias(name) for name in ("low", "high")])


def _sum_of(name: str) -> Column:
    """The exact sum of 64-bit numbers: their upper and lower halves are added up as longs, without a decimal per row."""
    upper, lower = F.sum(F.shiftright(name, 32)), F.sum(F.col(name).bitwiseAND(F.lit(0xFFFFFFFF)))
    return (upper.cast("decimal(20,0)") * F.lit(Decimal(1 << 32)) + lower).cast(SUM)


def rolled_up(tree: DataFrame, *level: str) -> DataFrame:
    """A level of the tree from the one below: by part, or the root."""
    return tree.groupBy(*level).agg(F.sum("n").alias("n"), *[F.sum(name).cast(SUM).alias(name) for name in ("low", "high")])


def _differing(old: DataFrame, new: DataFrame, *level: str) -> DataFrame:
    """Ranges whose checksums differ, or that one side does not have."""
    both = old.withColumn("_side", F.lit(-1)).unionByName(new.withColumn("_side", F.lit(1)))
    signed = [F.sum(F.col(name).cast(SUM) * F.col("_side")).alias(name) for name in ("n", "low", "high")]
    return both.groupBy(*level).agg(*signed).filter((F.col("n") != 0) | (F.col("low") != 0) | (F.col("high") != 0)).select(*level)


class Snapshot:
    """A table kept as parts and checksums."""

    def __init__(self, lake: Lake, table: str, key: str, columns: Sequence[str], part: int = PART, leaf: int = LEAF) -> None:
        if part % leaf:
            raise ValueError("a part holds whole leaves")
        self.lake, self.key, self.columns, self.part, self.leaf = lake, key, list(columns), part, leaf
        self.rows_log, self.tree_log = f"snapshot/{table}", f"snapshot_tree/{table}"

    def rows(self) -> DataFrame | None:
        rows = self.lake.read_log(self.rows_log)
        return None if rows is None else rows.select(*self.columns)

    def tree(self) -> DataFrame | None:
        return self.lake.read_log(self.tree_log)

    def differing(self, new: DataFrame) -> tuple[list[int], DataFrame | None]:
        """Parts that differ from ``new``, and their differing leaves (part, leaf); no row of the table is read."""
        made = self.lake.open(self.lake.write(leaves(new.select(*self.columns), self.key, self.part, self.leaf), "new_leaves"))
        tree = self.tree()
        old = made.limit(0) if tree is None else tree.select(*made.columns)
        if _differing(rolled_up(old), rolled_up(made)).isEmpty():
            return [], None
        parts = sorted(row[0] for row in _differing(rolled_up(old, "part"), rolled_up(made, "part"), "part").collect())  # one per PART keys
        here = F.col("part").isin(*parts)
        return parts, _differing(old.filter(here), made.filter(here), "part", "leaf")

    def diff(self, new: DataFrame) -> DataFrame:
        """As ``capture.diff`` of this snapshot and ``new``."""
        parts, found = self.differing(new)
        return self._changes(new, parts, found)

    def _changes(self, new: DataFrame, parts: list[int], found: DataFrame | None) -> DataFrame:
        new = new.select(*self.columns)
        if found is None:
            return changes_between(new.limit(0), new.limit(0), self.key)
        stored = self.lake.read_log(self.rows_log)
        stored = new.limit(0) if stored is None else stored.filter(F.col("part").isin(*parts)).select(*self.columns)

        def of_leaves(rows: DataFrame) -> DataFrame:
            return rows.withColumn("leaf", _range(self.key, self.leaf)).join(found.select("leaf"), "leaf", "left_semi").select(*self.columns)

        return changes_between(of_leaves(stored), of_leaves(new), self.key)

    def bring_to(self, new: DataFrame) -> DataFrame:
        """Rewrite the parts that differ from ``new``; returns the changes, written."""
        parts, found = self.differing(new)
        changes = self.lake.open(self.lake.write(self._changes(new, parts, found), "snapshot_changes"))
        if parts:
            known = self.lake.read_log(self.rows_log)
            before = None if known is None else known.filter(F.col("part").isin(*parts))
            base = new.limit(0) if before is None else before
            after = apply_changes(base.select(*self.columns), changes, self.key).withColumn("part", _range(self.key, self.part))
            self._put(after, before, parts)
        return changes

    def _put(self, rows: DataFrame, before: DataFrame | None, parts: list[int]) -> None:
        if before is None:
            self.lake.overwrite_days(rows, self.rows_log, "part")
        else:
            replace(self.lake, self.rows_log, rows, "part", parts, before)
        written = self.lake.read_log(self.rows_log)
        written = rows.limit(0) if written is None else written if before is None else written.filter(F.col("part").isin(*parts))
        tree, known = leaves(written.select(*self.columns), self.key, self.part, self.leaf), self.tree()
        replace(self.lake, self.tree_log, tree, "part", parts, None if known is None else known.filter(F.col("part").isin(*parts)))
