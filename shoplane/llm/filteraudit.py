"""How five filters interact: what each removes at each step of each of the 120 orders in which they can be applied.

A text pass gives every document its mask of failed conditions; copies of texts are found by hash, whatever their number. Documents
are then counted by part, mask and labels, at most 128 kinds a part, and only these counts go on. For a part, the min-plus product
of the masks (0 where a filter fails, infinity where not) with the positions of the filters in every order (the inverse of the
permutation) is the step that removes a mask in an order; weighted scatters over (order, step) then give removals and label
losses, and comparing positions with removal steps gives redundancies. Parts are worked on side by side, each from its counts.

A null text is empty; a null lang is the part ''. A null doc_id is never a copy of another row, nor another row of it, and has no
labels; rows with equal ids and texts are no copies of each other. Several labels of an id count as one, good or toxic where any
of them is 1. An empty table has no parts and gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplane.llm.common import stored
from shoplane.llm.firsts import with_first

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"

#: Filters by order: the place (from 0) of every filter in every order, the inverse of the permutation.
POSITIONS = np.array([[order.index(name) for order in ORDERS] for name in FILTERS])
#: Masks by filter: whether a mask fails a filter.
MASKS = (np.arange(1 << len(FILTERS))[:, None] >> np.arange(len(FILTERS)) & 1).astype(bool)
NEVER = len(FILTERS)

RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_mask(raw: bytes, n_chars: int, least_words: int = 100, distinct_percent: int = 80, capital_percent: int = 10) -> int:
    """Which of the conditions A to D a text fails, as bits 0 to 3."""
    words = raw.split()  # at exactly the blanks of the contract: space and the controls 9 to 13
    short = len(words) < least_words
    repetitive = 100 * len(set(words)) < distinct_percent * len(words)
    loud = 100 * (len(raw) - len(raw.translate(None, CAPITALS))) > capital_percent * n_chars
    marked = len(raw) != len(raw.translate(None, MARKS))
    return short | repetitive << 1 | loud << 2 | marked << 3


def removal_steps(masks: np.ndarray = MASKS, positions: np.ndarray = POSITIONS) -> np.ndarray:
    """Masks by order: the place of the first filter that fails; NEVER where none does."""
    costs = np.where(masks, 0, NEVER)  # min-plus: 0 keeps a position, NEVER takes it beyond every real one
    return np.minimum(costs[:, :, None] + positions[None], NEVER).min(1)


REMOVED_AT = removal_steps()


def audit_counts(mask: np.ndarray, good: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Every count by (order, step), from documents of a part counted by mask and labels."""
    n_orders, n_steps = len(ORDERS), len(FILTERS)
    by_mask = np.bincount(mask, weight, 1 << n_steps).astype(np.int64)
    cells = np.arange(n_orders) * (n_steps + 1) + REMOVED_AT[mask]  # (order, removal step) of every kind of document

    def scattered(weights: np.ndarray) -> np.ndarray:
        spread = np.broadcast_to(weights[:, None], cells.shape)
        return np.bincount(cells.ravel(), spread.ravel(), n_orders * (n_steps + 1)).astype(np.int64).reshape(n_orders, -1)[:, :n_steps]

    removed = scattered(weight)
    at = np.argsort(POSITIONS, axis=0).T  # orders by step: the filter there
    earlier = REMOVED_AT[:, None, :] < POSITIONS[None]  # masks by filter by order
    redundant = np.einsum("m,mf,mfo->of", by_mask, MASKS, earlier)
    alone = by_mask[1 << np.arange(n_steps)]
    per_filter = np.zeros(n_steps, np.int64)
    np.add.at(per_filter, at.ravel(), removed.ravel())
    return {
        "kept": weight.sum() - np.cumsum(removed, 1),
        "removed": removed,
        "redundant": np.take_along_axis(redundant, at, 1),
        "unique_fails": alone[at],
        "good_lost": scattered(weight * good),
        "toxic_lost": scattered(weight * toxic),
        "shapley": per_filter[at],
    }


def text_masks(documents: DataFrame) -> DataFrame:
    """doc_id, part, sha (of the whole text), mask (conditions A to D) of every document."""
    def masks(batches):
        for batch in batches:
            raws, sizes = batch.column(2), pc.utf8_length(batch.column(2).cast(pa.string())).to_pylist()
            found, hashes = [], []
            for raw, size in zip(raws, sizes, strict=True):
                raw = raw.as_py()
                found.append(text_mask(raw, size))
                hashes.append(hashlib.sha256(raw).digest())
            arrays = [batch.column(0), batch.column(1), pa.array(hashes, pa.binary()), pa.array(found, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "part", "sha", "mask"])

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    part = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), text.alias("text"))
    return rows.mapInArrow(masks, "doc_id long, part string, sha binary, mask int")


def failure_counts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (A to E), good, toxic, weight: the documents of every kind."""
    rows = stored(text_masks(documents), "masks")
    known = with_first(rows.filter(F.col("doc_id").isNotNull()), "sha", F.col("doc_id"), "first")
    copied = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    masked = known.select("doc_id", "part", F.when(copied, F.col("mask") + 16).otherwise(F.col("mask")).alias("mask"))
    # one row per id, part and mask before the labels are joined, so that no id is heavy
    counted = masked.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("weight"))

    def marked(name: str):
        return F.coalesce(F.max((F.col(name) == 1).cast("int")), F.lit(0)).alias(name)

    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(marked("quality").alias("good"), marked("toxic").alias("toxic"))
    labelled = counted.join(marks, "doc_id", "left").select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), "weight")
    unknown = rows.filter(F.col("doc_id").isNull()).select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"), F.lit(1).cast("long").alias("weight"))
    return labelled.unionByName(unknown).groupBy("part", "mask", "good", "toxic").agg(F.sum("weight").alias("weight"))


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""

    def of_part(counts: pd.DataFrame) -> pd.DataFrame:
        found = audit_counts(*(counts[name].to_numpy(np.int64) for name in ("mask", "good", "toxic", "weight")))
        steps = len(FILTERS)
        columns = {"part": counts["part"].iloc[0], "filter_order": np.repeat(ORDERS, steps), "step": np.tile(np.arange(1, steps + 1, dtype=np.int32), len(ORDERS))}
        return pd.DataFrame(columns | {name: values.ravel() for name, values in found.items()})

    return failure_counts(documents, labels).groupBy("part").applyInPandas(of_part, RESULT)
