"""Mixing sources to target weights by cube-method balanced sampling.

A source whose target is r times its size takes floor(r) copies of every document and samples the rest with inclusion
probability frac(r). The flight phase moves the fractional probabilities of three documents at a time along the null space
of the balancing constraints (number of documents, number of words) until one of them reaches 0 or 1, so both totals stay
exact; it ends with at most two undecided documents. Sources are cut into chunks of about ``CHUNK`` documents that fly on
their own; the undecided ones of all chunks fly again, and so on until a source fits one chunk, where the landing takes,
of the four outcomes left at most, the one nearest to the source's remaining words, then documents.

Draws depend on ids and sizes only, not on partitions, so reruns agree. Null texts and texts without words have size 0; they
take floor(r) copies and none of their fraction, as they weigh nothing. A null source is a source of its own, the last.
Repeated rows are documents of their own. An empty table gives no rows. Other columns are passed through on request.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplane.llm.common import stored

CHUNK = 5000
CHUNK_BYTES = 1 << 25
WORDS = r"[^\x20\x09-\x0D]+"
EPS = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=(1.0, 2.0, 3.0), share: float = 1.0, most: float = 3.0) -> dict[str | None, float]:
    """Words wanted of each source: shares by weight of ``share`` of all words, at most ``most`` times the source's size.

    Weights go round over sources in code point order, null last. What a source cannot take is shared among the others
    by weight again, until no share is above its bound.
    """
    ordered = sorted(sizes, key=lambda item: (item[0] is None, item[0] or ""))
    weight = [weights[at % len(weights)] for at in range(len(ordered))]
    bound = [most * size for _, size in ordered]
    left, free, out = share * sum(size for _, size in ordered), list(range(len(ordered))), [0.0] * len(ordered)
    while free:
        total = sum(weight[at] for at in free)
        full = [at for at in free if left * weight[at] / total > bound[at]]
        if not full:
            for at in free:
                out[at] = left * weight[at] / total
            break
        for at in full:
            out[at] = bound[at]
        left -= sum(bound[at] for at in full)
        free = [at for at in free if at not in set(full)]
    return {name: value for (name, _), value in zip(ordered, out, strict=True)}


def flight(chance: list[float], size: list[int], seed: str) -> list[float]:
    """Probabilities moved to 0 or 1 with sum(p) and sum(p * size) kept; at most two stay between."""
    draw = random.Random(seed).random
    p, active = list(chance), []
    for unit in range(len(p)):
        if not EPS < p[unit] < 1 - EPS:
            continue
        active.append(unit)
        if len(active) < 3:
            continue
        a, b, c = active
        u, v, w = size[b] - size[c], size[c] - size[a], size[a] - size[b]  # the null space of (1, 1, 1) and the sizes
        if not (u or v or w):
            u, v, w = 1, -1, 0
        up, down = float("inf"), float("inf")
        for at, step in ((a, u), (b, v), (c, w)):
            if step > 0:
                up, down = min(up, (1 - p[at]) / step), min(down, p[at] / step)
            elif step < 0:
                up, down = min(up, -p[at] / step), min(down, (p[at] - 1) / step)
        move = up if draw() * (up + down) < down else -down
        for at, step in ((a, u), (b, v), (c, w)):
            p[at] += move * step
        active = [at for at in active if EPS < p[at] < 1 - EPS]
    return p


def landing(p: list[float], size: list[int]) -> list[int]:
    """0 or 1 for the units left: the outcome nearest in words, then in documents, then the first."""
    left = [at for at, value in enumerate(p) if EPS < value < 1 - EPS]
    words, number = sum(p[at] * size[at] for at in left), sum(p[at] for at in left)
    best = min(
        range(1 << len(left)),
        key=lambda mask: (
            round(abs(sum(size[at] for i, at in enumerate(left) if mask >> i & 1) - words), 6),
            round(abs(mask.bit_count() - number), 6),
            mask,
        ),
    )
    chosen = {at for i, at in enumerate(left) if best >> i & 1}
    return [1 if at in chosen or value >= 1 - EPS else 0 for at, value in enumerate(p)]


def mix(documents: DataFrame, weights=(1.0, 2.0, 3.0), share: float = 1.0, most: float = 3.0, seed: int = 11, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target and copies of every document, with the columns named in ``carry``."""
    spark = documents.sparkSession
    size = word_count(F.col("text")).alias("size")
    sized = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size, *carry)
    if carry:  # what travels with a document is taken to be about as long as its text
        measured = documents.select(F.col("source").cast("string").alias("source"), size, F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    else:
        sized = stored(sized, "sizes")
        measured = sized.withColumn("bytes", F.lit(0))
    totals = measured.groupBy("source").agg(F.sum("size").alias("size"), F.count_if(F.col("size") > 0).alias("n"), F.sum("bytes").alias("bytes"))
    totals = totals.orderBy(F.col("source").asc_nulls_last()).collect()  # one row per source
    wanted = targets([(row["source"], row["size"]) for row in totals], weights, share, most)
    known = []
    for number, row in enumerate(totals):
        ratio = wanted[row["source"]] / row["size"] if row["size"] else 0.0
        whole = int(ratio + EPS)
        chunks = max(1, -(-row["n"] // CHUNK), -(-row["bytes"] // CHUNK_BYTES) if carry else 1)
        known.append((row["source"], number, row["size"], wanted[row["source"]], whole, max(0.0, ratio - whole), chunks))
    sources = spark.createDataFrame(known, "_s string, _no int, source_size long, target double, _whole int, _p double, _chunks int")
    joined = sized.join(sources, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    joined = joined.withColumn("_p", F.when(F.col("size") > 0, F.col("_p")).otherwise(0.0)).withColumn("_done", F.lit(False)).withColumn("_last", F.lit(False))
    schema = joined.schema
    fields = [field.name for field in schema]

    def fly(group: pd.DataFrame) -> pd.DataFrame:
        number, last = int(group["_no"].iloc[0]), bool(group["_chunks"].iloc[0] == 1)
        group = group.iloc[np.lexsort((group["size"].to_numpy(), group["_key"].to_numpy()))]
        sizes = group["size"].tolist()
        p = flight(group["_p"].tolist(), sizes, f"{seed}:{level}:{number}:{int(group["_chunk"].iloc[0])}")
        if last:
            p = [float(x) for x in landing(p, sizes)]
        group = group.assign(_p=p, _done=[not EPS < x < 1 - EPS for x in p], _last=last)
        return group[fields]

    done, level, left = [], 0, joined.filter(f"_p > {EPS}")
    settled = joined.filter(f"_p <= {EPS}")
    while True:
        key = F.xxhash64(F.lit(seed + level), "doc_id", "size")
        dealt = left.withColumn("_key", key).withColumn("_chunk", F.pmod(F.xxhash64(F.lit(level), "_key"), F.col("_chunks")).cast("int"))
        flown = stored(dealt.groupBy("_no", "_chunk").applyInPandas(fly, schema), "flight")
        done.append(flown.filter("_done"))
        rest = flown.filter("not _done")
        n = {row["_no"]: row["n"] for row in rest.groupBy("_no").agg(F.count("*").alias("n")).collect()}  # one row per source at most
        if not n:
            break
        level += 1
        again = spark.createDataFrame([(number, max(1, -(-count // CHUNK))) for number, count in n.items()], "_no int, _chunks int")
        left = rest.drop("_chunks").join(again, "_no").select(*fields)
    out = settled
    for part in done:
        out = out.unionByName(part)
    copies = (F.col("_whole") + F.when(F.col("_p") >= 0.5, 1).otherwise(0)).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), *carry)


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``documents`` as often as it was taken."""
    row = F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("_row")
    given = documents.select(F.col("doc_id").alias("doc_id"), F.col("source").alias("source"), F.col("text").alias("text"), row)
    taken = mix(given, carry=("_row",), **options)
    return taken.filter("copies > 0").select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy")).select("_row.*")
