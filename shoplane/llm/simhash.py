"""SimHash near-duplicates by anchor points of a covering code.

The 64 bits are cut into three parts (22, 21, 21 bits, padded to 23). The anchors of a part are the 4,096 words of the binary
Golay code of length 23: every word lies within the covering radius 3 of exactly one. Two fingerprints within ``distance``
bits differ in at most ``distance * m // 3`` bits over their ``m`` closest parts, so with

- home: the anchor a fingerprint lies within the radius of, and
- posts: every anchor within radius plus that excess,

a linked pair meets at the home of one of them. All posts of an anchor are compared with its homes, exactly. ``parts_used``
is the number of parts an anchor spans: 1 gives 4,096 anchors per part, 2 gives 16.8 million per pair of parts, 3 gives
69 billion over all bits; more anchors mean more posts per fingerprint and fewer comparisons. Results are the same.

Equal fingerprints are one node. An anchor with many posts is cut into blocks of ``BLOCK`` homes by ``BLOCK`` posts, each its own
task. A comparison returns a spanning forest of its links, never all pairs of a group.

Null texts count as empty and have fingerprint zero. Null ids take part; ``component_id`` is the least id that is not null,
null if there is none. Repeated rows give repeated rows. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplane.llm.common import stored
from shoplane.llm.components import components

#: The generator polynomial of the Golay code, seed of the hash.
GENERATOR = 0b101011100011
SEED = 42
SHIFTS = ((0, 22), (22, 21), (43, 21))
RADIUS = 3
BLOCK = 8192
SLAB = 16
CHUNK = 1 << 16


def fingerprint(text: bytes, size: int) -> int:
    """The SimHash of a text's word shingles; the hashes are counted in chunks, so a long text needs no more memory."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # on bytes: A-Z only, and the white space of the contract
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - size + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    starts = stops - lengths
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        a = starts[at : min(n, at + CHUNK)].tolist()
        b = stops[min(size, len(words)) - 1 + at :][: len(a)].tolist()
        hashes = np.fromiter((xxh64_intdigest(joined[i:j], SEED) for i, j in zip(a, b, strict=True)), np.uint64, len(a))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(texts: Column, size: int) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def compute(batch: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(bytes(text), size) for text in batch], np.uint64).view(np.int64))

    return compute(F.coalesce(texts.cast("string"), F.lit("")).cast("binary"))


@lru_cache(maxsize=4)
def _cosets(excess: int) -> tuple[np.ndarray, ...]:
    """Error patterns of up to RADIUS + excess bits by syndrome: offsets, patterns and their bits beyond the radius."""
    low = np.zeros(1 << 12, np.int64)
    high = np.zeros(1 << 11, np.int64)
    for bit in range(23):
        remainder = 1 << bit
        for top in range(bit, 10, -1):
            if remainder >> top & 1:
                remainder ^= GENERATOR << (top - 11)
        side, place = (low, bit) if bit < 12 else (high, bit - 12)
        side[(np.arange(len(side)) >> place & 1).astype(bool)] ^= remainder
    weights, patterns = [], []
    for weight in range(RADIUS + excess + 1):
        found = np.array([sum(1 << b for b in chosen) for chosen in combinations(range(23), weight)], np.int64)
        patterns.append(found)
        weights.append(np.full(len(found), max(0, weight - RADIUS), np.int8))
    pattern, beyond = np.concatenate(patterns), np.concatenate(weights)
    syndrome = low[pattern & 4095] ^ high[pattern >> 12]
    order = np.argsort(syndrome, kind="stable")
    return low, high, np.searchsorted(syndrome[order], np.arange(2049)), pattern[order], beyond[order]


def posts(values: np.ndarray, distance: int, parts_used: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, is home) for unsigned 64-bit fingerprints."""
    excess = distance * parts_used // 3
    low, high, offsets, pattern, beyond = _cosets(excess)
    rows, anchors, homes = [], [], []
    for number, chosen in enumerate(combinations(range(3), parts_used)):
        row = np.arange(len(values))
        key, used = np.full(len(values), number, np.int64), np.zeros(len(values), np.int64)
        for part in chosen:
            shift, width = SHIFTS[part]
            word = ((values[row] >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
            syndrome = low[word & 4095] ^ high[word >> 12]
            count = offsets[syndrome + 1] - offsets[syndrome]
            of = np.repeat(np.arange(len(row)), count)
            place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(offsets[syndrome], count)
            now = used[of] + beyond[place]
            fits = now <= excess
            of, place, used = of[fits], place[fits], now[fits]
            key = key[of] << 12 | (word[of] ^ pattern[place]) >> 11
            row = row[of]
        rows.append(row)
        anchors.append(key)
        homes.append(used == 0)
    return np.concatenate(rows), np.concatenate(anchors), np.concatenate(homes)


def forest(home: np.ndarray, post: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges that span the links between two sets of distinct fingerprints."""
    nodes, index = np.unique(np.concatenate([home, post]), return_inverse=True)
    at_home, at_post = index[: len(home)], index[len(home) :]
    label, edges = np.arange(len(nodes)), []
    step = max(1, (1 << 21) // max(1, len(post)))
    for first in range(0, len(home), step):
        row, column = np.nonzero(np.bitwise_count(home[first : first + step, None] ^ post[None, :]) <= distance)
        mine, other = at_home[first + row], at_post[column]
        linked = mine != other
        mine, other = mine[linked], other[linked]
        cuts = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1], True]) if len(mine) else []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            found = np.unique(label[np.append(other[a:b], mine[a])])
            if len(found) > 1:
                edges += [(found[0], more) for more in found[1:]]
                label[np.isin(label, found[1:])] = found[0]
    signed = nodes.view(np.int64)
    return [(int(signed[a]), int(signed[b])) for a, b in edges]


def links(prints: DataFrame, distance: int = 4, parts_used: int = 1) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that keep every link's two ends connected."""

    def post(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(values), 4096):
                row, key, home = posts(values[at : at + 4096], distance, parts_used)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(values[at + row].view(np.int64)), pa.array(home)], names=["key", "fp", "home"])

    posted = prints.select("fp").mapInArrow(post, "key long, fp long, home boolean")
    large = posted.groupBy("key").count().filter(F.col("count") > BLOCK)
    large = large.select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("cuts"))
    cut = posted.join(large, "key", "left").withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int"))
    whole = cut.filter("cuts is null").select(
        F.shiftright("key", 4).alias("slab"), F.lit(-1).alias("i"), F.lit(-1).alias("j"), "key", "fp", "home", (~F.col("home")).alias("only_post")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    as_home = cut.filter("cuts is not null and home").select("key", "fp", F.col("mine").alias("i"), every.alias("j"))
    as_post = cut.filter("cuts is not null").select("key", "fp", every.alias("i"), F.col("mine").alias("j"))
    blocks = as_home.select(F.col("key").alias("slab"), "i", "j", "key", "fp", F.lit(True).alias("home"), F.lit(False).alias("only_post")).unionByName(
        as_post.select(F.col("key").alias("slab"), "i", "j", "key", "fp", F.lit(False).alias("home"), F.lit(True).alias("only_post"))
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        edges: list[tuple[int, int]] = []
        block = int(group["i"].iloc[0]) >= 0
        group = group.sort_values(["key", "fp", "home"])
        keys, values, home = group["key"].to_numpy(), group["fp"].to_numpy().view(np.uint64), group["home"].to_numpy()
        starts = np.append(np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), len(keys))
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            mine, at = values[a:b], home[a:b]
            edges += forest(mine[at], mine[~at] if block else mine, distance)
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return whole.unionByName(blocks).groupBy("slab", "i", "j").applyInPandas(compare, "a long, b long")


def parts_for(count: int) -> int:
    """Parts per anchor so that an anchor keeps a few thousand posts at most on even data."""
    return 1 if count <= 10_000_000 else 2 if count <= 10_000_000_000 else 3


def near_duplicates(documents: DataFrame, size: int = 4, distance: int = 4, parts_used: int | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (signed long) and component_id of every row, with the columns named in ``keys``."""
    prints = stored(documents.select(F.col("doc_id").cast("long").alias("doc_id"), *keys, fingerprints(F.col("text"), size).alias("fp")), "prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes, distance, parts_used or parts_for(nodes.count())))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.select("fp", "root").join(named, "root"), "fp")


def one_of_each(documents: DataFrame, size: int = 4, distance: int = 4) -> DataFrame:
    """``documents`` with one row per component left: that with the least id, then the least hash of the whole row."""
    print_of = F.xxhash64(*[F.col(f"`{name}`") for name in documents.columns])
    marked = documents.select(F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("_row"), print_of.alias("_hash"))
    given = marked.select(F.col("_row.doc_id").cast("long").alias("doc_id"), F.col("_row.text").alias("text"), "_hash")
    found = near_duplicates(given, size, distance, keys=("_hash",))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("_hash").alias("hash")))
    kept = found.groupBy("root").agg(best.alias("best")).select(F.col("best.doc_id").alias("_kept"), F.col("best.hash").alias("_kept_hash"))
    same = (F.col("_row.doc_id").cast("long").eqNullSafe(F.col("_kept"))) & (F.col("_hash") == F.col("_kept_hash"))
    left = marked.join(kept, same, "left_semi").withColumn("_id", F.col("_row.doc_id"))
    return left.groupBy("_id", "_hash").agg(F.first("_row").alias("_row")).select("_row.*")
