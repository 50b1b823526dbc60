"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its ``prefix`` nearest pivots. Equal vectors are one candidate, which carries their
``k + 1`` smallest ids (one may be the query's own). Candidates are dealt into blocks by a hash of the vector; a block
posts each of its vectors in the inverted files of its pivots, with the place of the pivot in the vector's order. A query
adds up, over the files of its own pivots, what a shared pivot takes off the footrule distance between the two orders
(a pivot missing from an order stands at place ``prefix``), and the block's best ``share`` of its candidates by footrule, with all
that tie with the last of them, are reranked by exact distance and spread over their ids. The best of all blocks are merged.
Every row is indexed and every query meets every block.

Only the pivots are a sample: ``n_pivots`` distinct vectors, those whose smallest id has the least hash. ``share=1`` reranks every
candidate and is exact. Blocks hold about ``BLOCK`` candidates and queries come in sets of about ``QUERIES``, so a task's memory does
not depend on the table.

Vectors that are null, empty, all zero, or hold null or non-finite components take no part, nor do rows without id or of
another length than most rows (ties: the shorter). A repeated row (same id and vector) counts once; an id with several
vectors has them all as candidates and asks with the least. Equal distances rank by id. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoplane.llm.common import stored

BLOCK = 4096
QUERIES = 2048
FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, as doubles."""
    cast = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return cast.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def _orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first."""
    far = (pivots**2).sum(1)[None, :] - 2 * vectors @ pivots.T
    if prefix >= len(pivots):
        return np.argsort(far, axis=1, kind="stable")
    near = np.argpartition(far, prefix - 1, axis=1)[:, :prefix]
    return np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable"), 1)


def search_block(owners: list, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, pivots: np.ndarray, prefix: int, share: float, k: int):
    """The ``k`` best ids of one block for each query: lists of (query, id, distance). ``owners``: the ids of each vector."""
    prefix = min(prefix, len(pivots))
    places = _orders(vectors, pivots, prefix)
    flat = np.argsort(places.ravel(), kind="stable")
    owner, place = flat // prefix, flat % prefix
    files = np.searchsorted(places.ravel()[flat], np.arange(len(pivots) + 1))
    depth = min(len(vectors), max(256, int(np.ceil(share * len(vectors)))))
    n_ids = np.array([len(ids) for ids in owners])
    first, all_ids = np.cumsum(n_ids) - n_ids, np.concatenate(owners)
    out = []
    for query_id, query, own in zip(query_ids, queries, _orders(queries, pivots, prefix), strict=True):
        closer = np.zeros(len(vectors), np.int64)
        for at, pivot in enumerate(own):
            a, b = files[pivot], files[pivot + 1]
            closer[owner[a:b]] += prefix - np.maximum(place[a:b], at)
        rows = np.flatnonzero(closer >= np.partition(closer, len(vectors) - depth)[len(vectors) - depth])  # ties with the last are in
        score = np.sqrt(((vectors[rows] - query) ** 2).sum(axis=1))
        n = n_ids[rows]
        ids = all_ids[np.repeat(first[rows] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        score = np.repeat(score, n)[ids != query_id]
        ids = ids[ids != query_id]
        best = np.lexsort((ids, score))[:k]
        out += zip([query_id] * len(best), ids[best], score[best], strict=True)
    return out


def nearest(vectors: DataFrame, asks, k: int = 10, n_pivots: int = 256, prefix: int = 64, share: float = 0.15) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for every row where the condition ``asks`` on vec_id holds."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"), F.count_if(asks).alias("asking"))
    most = lengths.orderBy(F.desc("rows"), "n").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("v") == most["n"]).distinct()
    smallest = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.withColumn("_n", smallest).filter(F.col("_n") <= k + 1)  # cut in each task before the shuffle
    vectors = stored(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "distinct-vectors")
    blocks, sets = -(-vectors.count() // BLOCK), max(1, -(-most["asking"] // QUERIES))
    least = F.col("ids")[0]
    chosen = vectors.orderBy(F.xxhash64(least), least, "v").limit(n_pivots).select("v").collect()  # the documented sample
    pivots = spark.sparkContext.broadcast(np.array([row["v"] for row in chosen]))
    block = F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int")
    every_set = F.explode(F.sequence(F.lit(0), F.lit(sets - 1)))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    indexed = vectors.select(block.alias("block"), every_set.alias("set"), F.lit(False).alias("asks"), "ids", "v")
    asking = rows.filter(asks).groupBy("vec_id").agg(F.min("v").alias("v"))
    asking = asking.select(every_block.alias("block"), F.pmod(F.hash("vec_id"), F.lit(sets)).cast("int").alias("set"), F.lit(True).alias("asks"), F.array("vec_id").alias("ids"), "v")

    def search(group: pd.DataFrame) -> pd.DataFrame:
        at = group["asks"].to_numpy()
        if at.all() or not at.any():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        ids, matrix = group["ids"].to_numpy(), np.stack(group["v"].to_numpy())
        found = search_block(list(ids[~at]), matrix[~at], np.concatenate(list(ids[at])), matrix[at], pivots.value, prefix, share, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = indexed.unionByName(asking).groupBy("block", "set").applyInPandas(search, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of ``exact`` (query_id, vec_id) that is in ``found``."""
    both = stored(exact, "exact").select("query_id", "vec_id")
    hit = both.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count()
    return hit / max(1, both.count())
