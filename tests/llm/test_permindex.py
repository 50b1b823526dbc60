from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from shoplane.llm import permindex

from corpus_cases import TESTDATA  # noqa: F401


def brute(rows, asks, k):
    """rows: [(id, vector)] distinct; every candidate for every asking id."""
    out = []
    for query_id in sorted({i for i, _ in rows if asks(i)}):
        query = min(v for i, v in rows if i == query_id)
        best = sorted((float(np.sqrt(((np.array(v) - np.array(query)) ** 2).sum())), i) for i, v in rows if i != query_id)[:k]
        out += [(query_id, rank, i, round(score, 9)) for rank, (score, i) in enumerate(best, 1)]
    return out


def plain(frame):
    return sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in frame.collect())


def test_recall_and_scores(spark):
    vectors = spark.read.parquet(str(TESTDATA / "sf0.1" / "embeddings.parquet"))
    found = permindex.nearest(vectors, F.col("vec_id") % 100 == 0).cache()
    exact = permindex.nearest(vectors, F.col("vec_id") % 100 == 0, share=1.0)
    assert permindex.recall(found, exact) >= 0.95
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in vectors.collect()]
    assert plain(exact.filter("query_id < 500")) == brute(rows, lambda i: i % 100 == 0 and i < 500, 10)
    real = {i: np.array(v) for i, v in rows}
    for row in found.limit(200).collect():
        assert math.isclose(row["score"], np.sqrt(((real[row["query_id"]] - real[row["vec_id"]]) ** 2).sum()), rel_tol=1e-12)


def test_small_blocks_and_sets(spark, monkeypatch):
    monkeypatch.setattr(permindex, "BLOCK", 30)
    monkeypatch.setattr(permindex, "QUERIES", 5)
    draw = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in draw.normal(size=6)]) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert plain(permindex.nearest(frame, F.col("vec_id") % 20 == 0, k=4, n_pivots=16)) == brute(rows, lambda i: i % 20 == 0, 4)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(i, [float(i % 3), 1.0, float(i % 2)]) for i in range(0, 41)]
    odd = [(100, None), (None, [1.0, 2.0, 3.0]), (200, [0.0, 0.0, 0.0]), (300, [1.0, None, 2.0]), (400, [1.0, inf, 2.0]), (500, [nan, 1.0, 2.0]), (600, []), (700, [1.0, 2.0])]
    rows = good + odd + [good[3], good[20], (20, [9.0, 9.0, 9.0])]
    frame = spark.createDataFrame([(*row, "e", 1) for row in rows], "vec_id long, embedding array<double>, rank string, score int")
    found = permindex.nearest(frame, F.col("vec_id") % 20 == 0, k=7)
    assert plain(found) == brute([*good, (20, [9.0, 9.0, 9.0])], lambda i: i % 20 == 0, 7)
    assert permindex.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = permindex.nearest(spark.createDataFrame(good[:3], "vec_id long, embedding array<double>"), F.col("vec_id") == 0)
    assert [(r["rank"], r["vec_id"]) for r in few.orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_recall_beside_many_copies(spark):
    """A third of all rows are copies of one vector: recall holds for its neighbours, for copies and for the rest."""
    given = spark.read.parquet(str(TESTDATA / "sf0.1" / "embeddings.parquet")).orderBy("vec_id").limit(2000)
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in given.collect()]
    centre = np.array(rows[7][1])
    near = {rows[i][0] for i in np.argsort([((np.array(v) - centre) ** 2).sum() for _, v in rows], kind="stable")[1:101]}
    top = max(i for i, _ in rows)
    frame = spark.createDataFrame(rows + [(top + 1 + n, rows[7][1]) for n in range(1000)], "vec_id long, embedding array<double>").cache()
    others = {i for i, _ in rows if i % 20 == 0} - near
    copies = {top + 1, top + 500}
    for group, least in ((near, 0.9), (others, 0.9), (copies, 1.0)):
        asks = F.col("vec_id").isin(sorted(group))
        found = permindex.nearest(frame, asks).cache()
        exact = permindex.nearest(frame, asks, share=1.0)
        assert found.count() == 10 * len(group)
        assert permindex.recall(found, exact) >= least
