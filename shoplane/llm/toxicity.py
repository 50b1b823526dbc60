"""Toxicity by non-negative positive-unlabelled learning.

Positives are texts that a label confirms as toxic; unlabelled texts are a draw from all training texts, whatever their
label. With class prior p, a logistic classifier g minimises p * E_pos[loss(g)] + max(0, E_unl[loss(-g)] - p * E_pos[loss(-g)]);
when the bracket falls below zero the step goes the other way, so the model cannot explain positives inside the unlabelled
texts away. The prior is the share of toxic rows among the labelled training rows.

Inputs are which of ``n_words`` word features a text has: words, word beginnings of four and six letters ("^" before them), and
beginnings of six letters that two or more of its words share ("^^"), which catch inflected and compound forms. They are chosen by how far their share among positives exceeds that among
unlabelled texts, counted by Spark over the sample. The sample has ``max_positive`` and ``max_unlabelled`` texts in
expectation, by a draw of each row's own, whatever ids it shares; at most ``BOUND`` times their sum, ``n_words`` bits each, reach the driver. ``n_models``
classifiers, each on its own part of the unlabelled texts, are averaged. Scoring reads every whole text.

Null and empty texts get the score of a text without any chosen word. A label that is null counts as absent; of several
labels of an id the largest counts. A null id has no label. Without any confirmed toxic text every score is the prior, or 0.
Repeated rows give repeated rows. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplane.llm.common import stored, unit_hash, with_row_draw

_WORD = re.compile(r"[^\W\d_]+")
SALT = 4101
#: A word feature has to be in this share of the positives at least.
MIN_SHARE = 0.02
BOUND = 2


def words_of(text: str | None) -> set[str]:
    words = set(_WORD.findall(text.lower())) if text else set()
    long = Counter([word[:6] for word in words if len(word) > 6])
    return words.union([f"^{word[:4]}" for word in words if len(word) > 4], [f"^{start}" for start in long], [f"^^{start}" for start, n in long.items() if n > 1])


def sample(documents: DataFrame, labels: DataFrame, learns: Column, max_positive: int, max_unlabelled: int) -> tuple[DataFrame, float]:
    """(draw, text, positive, unlabelled) of the bounded training sample, and the class prior."""
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learns).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_marked, n_toxic = marks.agg(F.count("*"), F.count_if(F.col("toxic") == 1)).first()
    n_rows = documents.filter(learns).count()
    few = marks.filter(F.col("toxic") == 1)
    few = few.filter(unit_hash("doc_id", SALT) < max_positive / max(1, n_toxic)).select(F.col("doc_id").alias("_toxic_id"))
    few = F.broadcast(few)  # at most about max_positive ids
    n_positive = documents.filter(learns).join(few, F.col("doc_id") == F.col("_toxic_id"), "left_semi").count()
    learn = with_row_draw(documents.filter(learns), "draw", SALT + 1)
    unlabelled = F.col("draw") < max_unlabelled / max(1, n_rows)
    positive = F.col("_toxic_id").isNotNull() & (unit_hash("draw", SALT + 2) < max_positive / max(1, n_positive))
    joined = learn.join(few, F.col("doc_id") == F.col("_toxic_id"), "left")
    chosen = joined.select("draw", "text", positive.alias("positive"), unlabelled.alias("unlabelled"))
    return chosen.filter("positive or unlabelled"), n_toxic / n_marked if n_marked else 0.0


def choose_words(chosen: DataFrame, n_words: int) -> list[str]:
    """Words of the sample whose share among positives most exceeds that among unlabelled texts, in standard errors."""

    def count(batches):
        for batch in batches:
            positive, unlabelled = Counter(), Counter()
            for text, is_positive, is_unlabelled in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found = words_of(text)
                if is_positive:
                    positive.update(found)
                if is_unlabelled:
                    unlabelled.update(found)
            words = list(positive | unlabelled)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([positive[w] for w in words], pa.int64()), pa.array([unlabelled[w] for w in words], pa.int64())],
                names=["word", "p", "u"],
            )

    totals = chosen.agg(F.count_if("positive"), F.count_if("unlabelled")).first()
    n_p, n_u = max(1, totals[0]), max(1, totals[1])
    counts = chosen.select("text", "positive", "unlabelled").mapInArrow(count, "word string, p long, u long")
    counts = counts.groupBy("word").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).filter(F.col("p") >= max(3, MIN_SHARE * n_p))
    share_p, share_u = (F.col("p") + 0.5) / (n_p + 1), (F.col("u") + 0.5) / (n_u + 1)
    ratio = (share_p - share_u) / F.sqrt(share_u / n_p + share_u / n_u)
    return [row["word"] for row in counts.withColumn("z", ratio).orderBy(F.desc("z"), "word").limit(n_words).select("word").collect()]


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 200, rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    """Weights (bias last) of one classifier by Adam on the non-negative risk."""
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    n = positive.shape[1]
    weights = np.zeros(n + 1, np.float32)
    weights[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros(n + 1, np.float32), np.zeros(n + 1, np.float32)

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    def gradient(x, pull):
        return np.append(x.T @ pull, pull.sum()) / max(1, len(x))

    for step in range(1, steps + 1):
        g_p, g_u = positive @ weights[:-1] + weights[-1], unlabelled @ weights[:-1] + weights[-1]
        negative = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
        rest = gradient(unlabelled, sigmoid(g_u)) - prior * gradient(positive, sigmoid(g_p))
        if negative >= 0:
            total = prior * gradient(positive, -sigmoid(-g_p)) + rest
        else:
            total = -rest
        total[:-1] += decay * weights[:-1]
        first = 0.9 * first + 0.1 * total
        second = 0.999 * second + 0.001 * total**2
        weights -= rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def fit(documents: DataFrame, labels: DataFrame, learns: Column, max_positive: int = 4000, max_unlabelled: int = 9000, n_words: int = 512, n_models: int = 3):
    """(word -> weight, bias) learnt from the rows where ``learns``, a condition on doc_id, holds."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen, prior = sample(texts, marks, learns, max_positive, max_unlabelled)
    chosen = stored(chosen, "toxic-sample")
    vocabulary = choose_words(chosen, n_words)
    if not vocabulary:
        return {}, float(np.log(prior / (1 - prior))) if 0 < prior < 1 else -40.0

    def mark(batches):
        place = {word: at for at, word in enumerate(vocabulary)}
        for batch in batches:
            texts = batch.column(0).to_pylist()
            bits = np.zeros((len(texts), len(place)), bool)
            for row, text in enumerate(texts):
                for word in words_of(text) & place.keys():
                    bits[row, place[word]] = True
            packed = [bytes(line) for line in np.packbits(bits, axis=1)]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column(1), batch.column(2), batch.column(3)], names=["bits", "positive", "unlabelled", "draw"])

    marked = chosen.select("text", "positive", "unlabelled", "draw").mapInArrow(mark, "bits binary, positive boolean, unlabelled boolean, draw double")
    rows = marked.orderBy("draw", "bits").limit(BOUND * (max_positive + max_unlabelled)).toPandas()
    x = np.unpackbits(np.array([np.frombuffer(b, np.uint8) for b in rows["bits"]]), axis=1, count=len(vocabulary)).astype(np.float32)
    positive, unlabelled = x[rows["positive"].to_numpy()], x[rows["unlabelled"].to_numpy()]
    weights = np.mean([train(positive, part, prior) for part in (unlabelled[i::n_models] for i in range(n_models)) if len(part)] or [np.zeros(len(vocabulary) + 1)], axis=0)
    return dict(zip(vocabulary, weights[:-1].tolist(), strict=True)), float(weights[-1])


def scores(texts: Column, model: tuple[dict[str, float], float]) -> Column:
    """The posterior of being toxic, from a fitted model of at most ``n_words`` words."""
    weights, bias = model

    @F.pandas_udf("double")
    def score(batch: pd.Series) -> pd.Series:
        known = weights.keys()
        sums = np.array([bias + sum(weights[word] for word in sorted(words_of(text) & known)) for text in batch], float)
        return pd.Series(1 / (1 + np.exp(-np.clip(sums, -40, 40))))

    return score(F.coalesce(texts.cast("string"), F.lit("")))
