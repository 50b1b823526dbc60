"""A hierarchical Pitman-Yor language model over words.

Every training word is a context with a restaurant of its own (what follows that word); all share one parent restaurant, which
also serves the first token of a text and every token after an unknown word; the parent's base is uniform over the training
vocabulary and one unknown word. With ``n_contexts`` only the commonest words are contexts (a smaller model, kept per word in
arrays). Otherwise ``pairmodel`` keeps it by pair. A dish is a word, a table of a context is a customer of the parent.

Seating is sampled by Gibbs: a sweep draws the number of tables t of every (restaurant, dish) with c customers anew, all its customers at
once, by inverse transform from S(c, t) * prod over j < t of (strength + discount * (other tables + j)) * (parent's probability of the
dish, which grows with the tables sent there), S being generalised Stirling numbers: exact up to ``TABLE`` customers, beyond
it by a series at few tables and a saddle point at many (within 1 % up to a discount of 0.75; at 0.95, the highest there is, within
30 % where most customers sit alone). What other restaurants hold counts as after the last sweep: all
contexts are drawn side by side, then the parent from its new customers, and the totals are summed anew. Sweeps after
``burn_in`` are samples, and a token's probability is the average of the samples' predictive probabilities. Discounts are n1 / (n1 + 2 n2) of each level's counts; the strengths are parameters.

Everything learnt is a table that grows with the corpus. (context, word) pairs with at least 1 / ``FREQUENT`` of the training
tokens, by that bound at most ``FREQUENT`` (with ``n_contexts`` also such words), are broadcast for scoring; all others are
looked up by key. Tokens are words between the contract's white space, A-Z lowered, and one end per text.

Null texts are empty (one end token). A null id counts as the empty text for the fold. Repeated rows are texts of their own.
An empty table gives no rows; with no training text every token is unknown. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplane.llm.common import stored

END = b"\n"  # never a word
FREQUENT = 1 << 18
FLUSH = 600_000
TABLE = 128  # a power of two
DOUBLINGS = 22
DEEP = 8.0
GRID = 500_000


def tokens(text: bytes | None) -> list[bytes]:
    words = text.lower().split() if text else []  # on bytes: A-Z only, and the contract's white space
    words.append(END)
    return words


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


def common_words(texts: DataFrame, n: int) -> list[bytes]:
    """The commonest words by their counts over all tokens; of equally common ones the first in order."""

    def count(batches):
        def rows():
            return pa.RecordBatch.from_arrays([pa.array(counter.keys(), pa.binary()), pa.array(counter.values(), pa.int64())], names=["word", "n"])

        counter: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counter.update(tokens(text)[:-1])
                if len(counter) > FLUSH:
                    yield rows()
                    counter = Counter()
        yield rows()

    counts = texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(row["word"]) for row in counts.orderBy(F.desc("n"), "word").limit(n).select("word").collect()]


def word_counts(texts: DataFrame, contexts: list[bytes]) -> DataFrame:
    """word, c (all tokens), us and cs (contexts it follows and how often) per distinct word."""

    def count(batches):
        place = {word: at for at, word in enumerate(contexts)}

        def rows():
            words = [*single, *(word for word, _ in pairs)]
            us = [-1] * len(single) + [u for _, u in pairs]
            ns = [*single.values(), *pairs.values()]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(us, pa.int32()), pa.array(ns, pa.int64())], names=["word", "u", "n"])

        single: Counter = Counter()
        pairs: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = tokens(text)
                single.update(words)
                pairs.update([(word, place[u]) for u, word in zip(words, words[1:], strict=False) if u in place])
                if len(single) + len(pairs) > FLUSH:
                    yield rows()
                    single, pairs = Counter(), Counter()
        if single:
            yield rows()

    parts = texts.mapInArrow(count, "word binary, u int, n long").repartition("word")
    entries = parts.groupBy("word", "u").agg(F.sum("n").alias("n"))
    own = F.sort_array(F.collect_list(F.when(F.col("u") >= 0, F.struct("u", "n"))))  # a word has n_contexts entries at most
    grouped = entries.groupBy("word").agg(F.sum(F.when(F.col("u") < 0, F.col("n"))).alias("c"), own.alias("_own"))
    return grouped.select("word", "c", F.transform("_own", lambda x: x["u"]).alias("us"), F.transform("_own", lambda x: x["n"]).alias("cs"))


@lru_cache(maxsize=4)
def log_table(discount: float) -> np.ndarray:
    """log S(c, t) for c and t up to TABLE."""
    log_s = np.full((TABLE + 1, TABLE + 1), -np.inf)
    log_s[0, 0] = 0.0
    for c in range(1, TABLE + 1):
        t = np.arange(1, c + 1)
        stay = log_s[c - 1, 1 : c + 1] + np.log(np.maximum(c - 1 - t * discount, 1e-300))
        log_s[c, 1 : c + 1] = np.logaddexp(log_s[c - 1, :c], stay)
    return log_s


@lru_cache(maxsize=4)
def alone_table(discount: float) -> np.ndarray:
    """S(c-1, t-1) / S(c, t) for c and t up to TABLE."""
    log_s = log_table(discount)
    ratio = np.zeros((TABLE + 1, TABLE + 1))
    for c in range(1, TABLE + 1):
        ratio[c, 1 : c + 1] = np.exp(log_s[c - 1, :c] - log_s[c, 1 : c + 1])
    return ratio


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers, by Stirling's series from 8 up."""
    x = np.asarray(x, float)
    up, low = x.copy(), np.ones_like(x)
    for _ in range(8):
        small = up < 8
        low[small] *= up[small]
        up[small] += 1
    return (up - 0.5) * np.log(up) - up + 0.9189385332046727 + 1 / (12 * up) - 1 / (360 * up**3) + 1 / (1260 * up**5) - np.log(low)


@lru_cache(maxsize=4)
def _saddle(discount: float):
    """S(c, t) is c! / t! times the coefficient of z^c in F^t, F = (1 - (1 - z)^d) / d: by log(c / t - 1), what the saddle point z gives."""
    log_y = -np.geomspace(700, 1e-8, 40_001)  # of 1 - z
    log_z, whole = np.log(-np.expm1(log_y)), -np.expm1(discount * log_y)
    log_r = np.log(discount) + log_z + (discount - 1) * log_y - np.log(whole)  # c / t = z F' / F
    r = np.exp(log_r)
    log_v = log_r + np.log(np.maximum(1 + (1 - discount) * np.exp(log_z - log_y) - r, 1e-300))
    held = r - 1 > 1e-7
    return np.log(r[held] - 1)[::-1], (np.log(whole / discount) - r * log_z)[held][::-1], log_v[held][::-1]


def _by_saddle(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    x, g, log_v = _saddle(discount)
    rest = c - t  # close to t = c the coefficient is that of a Poisson count of rest, where Stirling's form of rest! is off
    at = np.log(np.maximum(rest, 1e-6) / t)
    poisson = log_gamma(rest + 1) - (rest * np.log(np.maximum(rest, 1)) - rest + 0.5 * np.log(2 * np.pi * np.maximum(rest, 1)))
    found = log_gamma(c + 1) - log_gamma(t + 1) + t * np.interp(at, x, g) - 0.5 * (np.log(2 * np.pi * t) + np.interp(at, x, log_v)) - poisson
    return np.where(rest <= 0, 0.0, found)


def _by_series(c: int, t: np.ndarray, discount: float) -> np.ndarray:
    """log S(c, t) by powers of (1 - z)^d, which cancel too much beyond ``_reach``."""
    logs, signs, choose = [], [], np.zeros(len(t))
    for j in range(1, min(int(t.max()) + 1, int(5.5 * DEEP / (1 - discount)) + 20, int(c / discount))):
        left = t - j + 1
        choose = choose + np.log(np.maximum(abs(left), 1e-300)) - math.log(j)
        signs.append(np.where(left <= 0, 0.0, -math.copysign(1, math.sin(math.pi * j * discount)) * (-1) ** j))
        logs.append(choose + math.lgamma(c - j * discount) + math.lgamma(1 + j * discount) + math.log(max(abs(math.sin(math.pi * j * discount)), 1e-300) / math.pi))
    logs, signs = np.array(logs), np.array(signs)
    top = logs.max(axis=0)
    return top + np.log(np.maximum((signs * np.exp(logs - top)).sum(axis=0), 1e-300)) - log_gamma(t + 1) - t * math.log(discount)


def _reach(c, discount: float):
    """Up to so many tables the series holds; from there on the saddle point form does."""
    return np.minimum((DEEP / (1 - discount)) ** (1 - discount) / discount**discount * c**discount, 0.7 * c)


@lru_cache(maxsize=4)
def _lacks(discount: float) -> np.ndarray:
    """What the saddle point form lacks up to ``_reach``, over the logarithms of c and t, by whole t at the start."""
    out = []
    for k in range(DOUBLINGS + 1):
        c = TABLE << k
        t = np.unique(np.rint(np.geomspace(1, _reach(float(c), discount), 200)))
        lack = _by_series(c, t, discount) - _by_saddle(np.full(len(t), c), t, discount)
        out.append(np.interp(np.linspace(0, 1, 400), np.log(t) / np.log(t[-1]), lack))
    return np.array(out)


def log_stirling(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log S(c, t) for c >= TABLE, 1 <= t <= c."""
    c = np.asarray(c, float)
    lacks, reach = _lacks(discount), _reach(c, discount)
    x = np.minimum(np.log2(c / TABLE), DOUBLINGS)
    low = np.minimum(x.astype(np.int64), DOUBLINGS - 1)
    y = np.minimum(np.log(t) / np.log(reach), 1) * (lacks.shape[1] - 1)
    left = np.minimum(y.astype(np.int64), lacks.shape[1] - 2)
    here = [(1 - (y - left)) * lacks[at, left] + (y - left) * lacks[at, left + 1] for at in (low, low + 1)]
    beyond = (reach / np.maximum(t, reach)) ** (1 / (1 - discount))
    return _by_saddle(c, t, discount) + beyond * ((1 - (x - low)) * here[0] + (x - low) * here[1])


def draw_tables(c: np.ndarray, theta: np.ndarray, discount: float, draw: np.ndarray, rise=None) -> np.ndarray:
    """Tables of dishes with ``c`` customers from their full conditional, S(c, t) times, for each table j = 1 to t - 1 after the first,
    (theta + j * discount) * the parent's probability: (a + j) / (b + j) with ``rise`` = (a, b), else b if that is one number."""
    out, c = np.array(c, np.int64), np.asarray(c)
    theta = np.maximum(theta, 1e-9)
    constant = None if isinstance(rise, tuple) else float(rise)
    a, b = (None, None) if constant else rise

    def opened(at, j):
        parent = np.log(constant) if constant else np.log((a[at] + j) / (b[at] + j))
        return np.log(theta[at] + j * discount) + parent

    two = np.flatnonzero(out == 2)
    second = (theta[two] + discount) * (constant or (a[two] + 1) / (b[two] + 1))
    out[two] = 1 + (1 - discount < draw[two] * (1 - discount + second))
    low = 2
    for high in (4, 8, 16, 32, 64, TABLE):
        cells = np.flatnonzero((c > low) & (c <= high))
        low = high
        for part in np.array_split(cells, -(-len(cells) * high // GRID)) if len(cells) else []:
            weight = log_table(discount)[c[part], 1 : high + 1]
            weight[:, 1:] += np.cumsum(opened(part[:, None], np.arange(1, high)[None, :]), axis=1)
            below = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            out[part] = np.minimum(1 + (below < (draw[part] * below[:, -1])[:, None]).sum(axis=1), c[part])
    large = np.flatnonzero(np.asarray(c) > TABLE)
    if not len(large):
        return out

    def log_weight(at, t):
        parent = t * np.log(constant) if constant else log_gamma(a[at] + t) - log_gamma(b[at] + t)
        return log_stirling(c[at], t, discount) + t * np.log(discount) + log_gamma(theta[at] / discount + t) + parent

    def least(low, high, holds):
        """The least number in [low, high] for which it holds; ``high`` counts as one."""
        while (low < high).any():
            middle = (low + high) // 2
            there = holds(middle)
            low, high = np.where((low < high) & ~there, middle + 1, low), np.where((low < high) & there, middle, high)
        return low

    one, every = np.ones(len(large), np.int64), out[large]
    mode = least(one, every, lambda t: log_weight(large, np.minimum(t + 1, every)) <= log_weight(large, t))
    floor = log_weight(large, mode) - 40
    first = least(one, mode, lambda t: log_weight(large, t) >= floor)
    last = least(mode, every, lambda t: log_weight(large, t) < floor)
    for part in np.array_split(np.arange(len(large)), -(-int((last - first + 1).sum()) // GRID)):
        width = last[part] - first[part] + 1
        start = np.cumsum(width) - width
        cell = np.repeat(np.arange(len(part)), width)
        t = first[part][cell] + np.arange(width.sum()) - start[cell]
        weight = np.exp(log_weight(large[part][cell], t) - floor[part][cell] - 40)
        below = np.cumsum(weight)
        before = below[start] - weight[start]
        total = below[start + width - 1] - before
        at = np.searchsorted(below, before + draw[large[part]] * total)
        out[large[part]] = t[np.clip(at, start, start + width - 1)]
    return out


def at_parent_without(c0, t0, t, totals):
    """``rise`` of a context's dish: the parent's customers and tables without the ``t`` customers the context sends."""
    d, s = totals.discounts[0], totals.strengths[0]
    others = np.maximum(c0 - t, 0)
    base = (s + d * totals.tables[-1]) / (totals.vocabulary + 1)
    return others - d * np.clip(t0, 1, np.maximum(others, 1)) + base, s + np.maximum(totals.customers[-1] - t, 0)


class Totals:
    """What restaurants share: customers and tables of each context (last: the parent), vocabulary, discounts, strengths."""

    def __init__(self, customers, tables, vocabulary, discounts, strengths):
        self.customers, self.tables, self.vocabulary = customers, tables, vocabulary
        self.discounts, self.strengths = discounts, strengths

    def parent(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Predictive probability of dishes at the parent."""
        d, s = self.discounts[0], self.strengths[0]
        base = (s + d * self.tables[-1]) / (self.vocabulary + 1)
        return (np.maximum(c - d * t, 0) + base) / (s + self.customers[-1])

    def back_off(self) -> np.ndarray:
        """Share of each context that goes to the parent."""
        d, s = self.discounts[1], self.strengths[1]
        return (s + d * self.tables[:-1]) / (s + self.customers[:-1])


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(offsets)


def sweep(state: DataFrame, totals: Totals, seed: int, number: int) -> DataFrame:
    """One Gibbs sweep over all dishes: adds t{number} (tables per context) and p{number} (customers and tables at the parent)."""
    last = number - 1

    def run(batches):
        rng = np.random.default_rng([seed, number, TaskContext.get().partitionId()])
        d0, d1 = totals.discounts
        s0, s1 = totals.strengths
        for batch in batches:
            c = batch.column("c").to_numpy(zero_copy_only=False).astype(np.int64)
            us, n = _lists(batch.column("us"))
            cs = _lists(batch.column("cs"))[0].astype(np.int64)
            row = np.repeat(np.arange(len(c)), n)
            direct = c - np.bincount(row, cs, len(c)).astype(np.int64)
            if last < 0:  # from one table of each dish everywhere
                t, at_parent, t0 = np.minimum(cs, 1), direct + n, np.ones(len(c), np.int64)
            else:
                t = _lists(batch.column(f"t{last}"))[0].astype(np.int64)
                at_parent, t0 = (batch.column(f"{name}{last}").to_numpy(zero_copy_only=False).astype(np.int64) for name in ("c0_", "t0_"))
            rise = at_parent_without(at_parent[row], t0[row], t, totals)
            t = draw_tables(cs, s1 + d1 * (totals.tables[us] - t), d1, rng.random(len(cs)), rise)
            at_parent = direct + np.bincount(row, t, len(c)).astype(np.int64)
            t0 = draw_tables(at_parent, s0 + d0 * (totals.tables[-1] - t0), d0, rng.random(len(c)), 1 / (totals.vocabulary + 1))
            out = [batch.column(name) for name in batch.schema.names]
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            out += [pa.ListArray.from_arrays(offsets, pa.array(t, pa.int64())), pa.array(at_parent, pa.int64()), pa.array(t0, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, names=[*batch.schema.names, f"t{number}", f"c0_{number}", f"t0_{number}"])

    fields = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in state.schema)
    return state.mapInArrow(run, f"{fields}, t{number} array<bigint>, c0_{number} bigint, t0_{number} bigint")


def summed(state: DataFrame, number: int, before: Totals) -> Totals:
    """The totals after a sweep; at most one row per context reaches the driver."""
    each = state.select(F.explode(F.arrays_zip("us", f"t{number}")).alias("x")).groupBy(F.col("x.us").alias("u"))
    tables = np.zeros(len(before.tables))
    for row in each.agg(F.sum(f"x.t{number}").alias("t")).collect():
        tables[row["u"]] = row["t"]
    customers = before.customers.copy()
    row = state.agg(F.sum(f"c0_{number}").alias("c"), F.sum(f"t0_{number}").alias("t")).first()
    customers[-1], tables[-1] = row["c"] or 0, row["t"] or 0
    return Totals(customers, tables, before.vocabulary, before.discounts, before.strengths)


class Model:
    """A fitted model: a table of words, and what all words share."""

    def __init__(self, words: DataFrame, contexts: list[bytes], samples: list[Totals], n_tokens: int, vocabulary: int):
        self.words, self.contexts, self.samples = words, contexts, samples
        self.n_tokens, self.vocabulary = n_tokens, vocabulary

    def unknown(self) -> list[float]:
        return [float(total.parent(np.zeros(1), np.zeros(1))[0]) if total.customers[-1] or total.vocabulary else 1.0 for total in self.samples]


def discount(n1: int, n2: int) -> float:
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5


def fit(documents: DataFrame, n_contexts: int | None = None, sweeps: int = 4, burn_in: int = 2, strengths=(1.0, 1.0), seed: int = 10):
    """Learn from whole texts of ``documents``; ``sweeps - burn_in`` samples are kept."""
    if n_contexts is None:
        from shoplane.llm import pairmodel

        return pairmodel.fit(documents, sweeps, burn_in, strengths, seed)
    texts = _texts(documents)
    contexts = common_words(texts, n_contexts)
    state = stored(word_counts(texts, contexts), "lm-counts")
    one = state.agg(
        F.count("*").alias("v"),
        F.sum("c").alias("n"),
        F.count_if(F.col("c") == 1).alias("n1"),
        F.count_if(F.col("c") == 2).alias("n2"),
        F.sum(F.size(F.filter("cs", lambda x: x == 1))).alias("m1"),
        F.sum(F.size(F.filter("cs", lambda x: x == 2))).alias("m2"),
    ).first()
    customers, tables = np.zeros(len(contexts) + 1), np.zeros(len(contexts) + 1)
    each = state.select(F.explode(F.arrays_zip("us", "cs")).alias("x")).groupBy(F.col("x.us").alias("u"))
    for row in each.agg(F.sum("x.cs").alias("c"), F.count("*").alias("t")).collect():  # one row per context
        customers[row["u"]], tables[row["u"]] = row["c"], row["t"]
    vocabulary, n_tokens = one["v"], one["n"] or 0
    customers[-1], tables[-1] = n_tokens - customers[:-1].sum() + tables[:-1].sum(), vocabulary
    totals = Totals(customers, tables, vocabulary, (discount(one["n1"], one["n2"]), discount(one["m1"] or 0, one["m2"] or 0)), strengths)
    samples = []
    for number in range(sweeps):
        state = stored(sweep(state, totals, seed, number), "lm-seating")
        totals = summed(state, number, totals)
        samples.append(totals)
    kept = list(range(burn_in, sweeps))
    return Model(stored(predictive(state, [(at, samples[at]) for at in kept]), "lm-words"), contexts, [samples[at] for at in kept], n_tokens, vocabulary)


def predictive(state: DataFrame, samples: list[tuple[int, Totals]]) -> DataFrame:
    """word, c, ps (parent probability per sample), us, cs, pu (probability after each context, averaged over samples)."""

    def run(batches):
        for batch in batches:
            us, n = _lists(batch.column("us"))
            cs = _lists(batch.column("cs"))[0].astype(np.float64)
            row = np.repeat(np.arange(batch.num_rows), n)
            ps, pu = [], np.zeros(len(us))
            for number, totals in samples:
                t = _lists(batch.column(f"t{number}"))[0]
                c0, t0 = (batch.column(f"{name}{number}").to_numpy(zero_copy_only=False) for name in ("c0_", "t0_"))
                p = totals.parent(c0, t0)
                ps.append(p)
                own = np.maximum(cs - totals.discounts[1] * t, 0) / (totals.strengths[1] + totals.customers[us])
                pu += (own + totals.back_off()[us] * p[row]) / len(samples)
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            flat = np.stack(ps, axis=1).ravel() if ps else np.zeros(0)
            every = pa.array(np.arange(batch.num_rows + 1) * len(samples), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.ListArray.from_arrays(every, pa.array(flat)), batch.column("us"), batch.column("cs"), pa.ListArray.from_arrays(offsets, pa.array(pu))],
                names=["word", "c", "ps", "us", "cs", "pu"],
            )

    return state.mapInArrow(run, "word binary, c long, ps array<double>, us array<int>, cs array<bigint>, pu array<double>")


def score(documents: DataFrame, model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10) of every document."""
    if not isinstance(model, Model):
        from shoplane.llm import pairmodel

        return pairmodel.score(documents, model)
    spark = documents.sparkSession
    total, least = model.n_tokens, max(1, -(-model.n_tokens // FREQUENT))
    divisor = math.log10(total + model.vocabulary + 1)
    often, after = {}, {}
    pairs = F.filter(F.arrays_zip("us", "cs", "pu"), lambda x: x["cs"] >= least)
    for row in model.words.filter(F.col("c") >= least).select("word", "c", "ps", pairs.alias("pairs")).toLocalIterator():  # bounded by FREQUENT
        word = bytes(row["word"])
        often[word] = (math.log10(row["c"] + 1) - divisor, math.log10(sum(row["ps"]) / len(row["ps"])))
        for pair in row["pairs"]:
            after[word, pair["us"]] = math.log10(pair["pu"])
    shared = spark.sparkContext.broadcast((often, after, {word: at for at, word in enumerate(model.contexts)}))
    fields = "uid long, doc_id long, n_tokens long, n_known long, base double, part double, word binary, u int, n long, n_base long"
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int32(), pa.int64(), pa.int64()]
    names = [field.split()[0] for field in fields.split(", ")]

    def look(batches):
        often, after, place = shared.value
        uid = TaskContext.get().partitionId() << 40
        columns: list[list] = [[] for _ in names]

        def put(*row):
            for column, value in zip(columns, row, strict=True):
                column.append(value)

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
            for column in columns:
                column.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = tokens(text)
                single = Counter(words)
                own = Counter([(word, place[u]) for u, word in zip(words, words[1:], strict=False) if u in place])
                known, base, part = 0, 0.0, 0.0
                missing = []
                for word, n in single.items():
                    if word in often:
                        known += n
                        base += n * often[word][0]
                    else:
                        missing.append(word)
                for key, n in own.items():
                    word = key[0]
                    single[word] -= n
                    if key in after:
                        part += n * after[key]
                    else:
                        put(uid, None, 0, 0, 0.0, 0.0, word, key[1], n, 0 if word in often else n)
                for word, n in single.items():
                    if n and word in often:
                        part += n * often[word][1]
                for word in missing:
                    if n := single[word]:
                        put(uid, None, 0, 0, 0.0, 0.0, word, -1, n, n)
                put(uid, doc_id, len(words), known, base, part, b"\n%d" % uid, -1, 0, 0)  # a key of its own, met by no word
                uid += 1
                if len(columns[0]) > 100_000:
                    yield flush()
        if columns[0]:
            yield flush()

    given = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    rows = given.mapInArrow(look, fields)
    looked = rows.join(model.words.select(F.col("word").alias("_w"), "c", "ps", "us", "pu"), F.col("word") == F.col("_w"), "left")
    unknown = F.array(*[F.lit(p) for p in model.unknown()])
    ps = F.coalesce("ps", unknown)
    plain = F.aggregate(ps, F.lit(0.0), lambda a, x: a + x) / len(model.samples)
    back = [[float(x) for x in totals.back_off()] for totals in model.samples]
    mixed = sum((F.element_at(F.lit(shares or [0.0]), F.col("u") + 1) * ps[at] for at, shares in enumerate(back)), F.lit(0.0)) / len(model.samples)
    found = F.array_position("us", F.col("u"))
    p = F.when(F.col("u") < 0, plain).when(found > 0, F.get("pu", (found - 1).cast("int"))).otherwise(mixed)
    c = F.coalesce("c", F.lit(0))
    return (
        looked.select(
            "uid",
            "doc_id",
            "n_tokens",
            (F.col("n_known") + F.when(c > 0, F.col("n_base")).otherwise(0)).alias("n_known"),
            (F.col("base") + F.when(F.col("n_base") > 0, F.col("n_base") * (F.log10(c + 1) - divisor)).otherwise(0.0)).alias("base"),
            (F.col("part") + F.when(F.col("n") > 0, F.col("n") * F.log10(p)).otherwise(0.0)).alias("part"),
        )
        .groupBy("uid")
        .agg(F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("part").alias("score"))
        .drop("uid")
    )


def perplexity(scored: DataFrame) -> float:
    """10 to the mean negative log10 probability of a token."""
    row = scored.agg(F.sum("score").alias("s"), F.sum("n_tokens").alias("n")).first()
    return 10 ** (-row["s"] / row["n"]) if row["n"] else float("nan")
