"""Toxicity, mixing and the language model."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shoplane.llm import mixing, pairmodel, pitmanyor, queries, secretscan, toxicity
from shoplane.llm.common import remainder

from corpus_cases import MIDDLE, SMALL, TESTDATA, empty, no_labels, odd  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_toxicity_on_held_out_texts(spark):
    folder = str(TESTDATA / "sf0.1")
    rows = queries.op4_toxicity(spark, folder)
    assert rows.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    held = rows.filter("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("score", "predicted", "toxic").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in held)
    assert hit / sum(r["toxic"] for r in held) > 0.9
    assert hit / sum(r["predicted"] for r in held) > 0.75  # a few hundred positives; above 0.98 with thousands
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in held)


def test_toxicity_ignores_held_out_labels(spark):
    documents, labels = spark.read.parquet(f"{MIDDLE}/documents.parquet"), spark.read.parquet(f"{MIDDLE}/labels.parquet")
    learns = remainder("doc_id", 4) != 2
    flipped = labels.withColumn("toxic", F.when(learns, F.col("toxic")).otherwise(1 - F.col("toxic")))
    assert toxicity.fit(documents, labels, learns) == toxicity.fit(documents, flipped, learns)
    assert [r["x"] for r in spark.createDataFrame([(5,), (None,)], "doc_id long").select(remainder("doc_id", 4).alias("x")).collect()] == [zlib.crc32(b"5") % 4, 0]


def test_non_negative_risk_separates():
    draw = np.random.default_rng(0)
    positive = (draw.random((300, 6)) < [0.7, 0.6, 0.1, 0.1, 0.1, 0.1]).astype(np.float32)
    negative = (draw.random((900, 6)) < [0.02, 0.02, 0.1, 0.1, 0.1, 0.1]).astype(np.float32)
    weights = toxicity.train(positive, np.concatenate([negative, positive[:100]]), 0.1)
    assert weights[0] > 1 and weights[1] > 1 and np.abs(weights[2:6]).max() < 1


def test_toxicity_odd_rows(spark, odd, empty, no_labels):
    labels = spark.createDataFrame([(8, None, 1), (8, 1, 0), (None, 1, 1), (4, 1, None), (5, 0, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    for given, marks in ((odd, labels), (odd, no_labels), (empty, labels), (empty, no_labels)):
        model = toxicity.fit(given, marks, remainder("doc_id", 4) != 2)
        scores = given.select(toxicity.scores(F.col("text"), model).alias("score")).collect()
        assert len(scores) == given.count() and all(0 <= r["score"] <= 1 for r in scores)


def check_mix(rows, n):
    assert len(rows) == n
    by = defaultdict(list)
    for row in rows:
        by[row["source"]].append(row)
    for own in by.values():
        size, target = sum(r["size"] for r in own), own[0]["target"]
        assert {r["source_size"] for r in own} == {size} and target <= 3 * size + 1e-6
        taken = sum(r["size"] * r["copies"] for r in own)
        largest = max(r["size"] for r in own)
        assert abs(taken - target) <= largest + 1e-6
        assert {r["copies"] for r in own if r["size"]} <= {int(target / size) + i for i in (0, 1)} if size else True
        assert all(r["copies"] <= 3 for r in own)


def test_targets():
    assert mixing.targets([("a", 10), ("b", 10), (None, 10)]) == {"a": 5.0, "b": 10.0, None: 15.0}
    # b is full at 3, and its excess goes to the others by weight
    got = mixing.targets([("a", 99), ("b", 1), ("c", 50)])
    assert got["b"] == 3 and math.isclose(got["a"], 147 / 4) and math.isclose(got["c"], 147 * 3 / 4)
    assert math.isclose(sum(got.values()), 150)
    assert mixing.targets([]) == {} and mixing.targets([("a", 0)]) == {"a": 0.0}


@pytest.mark.parametrize("seed", range(5))
def test_flight_keeps_both_totals(seed):
    draw = np.random.default_rng(seed)
    chance, size = draw.random(200).tolist(), draw.integers(1, 900, 200).tolist()
    after = mixing.flight(chance, size, str(seed))
    assert math.isclose(sum(after), sum(chance), abs_tol=1e-6)
    assert math.isclose(float(np.dot(after, size)), float(np.dot(chance, size)), abs_tol=1e-3)
    assert sum(1e-9 < p < 1 - 1e-9 for p in after) <= 2
    landed = mixing.landing(after, size)
    assert set(landed) <= {0, 1} and abs(np.dot(landed, size) - np.dot(chance, size)) <= max(size)


@pytest.mark.parametrize("chunk", [20, 5000])
def test_mix_near_targets_and_repeatable(spark, monkeypatch, chunk):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    documents = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    hot = documents.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "src0").otherwise(F.col("source")))
    rows = mixing.mix(hot).collect()
    check_mix(rows, 1000)
    for row in mixing.mix(hot.limit(50)).collect():
        text = hot.filter(F.col("doc_id") == row["doc_id"]).first()["text"]
        assert row["size"] == len(WORD.findall(text or ""))
    again = mixing.mix(hot.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_sampling_follows_the_probabilities():
    size = np.random.default_rng(1).integers(5, 90, 40).tolist()
    times = np.zeros(40)
    for seed in range(800):
        times += mixing.landing(mixing.flight([0.3] * 40, size, str(seed)), size)
    assert abs(times / 800 - 0.3).max() < 0.12  # the flight is unbiased, the landing of the last two is not


def test_mix_odd_rows(odd, empty):
    check_mix(mixing.mix(odd).collect(), odd.count())
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.count() > 0
    wanted = sorted(str(r["doc_id"]) for r in mixing.mix(odd).collect() for _ in range(r["copies"]))
    assert sorted(str(r["doc_id"]) for r in mixed.collect()) == wanted
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_base_scores_against_brute_force(spark):
    rows = queries.op10_pitman_yor_scores(spark, SMALL).collect()
    texts = {r["doc_id"]: [*WORD.findall(lower(r["text"])), None] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    counts = Counter()
    for doc_id, words in texts.items():
        if zlib.crc32(str(doc_id).encode()) % 7 != 2:
            counts.update(words)
    n = counts.total()
    assert len(rows) == len(texts)
    for row in rows:
        words = texts[row["doc_id"]]
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 7 == 2)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert math.isclose(row["base_score"], sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in words), rel_tol=1e-9)


@pytest.fixture(scope="module")
def model(spark):
    return pitmanyor.fit(spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id % 7 <> 2"), n_contexts=8)


def test_probabilities_add_up(spark, model):
    """Over all words and the unknown one, after every context and after other words."""
    words = model.words.collect()
    parent = np.sum([w["ps"] for w in words], axis=0) + np.array(model.unknown())
    assert np.allclose(parent, 1)
    for u in range(len(model.contexts)):
        back = np.array([total.back_off()[u] for total in model.samples])
        seen = sum(w["pu"][w["us"].index(u)] for w in words if u in w["us"])
        rest = sum(float(np.mean(back * w["ps"])) for w in words if u not in w["us"]) + float(np.mean(back * model.unknown()))
        assert math.isclose(seen + rest, 1, abs_tol=1e-9)


def test_seating_is_possible(model, spark):
    texts = pitmanyor._texts(spark.read.parquet(f"{SMALL}/documents.parquet"))
    state = pitmanyor.word_counts(texts, model.contexts)
    customers = np.array([1000.0] * len(model.contexts) + [5000.0])
    totals = pitmanyor.Totals(customers, customers / 4, 3000, (0.6, 0.7), (1.0, 1.0))
    for number in range(2):
        state = pitmanyor.sweep(state, totals, 1, number)
    for row in state.collect():
        for t, c in zip(row["t1"], row["cs"], strict=True):
            assert 1 <= t <= c
        assert row["c0_1"] == row["c"] - sum(row["cs"]) + sum(row["t1"]) and 1 <= row["t0_1"] <= row["c0_1"]


def test_scores_by_hand(spark, model, monkeypatch):
    """The same score from the words' table, token by token, with the broadcast cut set high and low."""
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id < 40")
    table = {bytes(w["word"]): w for w in model.words.collect()}
    place = {word: at for at, word in enumerate(model.contexts)}
    for frequent in (1 << 18, 40):
        monkeypatch.setattr(pitmanyor, "FREQUENT", frequent)
        got = {r["doc_id"]: r["score"] for r in pitmanyor.score(documents, model).collect()}
        for row in documents.collect():
            words, total, before = pitmanyor.tokens(row["text"].encode()), 0.0, None
            for word in words:
                u, known = place.get(before, -1), table.get(word)
                ps = known["ps"] if known else model.unknown()
                if u < 0:
                    p = np.mean(ps)
                elif known and u in known["us"]:
                    p = known["pu"][known["us"].index(u)]
                else:
                    p = np.mean([total_.back_off()[u] * x for total_, x in zip(model.samples, ps, strict=True)])
                total, before = total + math.log10(p), word
            assert math.isclose(got[row["doc_id"]], total, rel_tol=1e-9)


def test_held_out_perplexity_is_below_the_base(spark):
    rows = queries.op10_pitman_yor_scores(spark, MIDDLE).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_stirling_ratios():
    ratio = pitmanyor.alone_table(0.5)
    # c=2: S(2,1) = 1 - d, S(2,2) = 1; c=3: S(3,2) = S(2,1) + (2 - 2d) S(2,2)
    assert ratio[2, 1] == 0 and math.isclose(ratio[2, 2], 1) and math.isclose(ratio[3, 2], 0.5 / 1.5)


def test_language_model_odd_rows(odd, empty):
    for train, given in ((odd, odd), (empty, odd), (odd, empty), (empty, empty)):
        rows = pitmanyor.score(given, pitmanyor.fit(train)).collect()
        assert len(rows) == given.count()
        assert all(math.isfinite(r["score"]) and r["n_tokens"] >= 1 for r in rows)


def test_stirling_numbers_beyond_the_table():
    for d, most in ((0.05, 0.01), (0.4, 0.01), (0.75, 0.01), (0.95, 0.3)):
        row = np.full(901, -np.inf)
        row[0] = 0.0
        for c in range(1, 901):
            stay = row + np.log(np.maximum(c - 1 - d * np.arange(901), 1e-300))
            row = np.logaddexp(np.concatenate([[-np.inf], row[:-1]]), stay)
            row[0] = -np.inf
            if c in (129, 400, 900):
                t = np.arange(1, c + 1)
                assert abs(pitmanyor.log_stirling(np.full(c, c), t, d) - row[1 : c + 1]).max() < most


def test_tables_follow_their_conditional():
    """Without a parent's part the draws are those of a Chinese restaurant: the mean number of tables is known, also beyond the table."""
    rng, theta, d = np.random.default_rng(5), 20.0, 0.6
    for c in (2, 7, 100, 1000, 30_000):
        mean = theta / d * (math.exp(sum(math.lgamma(theta + x + c) - math.lgamma(theta + x) for x in (d,)) - math.lgamma(theta + c) + math.lgamma(theta)) - 1)
        n = 4000
        one = np.ones(n)
        got = pitmanyor.draw_tables(np.full(n, c), theta * one, d, rng.random(n), (one, one))
        assert abs(got.mean() - mean) < 5 * got.std() / math.sqrt(n) + 0.005 * mean


def test_totals_settle_over_sweeps(spark):
    """One sweep moves every customer: a dish of 100,000 leaves a start far off at once, and the totals then hold still."""
    rows = [(b"common", 400_000, [0, 1], [100_000, 200_000])] + [(b"w%d" % i, 40, [0, 1], [10, 20]) for i in range(2000)]
    state = spark.createDataFrame(rows, "word binary, c long, us array<int>, cs array<bigint>").coalesce(1)
    totals = pitmanyor.Totals(np.array([120_000.0, 240_000.0, 124_002.0]), np.array([2001.0, 2001.0, 2001.0]), 2001, (0.5, 0.5), (1.0, 1.0))
    tables = []
    for number in range(16):
        state = pitmanyor.sweep(state, totals, 3, number)
        state = pitmanyor.stored(state.drop(*(f"{name}{number - 1}" for name in ("t", "c0_", "t0_") if 1 < number)), "test-seating")
        totals = pitmanyor.summed(state, number, totals)
        tables.append(totals.tables.copy())
    tables = np.array(tables)
    moved = abs(tables[1:] / tables[:-1] - 1).max(axis=1)
    assert moved[-4:].max() < 0.04 < moved[0]
    common = state.filter("c = 400000").first()
    assert abs(np.array(common["t0"]) - common["t15"]).min() > 12  # three moves of four customers each, at most, were made before


@pytest.mark.parametrize("dense, chunk, part", [(1 << 20, 1_000_000, 3_000_000), (300, 2000, 4000), (1, 500, 900)])
def test_every_word_is_a_context(spark, monkeypatch, dense, chunk, part):
    """Probabilities after a rare word and after a common one add up, and scores are those of the tables token by token, whichever
    words are broadcast and however texts are cut and pairs dealt."""
    for name, value in (("DENSE", dense), ("CHUNK", chunk), ("PART", part)):
        monkeypatch.setattr(pairmodel, name, value)
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id < 60")
    train = documents.filter("doc_id % 7 <> 2")
    model = pitmanyor.fit(train)
    number, start = model.numbers.__getitem__, 0
    counts = Counter()
    for row in train.collect():
        words = list(map(number, pitmanyor.tokens((row["text"] or "").encode())))
        counts.update(zip([start, *words], words))
    pairs = {(r["u"], r["w"]): r for r in model.pairs.collect()}
    assert {pair: r["c"] for pair, r in pairs.items()} == counts
    words, contexts = ({r[0]: r for r in frame.collect()} for frame in (model.words, model.contexts))
    assert (min(words) < pairmodel.RARE) == (dense > 1) and (max(words) < pairmodel.RARE) == (dense == 1 << 20)
    assert {w: r["cw"] for w, r in words.items()} == Counter(w for (_, w), n in counts.items() for _ in range(n))
    assert contexts.keys() == {u for u, _ in counts} - {start}
    unknown = np.array(model.unknown())
    assert np.allclose(np.sum([r["ps"] for r in words.values()], axis=0) + unknown, 1)
    for u in sorted(contexts, key=lambda u: contexts[u]["cu"])[:: max(1, len(contexts) // 9)]:
        back = np.array(contexts[u]["back"])
        rest = sum(float(np.mean(back * r["ps"])) for w, r in words.items() if (u, w) not in pairs) + float(np.mean(back * unknown))
        assert math.isclose(sum(r["pu"] for pair, r in pairs.items() if pair[0] == u) + rest, 1, abs_tol=1e-9)
    for frequent in (1 << 18, 40):
        monkeypatch.setattr(pitmanyor, "FREQUENT", frequent)
        got = {r["doc_id"]: r for r in pitmanyor.score(documents, model).collect()}
        for row in documents.collect():
            total, base, known, before = 0.0, 0.0, 0, start
            own = list(map(number, pitmanyor.tokens((row["text"] or "").encode())))
            for word in own:
                ps = np.array(words[word]["ps"]) if word in words else unknown
                back = np.array(contexts[before]["back"]) if before in contexts else np.ones(len(unknown))
                total += math.log10(pairs[before, word]["pu"] if (before, word) in pairs else np.mean(ps * back))
                c = words[word]["cw"] if word in words else 0
                known, base = known + (c > 0), base + math.log10((c + 1) / (model.n_tokens + model.vocabulary + 1))
                before = word
            found = got[row["doc_id"]]
            assert math.isclose(found["score"], total, rel_tol=1e-9) and math.isclose(found["base_score"], base, rel_tol=1e-9)
            assert (found["n_tokens"], found["n_known"]) == (len(own), known)


def test_sweeps_go_by_part_not_by_row(spark, monkeypatch):
    """Seats of a part lie in one block, and so does what is known of its words; nothing the sweeps keep has a row a pair or a word."""
    for name, value in (("DENSE", 300), ("PART", 4000), ("RANGE", 8)):
        monkeypatch.setattr(pairmodel, name, value)
    model = pitmanyor.fit(spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id < 60"))
    ranges = -(-(len(model.numbers) + 1) // 8)
    assert model.parts > 3 and ranges > 1 and model.many.count() > 5 * model.parts
    assert model.seats.count() == model.seats.select("part").distinct().count() == model.parts
    assert model.known.count() <= 4 * model.parts + ranges < model.words.count() / 10
    assert model.words.select("w").distinct().count() == model.words.count() == model.vocabulary
    assert sum(r["c"] for r in model.pairs.select("c").collect()) == model.n_tokens


def test_draws_are_those_of_spark(spark):
    rows = spark.range(0, 1 << 62, 1 << 52).select(F.xxhash64("id").bitwiseAND(F.lit((1 << 62) - 1)).alias("u"), F.col("id").alias("w"))
    rows = rows.withColumn("x", F.pmod(F.xxhash64(F.lit(10), F.lit(3), "u", "w"), F.lit(1 << 52)) / float(1 << 52)).collect()
    u, w = (np.array([r[x] for r in rows], np.int64) for x in ("u", "w"))
    assert pairmodel.draws(10, 3, u, w).tolist() == [r["x"] for r in rows]


def test_word_counts_whenever_they_are_passed_on(spark, monkeypatch):
    """Counts add up however often a task passes on what it has, and empty texts count their end."""
    texts = [None, "", *(" ".join(f"w{(i * j) % 23} Same" for j in range(i % 9)) for i in range(40))]
    frame = spark.createDataFrame([(x,) for x in texts], "text string").coalesce(2)
    want = Counter(word for x in texts for word in pitmanyor.tokens((x or "").encode()))
    for flush, size in ((3, 20), (1 << 20, 1 << 22)):
        monkeypatch.setattr(pitmanyor, "FLUSH", flush)
        monkeypatch.setattr(pairmodel, "SLICE", size)
        assert {bytes(r["word"]): r["cw"] for r in pairmodel.word_counts(pitmanyor._texts(frame)).collect()} == want


def test_model_does_not_depend_on_what_is_broadcast(spark, monkeypatch):
    """Counts, and so the start of all restaurants, are the same; draws go by a word's number, so totals differ by chance only."""
    documents = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    found = []
    for dense in (1 << 20, 200):
        monkeypatch.setattr(pairmodel, "DENSE", dense)
        model = pitmanyor.fit(documents)
        row = model.words.agg(F.sum("cw"), F.count("*")).first()
        found.append((row, model.samples[-1].discounts, [int(model.sweeps[-1].customers[0]), int(model.sweeps[-1].tables[0])]))
    assert found[0][:2] == found[1][:2]
    assert np.allclose(found[0][2], found[1][2], rtol=0.02)


def test_words_of_batches_are_those_of_texts(monkeypatch):
    """White space at ends and in runs, other alphabets and separators that are none, cut into slices and chunks of any size."""
    texts = ["", " ", "One", " a  b\t\n", "naïve ÖL \u00a0x\x1cy\x0bZ", "end ", "same " * 40, "A-Z\x00 q", *(f"w{i} w{i % 7}  " * (i % 5) for i in range(60))]
    raw = [text.encode() for text in texts] + [b"\xff\xfe Bad \xc3"]
    numbers = pairmodel.Numbers({b"same": 1, b"\n": 2, b"w3": 3})
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(raw))), pa.array(raw, pa.binary())], names=["doc_id", "text"])
    want = [list(map(numbers.__getitem__, pitmanyor.tokens(text))) for text in raw]
    for size, most in ((1, 1), (30, 17), (1 << 22, 50), (1 << 22, 10**6)):
        monkeypatch.setattr(pairmodel, "SLICE", size)
        ids, sizes, found = [], [], []
        for some, each, row in pairmodel.chunks([batch.slice(0, 9), batch.slice(9)], numbers, most):
            assert len(row) == sum(each) + len(each) and (len(row) <= most + 1 or len(each) == 1)
            ids, sizes, found = ids + some, sizes + each.tolist(), found + row.tolist()
        assert ids == list(range(len(raw))) and sizes == list(map(len, want)) and found == [n for own in want for n in (0, *own)]


def test_common_words_count_every_run(spark):
    """A word below any share of a flat vocabulary's long run still counts there."""
    flat = " ".join(f"w{i:05d}" for i in range(5000))
    texts = spark.createDataFrame([(f"{flat} both",), ("both some some",)], "text string").repartition(1)
    assert pitmanyor.common_words(pitmanyor._texts(texts), 3) == [b"both", b"some", b"w00000"]
    texts = pitmanyor._texts(spark.createDataFrame([(flat,)] * 2 + [("other",)], "text string").coalesce(1))
    assert pitmanyor.common_words(texts, 2) == [b"w00000", b"w00001"]


def test_samples_are_bounded_whatever_ids_rows_share(spark):
    """A third of all rows without id, a third under one toxic id: the sample keeps its size."""
    text = F.concat(F.lit("text "), F.col("id").cast("string"))
    documents = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, -1).otherwise(F.col("id")).alias("doc_id"), text.alias("text"))
    labels = spark.createDataFrame([(-1, 1), (2, 0)], "doc_id long, toxic int")
    chosen, _ = toxicity.sample(documents, labels, F.lit(True), 400, 900)
    row = chosen.agg(F.count_if("positive"), F.count_if("unlabelled"), F.count_if(F.col("text").substr(6, 9).cast("long") % 3 == 0)).first()
    assert 300 < row[0] < 500 and 750 < row[1] < 1050 and 200 < row[2] < 400
    texts = documents.withColumn("text", F.lit("abcd"))
    drawn = secretscan.with_row_draw(texts, "draw", 5)
    assert 4600 < drawn.filter("doc_id is null and draw < 0.5").count() < 5400


def test_toxicity_does_not_depend_on_file_splits(spark):
    """Scores, and the model behind them, are the same however the files are cut; every score is that of the model by hand."""
    documents, labels = (spark.read.parquet(f"{MIDDLE}/{name}.parquet") for name in ("documents", "labels"))
    found = []
    for size in ("128m", "200k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        model = toxicity.fit(documents, labels, remainder("doc_id", 4) != 2)
        rows = documents.select("doc_id", "text", toxicity.scores(F.col("text"), model).alias("score")).collect()
        found.append((model, {row["doc_id"]: row["score"] for row in rows}))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1]
    (weights, bias), _ = found[0]
    for row in rows:
        logit = bias + sum(weight for word, weight in weights.items() if word in toxicity.words_of(row["text"]))
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, logit)))), rel=1e-9, abs=1e-15)


def test_secret_models_do_not_depend_on_file_splits(spark):
    documents = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    fits = []
    for size in ("128m", "200k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        fits.append(secretscan.fit(documents, max_texts=300))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert np.array_equal(fits[0].ratio, fits[1].ratio) and fits[0].at_least == fits[1].at_least
