from __future__ import annotations

import corpus_pipeline
import __spark_entry__ as entry_point
from pyspark.sql import functions as F

from shoplane.llm import mixing, packing, quality, queries, secretscan, simhash, tokens

from corpus_cases import MIDDLE, empty, odd  # noqa: F401
from test_scans import plain_quality, plain_spans
from test_simhash import plain_components, plain_fingerprint
from test_tokens_packing import check_packed, ids_of


def test_stages_by_brute_force(spark, tmp_path):
    """Each stage on all its predecessor kept, its result against plain Python."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    kept = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, MIDDLE).write.parquet(str(tmp_path / str(number)))
        kept.append((docs, docs := spark.read.parquet(str(tmp_path / str(number)))))
        if number < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = lambda frame: {r["doc_id"]: r["text"] for r in frame.collect()}
    before, after = map(rows, kept[0])
    verdict = {r["doc_id"]: r["kept"] for r in queries.op9_risk_controlled_quality(spark, MIDDLE).collect()}
    assert after == {d: t for d, t in before.items() if verdict[d]}
    assert all(verdict[d] <= (not plain_quality(t)[-1]) for d, t in before.items())
    before, after = map(rows, kept[1])
    groups = plain_components({d: plain_fingerprint(t) for d, t in before.items()}, 4)
    assert after == {d: before[d] for d in set(groups.values())}
    before, after = map(rows, kept[2])
    assert set(before) == set(after)
    assert all((after[d] == t) or plain_spans(t) for d, t in before.items()) and not any(plain_spans(t) for t in after.values())
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(kept[3][0]).collect()}
    got = kept[3][1].groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in got} == {d: n for d, n in copies.items() if n}
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    given = [(r["doc_id"], ids_of(tokenizer, r["text"], 1)) for r in kept[4][0].collect()]
    check_packed(kept[4][1].collect(), given, 4096)


def test_stages_odd_rows(spark, odd, empty, tmp_path):
    for name, docs in (("odd", odd), ("empty", empty)):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, MIDDLE)
            if number < 4:
                assert out.columns == odd.columns
            out.write.parquet(str(tmp_path / f"{name}{number}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}{number}"))


def test_texts_are_counted_once_a_pass(spark):
    """No condition moves below a join as a second copy of the counts."""
    frame = spark.createDataFrame([(1, "a text of some words", "en")], "doc_id long, text string, lang string")
    rows = quality.measured(frame, F.col("text"), [F.col("doc_id"), F.col("lang").alias("stratum")])
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    once = rows._jdf.queryExecution().optimizedPlan().toString().count("split(")
    chosen = spark.createDataFrame([], quality.cutoffs(quality.holdout_of(rows, labels)).schema)
    for made in (quality.holdout_of(rows, labels), quality.judged(rows, chosen).filter("kept")):
        assert made._jdf.queryExecution().optimizedPlan().toString().count("split(") == once > 0


def test_packing_bounds_its_words(spark, odd):
    docs = spark.createDataFrame([(n, " ".join(f"w{n}x{i}" for i in range(70))) for n in range(20)], "doc_id long, text string")
    few = packing.pieces(docs, queries.tokenizer_path(), cache_words=150)
    assert sorted(few.collect()) == sorted(packing.pieces(docs, queries.tokenizer_path()).collect())
    held = tokens.encoder(queries.tokenizer_path(), 150)
    for row in docs.collect():
        held.encode(row["text"])
        assert len(held.cache) <= 150
    assert tokens.encoder(queries.tokenizer_path()).cache_words == tokens.CACHE_WORDS > corpus_pipeline.CACHE_WORDS


def test_registered():
    names = entry_point.queries()
    assert "pipeline" in names
    for number in range(1, 11):
        assert len([name for name in names if name.startswith(f"op{number}_")]) == 1
    for made in (quality.keep_good, simhash.one_of_each, secretscan.redact, mixing.mixed_documents):
        assert made.__doc__
    assert F is not None
