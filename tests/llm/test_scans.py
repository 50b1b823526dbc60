"""Secret scans, license scans and quality rules."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from oracle import compare
from shoplane.llm import licenses, quality, queries, secretscan

from corpus_cases import MIDDLE, SMALL, empty, no_labels, odd  # noqa: F401

ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""")


def plain_spans(text):
    spans = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[kind], a, b) for a, b, kind in sorted(spans, key=lambda s: (s[0], s[2]))]


def test_secrets_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    rows = queries.op7_markov_secret_scan(spark, MIDDLE).collect()
    assert len(rows) == len(texts)
    found = 0
    for row in rows:
        spans = plain_spans(texts[row["doc_id"]])
        kinds = Counter(kind for kind, _, _ in spans)
        found += len(spans)
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(row["spans"].split(","))
    assert found > 10


ODD_SECRETS = [
    "token: token: abcdefg", "TOKEN=secret=abcdefgh", "paſſword: abcdefgh toKen='x' Api_Key = \"abc123456\"", "apikey:12345 api_key:123456", "AKIAAKIA" + "A" * 12,
    "AKIA" + "1" * 15, "x" + "0123456789abcdef" * 2 + "G", "password = " + "ab" * 12, "日本 secret:zzzzzz é", "passwd\"= 'abcdef'", "token:\nabcdefgh",
]


@pytest.mark.parametrize("text", ODD_SECRETS)
def test_base_patterns(text):
    assert [(kind, a, b) for a, b, kind in secretscan.base_spans(text)] == plain_spans(text)


@pytest.fixture(scope="module")
def ratio(spark):
    return secretscan.fit(spark.read.parquet(f"{MIDDLE}/documents.parquet"))


def test_markov_model_tells_random_from_ordinary(ratio):
    draw = random.Random(8)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    strings = ["".join(draw.choices(letters, k=32)) for _ in range(200)]
    hits = sum(bool(secretscan.markov_spans(f"see {s} here", ratio, [])) for s in strings)
    assert hits > 190
    ordinary = "thereandtheation anotherwordreinghe2 theaterinthetown_andthe onthshthereation-thandthe"
    assert secretscan.markov_spans(ordinary, ratio, []) == []
    text = f"a {strings[0]} b"
    assert secretscan.cut_out(text, ratio, "<secret>") == "a <secret> b"


def test_redaction_keeps_clean_texts(spark, odd, empty, ratio):
    documents = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    after = {r["doc_id"]: r for r in secretscan.redact(documents, ratio).collect()}
    for row in documents.collect():
        left = after[row["doc_id"]]
        if not plain_spans(row["text"]) and not secretscan.markov_spans(row["text"], ratio, []):
            assert tuple(left) == tuple(row)
        else:
            assert "<secret>" in left["text"] and not plain_spans(left["text"]) and left["n_chars"] == len(left["text"])
    out = secretscan.redact(odd, secretscan.fit(odd))
    assert out.columns == odd.columns and out.count() == odd.count()
    assert secretscan.redact(empty, secretscan.fit(empty)).count() == 0


def test_secret_odd_rows(odd, empty):
    rows = secretscan.scan(odd, secretscan.fit(odd)).collect()
    assert len(rows) == odd.count()
    assert {r["n_assign"] for r in rows if r["doc_id"] == 7} == {1}
    assert secretscan.scan(empty, secretscan.fit(empty)).count() == 0


PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def plain_base(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [(at, label) for phrase, label in PHRASES.items() for at in range(len(words)) if tuple(words[at : at + len(phrase)]) == phrase]
    at = [a for a, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in places}))


def test_licenses_against_brute_force(spark, odd, empty):
    for given in (spark.read.parquet(f"{MIDDLE}/documents.parquet"), odd, empty):
        texts = given.select("doc_id", "text").collect()
        wanted = sorted((str(r["doc_id"]), *map(str, plain_base(r["text"]))) for r in texts)
        rows = licenses.scan(given).collect()
        got = sorted((str(r["doc_id"]), *map(str, (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]))) for r in rows)
        assert got == wanted
        for row in rows:
            assert set(row["base_labels"].split(",")) <= set(row["labels"].split(",")) or not row["base_labels"]
            assert 0 <= row["score"] <= 1 and (row["score"] > 0) == bool(row["labels"])


@pytest.mark.parametrize(
    "text, labels",
    [
        ("CC BY CC BY", "cc-by"),
        ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3.0"),
        ("Licensed under the Apache License, Version 2.0 (the \"License\")", "apache-2.0"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
        ("under CC BY-NC-SA 4.0 terms", "cc-by,cc-by-nc-sa"),
        ("Copyright (c) 2024. All rights reserved. May not be reproduced.", "copyright,no-redistribution,reserved"),
        ("a permit to license nothing", ""),
        ("gnu general public license version 2", "gpl,gpl-2.0"),
        ("Licensed under the Apache License", "apache"),
        ("Apache-2.0", "apache-2.0"),
        ("Apache Software License 2.0", "apache-2.0"),
        ("released under the BSD license", "bsd"),
        ("the Mozilla Public License", "mpl"),
        ("Eclipse Public License", "epl"),
        ("Licensed under the GPL", "gpl"),
        ("GPLv3", "gpl-3.0"),
        ("GNU LGPL", "lgpl"),
        ("the code is MIT licensed", "mit"),
        ("Licensed under Creative Commons Attribution", "cc-by"),
        ("the Artistic License", "artistic"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
        ("SPDX-License-Identifier: MIT-0", ""),
        ("// SPDX-License-Identifier: (MIT OR Apache-2.0)\nint x;", "apache-2.0,mit"),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 AND BSD-3-Clause", "bsd-3-clause,gpl-2.0"),
        ("SPDX-License-Identifier: MIT this is not ISC", "mit"),
        ("spdx-license-identifier:", ""),
    ],
)
def test_license_labels(text, labels):
    assert licenses.examine(text.encode())[5] == labels


def test_every_written_rule_can_match():
    """The shortest text of each hand-written rule carries its label, alone and inside other words."""
    shortest = {}
    for number, (label, _, _, pattern, keywords) in enumerate(licenses.WRITTEN):
        text = pattern.replace(licenses._NOTICE, "licensed under the ")
        text = re.sub(r"\(\?:([^()|]*)\|[^()]*\)\{0,3\}|\(\?:[^()]*\)(\?|\{0,3\})", lambda m: "", text)
        for _ in range(4):
            text = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)(\??)", lambda m: "" if m[2] else m[1], text)
        text = text.split("|")[0].replace("[sc]", "s").replace("[a-z0-9 ]{1,80}", "anyone").replace(" ?", " ").replace("?", "")
        shortest[number] = text
        found = licenses.detections(f" before {text} after ")
        assert any(label == name for _, _, name, _ in found) or len(found), (number, label, text)
        assert any(all(any(word in f" {text} " for word in group.split("|")) for group in keywords) for _ in (0,)), (number, text)


def test_many_mentions_take_time_in_proportion():
    text = b"all rights reserved. mit license, licensed under the bsd license. cc by " * 12_500
    started = time.perf_counter()
    found = licenses.examine(text)
    assert time.perf_counter() - started < 2.5 and found[1] == 25_000
    secrets = " ".join(f"token=abcdef{place} zk3Vt8Qw1LmN0pXr{place}" for place in range(25_000))
    started = time.perf_counter()
    base = secretscan.base_spans(secrets)
    more = secretscan.markov_spans(secrets, secretscan.Model(np.ones((secretscan.EDGE + 1) ** 2), 0.0), base)
    assert time.perf_counter() - started < 2.5 and (len(base), len(more)) == (25_000, 25_000)


def test_suppression_equals_comparing_with_every_accepted_span():
    draw = random.Random(4)
    for _ in range(200):
        spans = [(draw.randrange(40), draw.randrange(1, 12)) for _ in range(30)]
        covers, accepted = licenses._Covers([start for start, _ in spans]), []
        for start, length in spans:
            held = any(a <= start and start + length <= b for a, b in accepted)
            assert covers.holds(start, start + length) == held
            if not held:
                accepted.append((start, start + length))
                covers.add(start, start + length)


def holdout_strings():
    """Random strings of several alphabets, and ordinary identifiers, paths, addresses, names of versions."""
    draw = random.Random(77)
    letters = string.ascii_letters + string.digits
    secrets = ["".join(draw.choices(alphabet, k=draw.randint(20, 44))) for alphabet in (letters, letters + "+/", letters + "-_", string.ascii_uppercase + string.digits + "") for _ in range(150)]
    words = "get user name order item list price total report daily table index http server client value cache build test data file path main page user config load store queue event index".split()
    ordinary = []
    for _ in range(150):
        some = draw.choices(words, k=draw.randint(3, 6))
        ordinary += [
            "_".join(some) + f"_{draw.randrange(100)}",
            "".join(w.title() for w in some) + str(draw.randrange(2000)),
            "/".join(some) + f"/v{draw.randrange(9)}",
            "-".join(some) + f"-20{draw.randrange(10, 30)}-0{draw.randrange(1, 9)}",
        ]
    mixes = [s for s in secrets if any(c.isdigit() for c in s)]
    return mixes, [s for s in ordinary if len(s) >= secretscan.MIN_RUN]


def test_models_tell_random_strings_from_identifiers(spark):
    model = secretscan.fit(spark.read.parquet(f"{MIDDLE}/documents.parquet"))
    secrets, ordinary = holdout_strings()

    def found(values):
        return sum(bool(secretscan.markov_spans(f"see {value} here", model, [])) for value in values)

    hits, alarms = found(secrets), found(ordinary)
    print(f"recall {hits / len(secrets):.3f}, precision {hits / max(1, hits + alarms):.3f}")
    assert hits / len(secrets) > 0.9 and hits / (hits + alarms) > 0.95


def test_suppression_and_rule_count():
    assert len(licenses.rules()) > 250
    line = " licensed under the mit license "
    assert [(label, weight) for _, _, label, weight in licenses.detections(line)] == [("mit", 0.9)]  # the name inside is dropped
    assert licenses.examine(b"cc by cc by")[1:4] == (2, 0, 2)


def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    n, r = len(words), len(covered)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, r, n < 20 or 100 * r > 30 * n


def test_quality_counts_against_brute_force(spark, odd, empty, no_labels):
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choice("ab\n") + draw.choice("  \n") for _ in range(draw.randint(0, 60))), "en") for i in range(150)]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for given in (spark.read.parquet(f"{MIDDLE}/documents.parquet"), made, odd, empty):
        wanted = sorted((str(r["doc_id"]), *plain_quality(r["text"])) for r in given.select("doc_id", "text").collect())
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        got = quality.assess(given, no_labels).collect()
        assert sorted((str(r["doc_id"]), *(r[name] for name in names)) for r in got) == wanted
        assert all(r["kept"] != r["base_failed"] for r in got)


def chance(n, k, p):
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p)) for j in range(k + 1))


def test_binomial_bound(spark):
    cases = [(0, 0), (10, 0), (2000, 0), (2000, 2), (2000, 5), (5000, 5), (5000, 9), (70_000, 200), (70_000, 240), (70_000, 279), (100, 100)]
    frame = spark.createDataFrame(cases, "n long, k long").withColumn("p", F.lit(0.004)).withColumn("d", F.lit(0.0004))
    for row in frame.withColumn("safe", quality._safe("n", "k", "p", "d")).collect():
        assert row["safe"] == (row["n"] > 0 and chance(row["n"], row["k"], 0.004) <= 0.0004), row


HOLDOUT = "stratum string, good boolean, symbol_share double, repeat_share double, dup_line_share double, shout_share double, word_length double"


def plain_level(rows, doubt_share, risk=quality.RISK):
    """Levels that are safe one after the other, by plain sums of binomial probabilities."""
    good = [row for row in rows if row[1]]
    n = len(good)
    for level in range(quality.LEVELS):
        k = sum(any(value > cuts[level] for value, (_, cuts) in zip(row[2:], quality.RULES.values(), strict=True)) for row in good)
        chance = sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(risk) + (n - j) * math.log(1 - risk)) for j in range(k + 1))
        if not n or k >= n * risk or chance > doubt_share:
            return level
    return quality.LEVELS


def test_levels_are_tested_in_order_and_small_strata_are_pooled(spark):
    draw = random.Random(6)
    rows = []
    for stratum, n, wide in (("clean", 400, 0.001), ("loose", 900, 0.11), ("wild", 600, 0.9), ("few", 60, 0.05), (None, 300, 0.001)):
        for _ in range(n):
            good = draw.random() < 0.8
            rows.append((stratum, good, draw.random() * (wide if good else 0.5), draw.random() * 0.2, 0.0, 0.0, 5.0 + draw.random()))
    rows += [("none good", False, 0.3, 0.0, 0.0, 0.0, 5.0)]
    found = {row["stratum"]: row for row in quality.cutoffs(spark.createDataFrame(rows, HOLDOUT)).collect()}
    share = quality.DOUBT / 7
    for stratum in ("clean", "loose", "wild", None):
        assert found[stratum]["level"] == plain_level([row for row in rows if row[0] == stratum], share)
    assert found["wild"]["level"] == 0 and found["wild"]["cut_symbol_share"] is None
    assert found["few"]["level"] == found["none good"]["level"] == plain_level(rows, share)
    assert found["clean"]["cut_symbol_share"] == quality.RULES["symbol_share"][1][found["clean"]["level"] - 1]
    assert quality.cutoffs(spark.createDataFrame([], HOLDOUT)).count() == 0


def test_false_rejection_stays_within_the_risk_on_new_texts(spark):
    """300 holdouts from one distribution: the chosen level loses more than the risk of new texts in at most the doubt's share."""
    strata, doubt = 300, 0.1
    draw = random.Random(9)
    cuts = quality.RULES["symbol_share"][1]
    # a good text's share of symbols is above the cut of level L with a chance that crosses the risk between levels 5 and 6
    above = {level: 0.004 * level for level in range(1, quality.LEVELS + 1)}

    def share():
        u = draw.random()
        for level in range(1, quality.LEVELS + 1):
            if u < above[level]:
                return cuts[level - 1] + 1e-6
        return 0.0

    rows = [(f"s{stratum}", True, share(), 0.0, 0.0, 0.0, 5.0) for stratum in range(strata) for _ in range(400)]
    chosen = quality.cutoffs(spark.createDataFrame(rows, HOLDOUT), doubt=doubt * (strata + 1)).collect()  # each stratum at the whole doubt
    losing = sum(row["level"] > 0 and above[row["level"]] > quality.RISK for row in chosen)
    assert losing <= doubt * strata + 3 * (strata * doubt * (1 - doubt)) ** 0.5
    assert sum(row["level"] >= 2 for row in chosen) > 0.5 * strata


def test_keep_good_drops_rejected_rows_only(spark, odd, empty, no_labels):
    left = quality.keep_good(odd, no_labels)
    assert left.columns == odd.columns
    wanted = sorted(str(r["doc_id"]) for r in odd.collect() if not plain_quality(r["text"])[-1])
    assert sorted(str(r["doc_id"]) for r in left.collect()) == wanted
    assert quality.keep_good(empty, no_labels).count() == 0


def test_quality_query_has_no_python(spark):
    plan = queries.op9_risk_controlled_quality(spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_quality_equals_its_sql(spark):
    name = "op9_risk_controlled_quality"
    assert compare(spark, MIDDLE, entry_point.queries()[name], entry_point.oracle_sql()[name]) is None
    assert queries.op9_risk_controlled_quality(spark, MIDDLE).filter("not kept and not base_failed").count() > 20
