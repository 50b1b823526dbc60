"""The audit of filters against applying them one after the other."""

from __future__ import annotations

import re
from itertools import permutations

import numpy as np
import pytest
from corpus_cases import MIDDLE, SMALL, documents, empty, no_labels, odd  # noqa: F401

from oracle import compare
from shoplane.llm import filteraudit, queries


def conditions(rows):
    """The set of failing filters of each (doc_id, text, lang) row."""
    found = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = doc_id is not None and any(other is not None and other < doc_id and (body or "") == text for other, body, _ in rows)
        tests = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": copy,
        }
        found.append({name for name, fails in tests.items() if fails})
    return found


def brute(rows, good, toxic):
    """Every result row, by applying the filters in every order."""
    fails, result = conditions(rows), set()
    for part in {lang or "" for *_, lang in rows}:
        mine = [place for place, (*_, lang) in enumerate(rows) if (lang or "") == part]
        shapley, lines = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, name in enumerate(order, 1):
                gone = [place for place in left if name in fails[place]]
                redundant = sum(name in fails[place] for place in mine) - len(gone)
                left = [place for place in left if name not in fails[place]]
                alone = sum(fails[place] == {name} for place in mine)
                lost = [sum(rows[place][0] in marked for place in gone) for marked in (good, toxic)]
                shapley[name] += len(gone)
                lines.append(("".join(order), step, name, len(left), len(gone), redundant, alone, *lost))
        result |= {(part, order, step, *counts, shapley[name]) for order, step, name, *counts in lines}
    return result


def audited(frame, labels):
    rows = filteraudit.audit(frame, labels).collect()
    found = {tuple(row) for row in rows}
    assert len(found) == len(rows)
    return found


def test_odd_rows_by_brute_force(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, 1), (8, 1, None), (None, 1, 1), (6, 0, 0)], "doc_id long, quality int, toxic int")
    extra = odd.selectExpr("doc_id + 10 as doc_id", "text", "lang", "source as first", "1 as mask", "2 as weight", "kept as part", "fp as sha")
    frame = odd.selectExpr("doc_id", "text", "lang", "source as first", "1 as mask", "2 as weight", "kept as part", "fp as sha").unionByName(extra)
    rows = [(row["doc_id"], row["text"], row["lang"]) for row in frame.collect()]
    assert audited(frame, labels) == brute(rows, {1, 8}, {1, 2})


def test_documents_by_brute_force(spark, documents, no_labels):
    rows = [(row["doc_id"], row["text"], row["lang"]) for row in documents.collect()]
    assert audited(documents, no_labels) == brute(rows, set(), set())


def test_an_empty_table_has_no_parts(spark, empty, no_labels):
    assert audited(empty, no_labels) == set()


def test_removal_steps_are_least_positions():
    for mask in range(32):
        for place, order in enumerate(filteraudit.ORDERS):
            failing = [order.index(name) for bit, name in enumerate("ABCDE") if mask >> bit & 1]
            assert filteraudit.REMOVED_AT[mask, place] == min(failing, default=filteraudit.NEVER)


def test_counts_add_up():
    draw = np.random.default_rng(3)
    mask, good, toxic, weight = draw.integers(0, 32, 90), draw.integers(0, 2, 90), draw.integers(0, 2, 90), draw.integers(1, 9, 90)
    found = filteraudit.audit_counts(mask, good, toxic, weight)
    assert (found["kept"][:, -1] == weight[mask == 0].sum()).all()
    assert (found["removed"].sum(1) == weight[mask > 0].sum()).all()
    assert (found["good_lost"].sum(1) == (weight * good)[mask > 0].sum()).all()


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_the_query_equals_its_sql(spark, folder):
    name = "op13_filter_audit"
    assert compare(spark, folder, queries.queries()[name], queries.oracle_sql()[name]) is None
