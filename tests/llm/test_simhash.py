from __future__ import annotations

import random

import numpy as np
import pytest
import re
from xxhash import xxh64_intdigest

from shoplane.llm import queries, simhash
from shoplane.llm.components import components

from corpus_cases import MIDDLE, empty, odd  # noqa: F401


def plain_fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance):
    """Least id per group, by comparing all pairs."""
    ids = list(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for at, a in enumerate(ids):
        for b in ids[:at]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in ids}


def test_query_against_brute_force(spark):
    rows = queries.op2_simhash_near_dedup(spark, MIDDLE).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == plain_components(prints, 4)


@pytest.mark.parametrize("parts_used, block", [(1, 8192), (1, 16), (2, 64), (3, 8192)])
def test_links_find_every_pair(spark, monkeypatch, parts_used, block):
    """Clusters of fingerprints up to five bits from a centre: no link may be lost, whatever the anchors and cuts."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    draw = random.Random(parts_used)
    prints = set()
    for _ in range(12 if parts_used < 3 else 5):
        centre = draw.getrandbits(64)
        for _ in range(12):
            prints.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))))
    prints |= {0, 1, (1 << 64) - 1, (1 << 64) - 8}
    values = sorted(prints)
    frame = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    edges = [(np.int64(r["a"]).view(np.uint64), np.int64(r["b"]).view(np.uint64)) for r in simhash.links(frame, 4, parts_used).collect()]
    for a, b in edges:
        assert int(a ^ b).bit_count() <= 4 * len(values)
    expected = plain_components({v: v for v in values}, 4)
    root = {v: v for v in values}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        low, high = sorted((find(int(a)), find(int(b))))
        root[high] = low
    assert {v: find(v) for v in values} == expected


def test_anchors_cover(spark):
    """Each fingerprint has one home per part, and pairs at four bits share an anchor with a home."""
    draw = np.random.default_rng(5)
    values = draw.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2)
    near = values.copy()
    for at in range(len(near)):
        for bit in draw.choice(64, 4, replace=False):
            near[at] ^= np.uint64(1) << np.uint64(bit)
    row, key, home = simhash.posts(values, 4, 1)
    assert (np.bincount(row[home], minlength=200) == 3).all()
    other, other_key, _ = simhash.posts(near, 4, 1)
    homes = {(r, k) for r, k in zip(row[home].tolist(), key[home].tolist(), strict=True)}
    met = {r for r, k in zip(other.tolist(), other_key.tolist(), strict=True) if (r, k) in homes}
    assert met == set(range(200))


def test_components_of_random_graphs(spark):
    draw = random.Random(3)
    edges = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, 5000 + i) for i in range(50)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    assert found == {i: find(i) for i in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {}
    for row in rows:
        by_id.setdefault(row["doc_id"], set()).add((row["fp"], row["component_id"]))
    assert by_id[1] == by_id[2] == by_id[3] == {(0, 1)}  # empty texts have fingerprint zero and are linked
    assert (0, 1) in by_id[None]  # so has the null text without an id
    assert {c for _, c in by_id[8]} == {8}
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each(odd, empty):
    left = simhash.one_of_each(odd)
    assert left.columns == odd.columns
    ids = [row["doc_id"] for row in left.collect()]
    assert sorted(ids, key=str) == sorted([1, 4, 5, 6, 7, 8, None], key=str)  # None: the text that only a row without id has
    assert simhash.one_of_each(empty).count() == 0
