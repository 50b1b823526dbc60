from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from shoplane.llm import packing, queries, rans, tokenfiles
from shoplane.llm.tokens import WordEncoder
from shoplane.session import scratch_path

from corpus_cases import documents, empty, odd, texts  # noqa: F401

PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


ODD_TEXTS = [
    "", " ", "a", "Don't  STOP, it's 2024!!", "x\x1cy !\x1c! a\x85b", "été İstanbul ΣΑΣ ﬁn", "가 한국", "a b　c​d", "<|startoftext|> hi <|endoftext|>x",
    "....,,,, wow?!", "a.b.c, d;e:", "﻿bom ᠎ x", "12345 1a2b", "퟿ \U0001f600\U0001f600", "a\x00b \x07 c", "ab'll I'd we've 'tis",
]


def test_word_encoder_equals_whole_texts(tokenizer, texts):
    encoder = WordEncoder(PATH, cache_words=500)  # small, so that it is emptied many times
    for text in [*ODD_TEXTS, *texts.values()]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:80]
    assert encoder.encode(None) == b""


def best_fit(lengths, capacity):
    """One document at a time."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [at for at, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=lambda at: rooms[at])] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_on_counts_equals_best_fit_on_documents(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 50, 64])
    lengths = [min(capacity, max(1, int(draw.paretovariate(0.8)))) for _ in range(400)]
    counts = defaultdict(int)
    for length in lengths:
        counts[length] += 1
    used, seen = defaultdict(list), defaultdict(set)
    for (length, rank, first, each, offset), upto in zip(steps := packing.plan(counts, capacity), [None] * len(steps), strict=True):
        later = [s[1] for s in steps if s[0] == length and s[1] > rank]
        for r in range(rank, min(later, default=counts[length])):
            assert r not in seen[length]
            seen[length].add(r)
            used[first + (r - rank) // each].append((offset + (r - rank) % each * length, length))
    assert {length: len(ranks) for length, ranks in seen.items()} == counts
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(used) == best_fit(lengths, capacity)


def check_packed(rows, expected, capacity):
    """Rows hold the pieces of ``expected`` [(doc_id, ids)], gapless in their sequences."""
    wanted = []
    for doc_id, ids in expected:
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            wanted.append((str(doc_id), piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(wanted)
    at = defaultdict(list)
    for row in rows:
        at[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at)


@pytest.mark.parametrize("per_bucket", [7, 100_000])
def test_packing_against_brute_force(spark, documents, texts, tokenizer, monkeypatch, per_bucket):
    monkeypatch.setattr(packing, "PER_BUCKET", per_bucket)
    expected = [(doc_id, ids_of(tokenizer, text, 1)) for doc_id, text in texts.items()]
    rows = packing.pack_documents(documents, PATH, 512).collect()
    used = check_packed(rows, expected, 512)
    assert used == best_fit([min(512, len(ids) - at) for _, ids in expected for at in range(0, len(ids), 512)], 512)


def test_packing_odd_rows(odd, empty, tokenizer):
    rows = packing.pack_documents(odd, PATH, 256).collect()
    check_packed(rows, [(row["doc_id"], ids_of(tokenizer, row["text"], 1)) for row in odd.select("doc_id", "text").collect()], 256)
    assert packing.pack_documents(empty, PATH, 256).count() == 0


def test_sequences_hold_the_ids(documents, texts, tokenizer):
    from shoplane.llm.common import stored

    placed = stored(packing.pack(stored(packing.pieces(documents, PATH, 300, 1, with_ids=True), "p"), 300), "q")
    whole = {row["sequence_id"]: row["ids"] for row in packing.sequences(placed).collect()}
    for row in placed.collect():
        own = ids_of(tokenizer, texts[row["doc_id"]], 1)[row["start"] : row["start"] + row["length"]]
        assert whole[row["sequence_id"]][row["offset"] : row["offset"] + row["length"]] == own


@pytest.mark.parametrize("n, top", [(0, 5), (1, 5), (63, 3), (1000, 1), (5000, 49_407), (300_000, 700), (140_000, 49_407)])
def test_shard_round_trip(n, top):
    draw = np.random.default_rng(n)
    ids = np.minimum(draw.zipf(1.2, n) - 1, top) if n else np.zeros(0, np.int64)
    lengths = [n // 3, n - n // 3]
    shard = rans.encode_shard([None, 7], lengths, ids.astype(np.int64), 4, 99)
    part, start, doc_ids, sizes, back = rans.decode_shard(shard)
    assert (part, start, doc_ids, sizes.tolist()) == (4, 99, [None, 7], lengths)
    assert np.array_equal(back, ids)
    broken = bytearray(shard)
    broken[len(broken) // 2] ^= 1
    with pytest.raises(ValueError):
        rans.decode_shard(bytes(broken))


def test_decoding_from_a_checkpoint():
    ids = np.random.default_rng(1).integers(0, 300, 250_000)
    symbols, share = rans.frequencies(ids)
    freq, begin = share.astype(np.uint64), np.concatenate([[0], np.cumsum(share)[:-1]]).astype(np.uint64)
    slots = np.repeat(np.arange(len(symbols)), share)
    body = rans._encode_block(np.searchsorted(symbols, ids), freq, begin)
    assert rans._decode_block(body, freq, begin, slots)[0] == 0
    for point in (1, 2):
        at, rest = rans._decode_block(body, freq, begin, slots, from_checkpoint=point)
        assert at == point * rans.CHECKPOINT * rans.LANES < len(ids)
        assert np.array_equal(symbols[rest], ids[at:])


def check_files(spark, documents, tokenizer, order_exact=True):
    folder = scratch_path(spark, "files")
    tokenfiles.write(documents, PATH, folder, 2)
    rows = tokenfiles.read(spark, folder, with_ids=True).collect()
    given = [(row["doc_id"], ids_of(tokenizer, row["text"], 2)) for row in documents.select("doc_id", "text").collect()]
    assert sorted((str(d), ids) for d, ids in given) == sorted((str(r["doc_id"]), r["ids"]) for r in rows)
    start = 0
    for row in sorted(rows, key=lambda row: row["start"]):
        assert row["start"] == start and row["n_tokens"] == len(row["ids"])
        assert row["ids_crc32"] == zlib.crc32(np.array(row["ids"], "<u4").tobytes())
        start += row["n_tokens"]
    known = [row["doc_id"] for row in sorted(rows, key=lambda row: row["start"])]
    assert known == sorted(known, key=lambda d: (d is not None, d or 0))


@pytest.mark.parametrize("shard_ids", [1000, 1 << 21])
def test_files_against_the_tokenizer(spark, documents, tokenizer, monkeypatch, shard_ids):
    monkeypatch.setattr(tokenfiles, "SHARD_IDS", shard_ids)
    check_files(spark, documents.repartition(5), tokenizer)


def test_files_odd_rows(spark, odd, empty, tokenizer):
    check_files(spark, odd, tokenizer)
    check_files(spark, empty, tokenizer)
