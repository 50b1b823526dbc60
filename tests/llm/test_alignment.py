"""Alignment of two tokenizers against a token-by-token computation."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from corpus_cases import documents, empty, odd, texts  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shoplane.llm import alignment
from shoplane.llm.queries import tokenizer_path

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Tokens of a text by either library as (id, bytes), from the libraries' own output."""
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    letters = alignment._byte_letters()

    def tokens(text):
        found = a.encode(" " + text, add_special_tokens=False)
        left = [(number, bytes(letters[c] for c in token)) for number, token in zip(found.ids, found.tokens, strict=True)]
        right = []
        for number in b.encode(text):
            piece = b.id_to_piece(number)
            right.append((number, bytes([int(piece[3:5], 16)]) if b.is_byte(number) else piece.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        whole = text and b"".join(t for _, t in left) == raw == b"".join(t for _, t in right)
        return (left, right) if whole else ([], [])

    return tokens


def spans(tokens):
    found, end = [], 0
    for number, raw in tokens:
        found.append((number, end, end + len(raw)))
        end += len(raw)
    return found


def brute(tokens, texts):
    """Rows as the operator returns them, without doc_id, for texts that are a whole table."""
    linked, rows = [], []
    for text in texts:
        left, right = map(spans, tokens(text or ""))
        ends = sorted({e for *_, e in left} & {e for *_, e in right})
        links, start = [(a, b) for a, s, e in left for b, u, v in right if s < v and u < e], 0
        groups = []
        for end in ends:
            inside = [",".join(str(n) for n, s, e in side if start <= s and e <= end) for side in (left, right)]
            groups.append("|".join(inside))
            start = end
        listing = ";".join(groups)
        linked.append(links)
        rows.append((len(left), len(right), len(ends), len(links), hashlib.sha256(listing.encode()).hexdigest() if listing else ""))
    counts = Counter(pair for links in linked for pair in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (*row[:4], sum(counts[pair] == most[pair[1]] for pair in links), sum(counts[pair] for pair in links), row[4])
        for row, links in zip(rows, linked, strict=True)
    ]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def by_operator(frame):
    return sorted(tuple(row[name] for name in COLUMNS) for row in alignment.align(frame, *PATHS).collect())


ODD = [
    None, "", " ", "  two  blanks ", "a▁b", "<s>x</s><|endoftext|>", "tab\there\n\nlines \n x", "naïve Öl 日本語 😀 \x00\x1c x",
    "don't stop, 12345 #$%", "word", "word", "word word", " nbsp em \x85next", "éé" * 30, "x" * 300,
]


def test_small_texts_by_brute_force(spark, plain, texts):
    picked = [text for text in texts.values() if len(text) < 1500][:60] + ODD
    frame = spark.createDataFrame([(place, text, "s") for place, text in enumerate(picked)], "doc_id long, text string, row string").repartition(3)
    assert by_operator(frame) == sorted(brute(plain, picked))


@pytest.mark.parametrize("frequent", [1 / 4, 1 / 30, 2.0])
def test_frequent_pairs_and_joined_pairs_give_the_same(spark, plain, texts, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    monkeypatch.setattr(alignment, "HELD", 50)
    picked = [text for text in texts.values() if len(text) < 600][:12]
    frame = spark.createDataFrame([(place, text) for place, text in enumerate(picked)], "doc_id long, text string")
    assert by_operator(frame) == sorted(brute(plain, picked))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.data())
def test_pointers_end_at_common_ends(sizes, data):
    a_ends = np.cumsum(sizes)
    inner = data.draw(st.sets(st.integers(1, int(a_ends[-1]))))
    b_ends = np.array(sorted({*inner, int(a_ends[-1])}))
    found = alignment.terminals(a_ends, b_ends)
    common = np.intersect1d(a_ends, b_ends)
    ends = np.concatenate([a_ends, b_ends])
    assert np.array_equal(np.concatenate([a_ends, b_ends])[found], common[np.searchsorted(common, ends)])


def test_texts_cut_in_words_or_pieces_have_the_ids_of_the_whole(monkeypatch, plain, texts):
    picked = [*texts.values()][:40] + [text for text in ODD if text] + ["a \n b  c   d\t e\r\n " * 30, "x \ny", "x\n y", "x\n \ny", "x ", "a\u2003 b"]
    expected = [tuple([number for number, _ in side] for side in plain(text)) for text in picked]

    def told_apart(raw):
        ids = np.frombuffer(raw, "<u4")
        return ids[ids < alignment.OF_B].tolist(), (ids[ids >= alignment.OF_B] ^ alignment.OF_B).tolist()

    tool = alignment.Aligner(*PATHS)
    assert [told_apart(raw) for raw in tool.encode(picked)] == expected
    for name, value in (("CHUNK", 7), ("LEARNT", 3), ("CACHE_WORDS", 50)):
        monkeypatch.setattr(alignment, name, value)
    tool = alignment.Aligner(*PATHS)
    assert [told_apart(b"".join(tool._whole(text))) for text in picked] == expected
    assert [told_apart(tool.encode([text])[0]) for text in picked] == expected


def test_packing_is_undone():
    for pairs in (np.zeros(0, np.int64), np.array([0, 1, 5, 70_000, 1_608_223_999])):
        assert np.array_equal(alignment._unpacked(alignment._packed(pairs)), pairs)


def test_odd_and_empty_tables(spark, odd, empty):
    found = alignment.align(odd, *PATHS)
    assert found.count() == odd.count() and found.columns == ["doc_id", *COLUMNS]
    assert found.filter("doc_id is null and n_a = 0 and groups_sha256 = ''").count() == 2
    assert alignment.align(empty, *PATHS).count() == 0
