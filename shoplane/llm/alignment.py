"""Alignment of the tokens of two tokenizers over the same bytes, by pointer jumping.

Tokens are intervals of a text's bytes. Every token points to the farthest-right token that overlaps it: the one of the other
tokenizer that holds its last byte, or itself where both end. Doubling the pointers (a token takes its successor's successor)
brings every token to the last one of its component, so tokens with one terminal are one group; it takes the logarithm of the
longest chain. Texts of a chunk are laid end to end, so one doubling serves them all: where a text ends, both tokenizers do.

Texts are encoded once. A stored table has a row per text with its counts, the hash of its groups and its linked id pairs with
their numbers; corpus-wide pair counts come from it, summed in tasks before the shuffle. Pairs with more than one link in 2^18,
fewer than 2^18 of them, are looked up in a sorted array that every task has; the others, none of them frequent, are joined by pair.

Null and empty texts, and texts whose token bytes differ from a blank and the text for either tokenizer, have no tokens: zeros and
no groups. Null ids stay null, repeated rows are texts of their own and count as such. Texts are encoded in words or pieces cut at
single blanks between words, where neither tokenizer joins tokens; the ids are those of the whole text. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplane.llm.common import stored

#: Bytes of text that are encoded and aligned at a time; a longer text without blanks is one chunk.
CHUNK = 1 << 19
#: Pairs with more than this share of all links are frequent; there are fewer than its inverse.
FREQUENT = 1 / (1 << 18)
#: Distinct pairs a task counts before it hands them on.
HELD = 1 << 21
#: Words a Python worker keeps the ids of, some 220 bytes each; beyond that it starts anew. So many new words go through one call.
CACHE_WORDS, LEARNT = 800_000, 1000
#: Marks the ids of B where they stand beside those of A.
OF_B = np.uint32(1 << 31)
DIGITS = 6
_CUT = re.compile(r"(?<=\S) (?=\S)")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {chr(byte): byte for byte in own}
    letters.update({chr(256 + place): byte for place, byte in enumerate(sorted(set(range(256)).difference(own)))})
    return letters


class Aligner:
    """Both vocabularies, and the alignment of texts under them."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters, vocabulary = _byte_letters(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.a_bytes[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        names = [self.b.id_to_piece(number) for number in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(name[1:-1], 16)]) if self.b.is_byte(number) else name.replace("▁", " ").encode() for number, name in enumerate(names)
        ]
        self.cuttable = not any("▁" in name.lstrip("▁") for name in names)
        self.a_sizes = np.array([len(raw) for raw in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(raw) for raw in self.b_bytes], np.int64)
        self.a_opens = np.array([raw.startswith(b" ") for raw in self.a_bytes])
        self.b_opens = np.array([raw.startswith(b" ") for raw in self.b_bytes])
        self.ids: dict[str, bytes] = {}
        self.odd: set[str] = set()
        self.width = len(names)
        most = max(len(self.a_bytes), len(names))
        self.digits = np.array([list(str(number).rjust(DIGITS, "\0").encode() + b"\0") for number in range(most)], np.uint8)

    def _pieces(self, text: str) -> list[str]:
        """A text cut at single blanks between words into pieces of about CHUNK letters."""
        if len(text) <= CHUNK or not self.cuttable:
            return [text]
        cuts, start = [], 0
        while len(text) - start > CHUNK and (found := _CUT.search(text, start + CHUNK)):
            cuts.append(text[start : found.start()])
            start = found.end()
        return [*cuts, text[start:]]

    def _whole(self, text: str) -> tuple[bytes, bytes]:
        """Ids of blank + text and of the text by either tokenizer; none where their bytes are not those of blank + text."""
        pieces = self._pieces(text)
        a = [found.ids for found in self.a.encode_batch_fast([" " + piece for piece in pieces], add_special_tokens=False)]
        return self._checked(text, [i for ids in a for i in ids], [i for ids in self.b.encode(pieces, num_threads=1) for i in ids])

    def _checked(self, text: str, a: list[int], b: list[int]) -> tuple[bytes, bytes]:
        raw = b" " + text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return b"", b""
        return np.asarray(a, "<u4").tobytes(), (np.asarray(b, "<u4") | OF_B).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Put new words in the cache; those that cannot stand alone (empty, a blank before, not given back) are odd."""
        apart = [word for word in words if word and not word[0].isspace() and "▁" not in word]
        self.odd.update(set(words).difference(apart))
        for start in range(0, len(apart), LEARNT):
            some = apart[start : start + LEARNT]
            line = " ".join(some)
            a, b = self.a.encode(" " + line, add_special_tokens=False).ids, self.b.encode(line)
            a_raw, b_raw = self._checked(line, a, b)
            a_cuts, b_cuts = np.flatnonzero(self.a_opens[a]) * 4, np.flatnonzero(self.b_opens[b]) * 4
            if a_raw and len(a_cuts) == len(b_cuts) == len(some):
                a_cuts, b_cuts = [*a_cuts.tolist(), len(a_raw)], [*b_cuts.tolist(), len(b_raw)]
                starts, stops = zip(a_cuts, b_cuts, strict=True), zip(a_cuts[1:], b_cuts[1:], strict=True)
                for word, (a_start, b_start), (a_stop, b_stop) in zip(some, starts, stops, strict=False):
                    self.ids[word] = a_raw[a_start:a_stop] + b_raw[b_start:b_stop]
                continue
            for word in some:
                a_raw, b_raw = self._whole(word)
                if a_raw:
                    self.ids[word] = a_raw + b_raw
                else:
                    self.odd.add(word)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of blank + text by A and of the text by B, 32 bits each, those of B marked, each in their order.

        There are none where the bytes of either are not those of blank + text.

        Between two words with one blank neither tokenizer joins tokens, so words are encoded once per worker and put together.
        Texts with other blanks around a blank, or with words that are not given back, are encoded whole.
        """
        cut = [text.split(" ") for text in texts]
        every = set().union(*cut)
        new = every.difference(self.ids, self.odd)
        if new:
            if len(self.ids) + len(self.odd) + len(new) > CACHE_WORDS:
                self.ids.clear()
                self.odd.clear()
                new = every
            self._learn(list(new))
        odd = self.odd.intersection(every)
        found = []
        for text, words in zip(texts, cut, strict=True):
            if not text:
                found.append(b"")
            elif not self.cuttable or odd and not odd.isdisjoint(words):
                found.append(b"".join(self._whole(text)))
            else:
                found.append(b"".join(map(self.ids.__getitem__, words)))
        return found

    def align(self, texts: list[str]) -> list[tuple]:
        """n_a, n_b, n_groups, n_links, hash of the groups, linked pairs and their numbers (int64 arrays) of every text."""
        encoded = self.encode(texts)
        both = np.frombuffer(b"".join(encoded), "<u4")
        of_b = both >= OF_B
        stops = np.cumsum([len(ids) // 4 for ids in encoded])
        b_counts = np.diff(np.concatenate([[0], np.cumsum(of_b)])[stops], prepend=0)
        a_counts = np.diff(stops, prepend=0) - b_counts
        a, b = both[~of_b].astype(np.int64), (both[of_b] ^ OF_B).astype(np.int64)
        if not len(a):
            none = np.zeros(0, np.int64)
            return [(0, 0, 0, 0, "", none, none)] * len(texts)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        terminal = terminals(a_ends, b_ends)
        first, group = np.unique(terminal, return_inverse=True)
        a_group, b_group = group[: len(a)], group[len(a) :]

        starts = a_ends - self.a_sizes[a]
        low, high = np.searchsorted(b_ends, starts, "right"), np.searchsorted(b_ends, a_ends, "left")
        n_links = high - low + 1
        link_a = np.repeat(np.arange(len(a)), n_links)
        link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(n_links) - n_links, n_links) + low[link_a]
        pairs = a[link_a] * self.width + b[link_b]

        text_of_a = np.repeat(np.arange(len(texts)), a_counts)
        links_in = np.bincount(text_of_a, n_links, len(texts)).astype(np.int64)
        groups_in = np.bincount(np.repeat(np.arange(len(texts)), b_counts)[first - len(a)], minlength=len(texts))
        listing, ends = self._listing(a, b, a_group, b_group, len(first))
        group_stop = np.cumsum(groups_in)
        found, link = [], 0
        for number in range(len(texts)):
            if not a_counts[number]:
                found.append((0, 0, 0, 0, "", pairs[:0], pairs[:0]))
                continue
            begin = ends[group_stop[number] - groups_in[number] - 1] if group_stop[number] > groups_in[number] else 0
            text = listing[begin : ends[group_stop[number] - 1] - 1]  # without the last separator
            own, times = np.unique(pairs[link : link + links_in[number]], return_counts=True)
            link += links_in[number]
            counts = int(a_counts[number]), int(b_counts[number]), int(groups_in[number]), int(links_in[number])
            found.append((*counts, hashlib.sha256(text).hexdigest(), own, times))
        return found

    def _listing(self, a, b, a_group, b_group, n_groups) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;`` of all groups, and where each ends."""
        in_a, in_b = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)
        a_before, b_before = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        at_a = np.arange(len(a)) + b_before[a_group]
        at_b = np.arange(len(b)) + (a_before + in_a)[b_group]
        ids, marks = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[at_a], ids[at_b] = a, b
        last = np.cumsum(in_a + in_b) - 1
        marks[last] = ord(";")
        marks[last - in_b] = ord("|")
        letters = self.digits[ids]
        letters[:, DIGITS] = marks
        kept = letters != 0
        return letters[kept].tobytes(), np.cumsum(kept.sum(1))[last]


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The terminal token of every token, first those of A and then those of B; tokens are numbered in that order."""
    n_a = len(a_ends)
    over_a, over_b = np.searchsorted(b_ends, a_ends, "left"), np.searchsorted(a_ends, b_ends, "left")
    own = np.arange(n_a, n_a + len(b_ends))
    successor = np.concatenate([over_a + n_a, np.where(a_ends[over_b] > b_ends, over_b, own)])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor
        successor = further


@lru_cache(maxsize=1)
def aligner(byte_level: str, pieces: str) -> Aligner:
    """One per Python worker."""
    return Aligner(byte_level, pieces)


def _packed(pairs: np.ndarray) -> bytes:
    """Ascending pairs as differences, low bytes first, which compresses well."""
    return np.diff(pairs, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(planes).view("<u4").ravel().astype(np.int64))


TEXTS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def aligned_texts(documents: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """A stored row per text: counts, hash of the groups, its linked pairs (A id * size of B + B id) and how often each is linked."""

    def align(batches):
        tool = aligner(byte_level, pieces)
        kinds = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary()]
        names = [part.split()[0] for part in TEXTS.split(", ")]

        def rows(keys, texts):
            found = tool.align(texts)
            columns = [*zip(*keys, strict=True), *list(zip(*found, strict=True))[:5]]
            packed = [[_packed(row[5]) for row in found], [row[6].astype("<u4").tobytes() for row in found]]
            arrays = [pa.array(list(column), kind) for column, kind in zip([*columns, *packed], kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            keys, texts, size = [], [], 0
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = text.as_py() or ""
                if texts and size + len(text) > CHUNK:
                    yield rows(keys, texts)
                    keys, texts, size = [], [], 0
                keys.append((row, doc_id))
                texts.append(text)
                size += len(text)
            if texts:
                yield rows(keys, texts)

    picked = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(picked.mapInArrow(align, TEXTS), "aligned")


def pair_counts(texts: DataFrame, width: int) -> DataFrame:
    """A stored row per id pair: pair, n (its links), best (no pair of the same B id has more)."""

    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            keys, places = np.unique(np.concatenate([pairs for pairs, _ in held]), return_inverse=True)
            return keys, np.bincount(places, np.concatenate([times for _, times in held]), len(keys)).astype(np.int64)

        def rows(keys, sums):
            for start in range(0, len(keys), 1 << 16):
                part = slice(start, start + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(keys[part], pa.int64()), pa.array(sums[part], pa.int64())], names=["pair", "n"])

        for batch in batches:
            for pairs, times in zip(batch.column(0), batch.column(1), strict=True):
                held.append((_unpacked(pairs.as_py()), np.frombuffer(times.as_py(), "<u4")))
                size += len(held[-1][0])
                if size >= 2 * HELD:
                    held = [merged()]
                    size = len(held[0][0])
                    if size >= HELD:
                        yield from rows(*held[0])
                        held, size = [], 0
        if held:
            yield from rows(*merged())

    counted = texts.select("pairs", "times").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counted = stored(counted, "pair-counts")
    b_id = F.col("pair") % width
    most = counted.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("most"))  # one row per id of B at most
    judged = counted.withColumn("b_id", b_id).join(F.broadcast(most), "b_id")
    return stored(judged.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs-judged")


def align(documents: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every text."""
    spark = documents.sparkSession
    texts = aligned_texts(documents, byte_level, pieces)
    import sentencepiece

    counts = pair_counts(texts, sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size())
    least = (counts.agg(F.sum("n")).first()[0] or 0) * FREQUENT
    frequent = counts.filter(F.col("n") > least).toPandas().sort_values("pair")  # fewer than 1 / FREQUENT rows
    table = spark.sparkContext.broadcast((frequent["pair"].to_numpy(np.int64), frequent["n"].to_numpy(np.int64), frequent["best"].to_numpy(bool)))

    def look_up(batches):
        keys, numbers, best = table.value
        names = ["row", "pair", "times", "n_best", "count_sum"]
        for batch in batches:
            sums, rest = [], []
            for row, raw, raw_times in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                pairs, times = _unpacked(raw.as_py()), np.frombuffer(raw_times.as_py(), "<u4").astype(np.int64)
                places = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
                known = keys[places] == pairs if len(keys) else np.zeros(len(pairs), bool)
                at = places[known]
                sums.append((row, int(times[known][best[at]].sum()), int((times[known] * numbers[at]).sum())))
                rest.append((np.full(len(pairs) - len(at), row), pairs[~known], times[~known]))
            none = pa.nulls(len(sums), pa.int64())
            done = [pa.array(list(column), pa.int64()) for column in zip(*sums, strict=True)]
            yield pa.RecordBatch.from_arrays([done[0], none, none, done[1], done[2]], names=names)
            rows, left, times = (np.concatenate(column) for column in zip(*rest, strict=True))
            for start in range(0, len(rows), 1 << 16):
                part = slice(start, start + (1 << 16))
                none = pa.nulls(len(rows[part]), pa.int64())
                yield pa.RecordBatch.from_arrays([*(pa.array(c[part], pa.int64()) for c in (rows, left, times)), none, none], names=names)

    linked = texts.filter("n_links > 0").select("row", "pairs", "times")
    found = stored(linked.mapInArrow(look_up, "row long, pair long, times long, n_best long, count_sum long"), "looked-up")
    rare = found.filter("pair is not null").select("row", "pair", "times").join(counts.filter(F.col("n") <= least), "pair")
    summed = rare.select("row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    summed = summed.unionByName(found.filter("pair is null").select("row", "n_best", "count_sum"))
    summed = summed.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    joined = texts.drop("pairs", "times").join(summed, "row", "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )
