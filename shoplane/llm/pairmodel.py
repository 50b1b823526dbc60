"""The Pitman-Yor model of ``pitmanyor`` with every training word as a context.

Words go by numbers: those with at least 1 / ``DENSE`` of the training tokens, by that bound at most ``DENSE``, from 1 up
by count, and what is known of them is broadcast as arrays; any other word by 62 bits of its XXH64, so equal hashes count as equal words.
What is known of the others travels by their numbers, with the pairs.

Pairs of words travel and lie in blocks (``blocks``): a task cuts its texts into chunks of ``CHUNK`` tokens, counts each chunk's
pairs and deals them into parts of about ``PART`` tokens, by the pair where both words are dense, else by a word that is not, which
by the cut is never a hot one. Pairs with at least 1 / ``FREQUENT`` of the tokens are looked up in a broadcast array, so a pair of
a part is no hot key either. A part sends each chunk one block of sums by text.

Pairs that occur once have one table always, as have words with one customer and contexts without a repeated pair: sweeps run
over the others only (``SEATS``), a part's in one block. A sweep has two steps. A part draws the tables of its seats, with its words that
are not dense, and tells what it sends to dense words and to contexts: to a range, dense numbers dealt into groups of about ``RANGE``, or
to the part of a context that is not dense. There they are summed, and parts are told the tables of the contexts that are not dense.
A table is deleted once the next sweep's is written. All sizes only cut the work; none drops anything.
"""

from __future__ import annotations

import math
from itertools import pairwise, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplane.llm import pitmanyor
from shoplane.llm.blocks import pack, runs, unpack, unpack_all
from shoplane.llm.common import stored
from shoplane.llm.pitmanyor import END, Totals, at_parent_without, discount, draw_tables
from shoplane.session import scratch_path

DENSE = 1 << 21
CHUNK = 1_000_000
PART = 3_000_000
SLICE = 1 << 22
RANGE = 1 << 15
RARE = 1 << 62  # numbers from here on are hashes
PRIMES = np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)  # of XXH64
BLOCKS = "part int, chunk long, kind int, block binary"
#: Kinds of blocks: texts, pairs to score, pairs learnt, their seats, words and contexts that are not dense, sums, sums without their context.
TEXTS, ASKED, PAIRS, SEATS, WORDS, CONTEXTS, SUMS, HALVES = range(8)
#: Of the sweeps: dense words, words and contexts that no sweep changes, what parts tell, what they are told, totals.
SHARED, ALONE, STILL, SENT, REPLY, TOTALS = range(8, 14)


class Numbers(dict):
    """The number of any word; 0 is what the first word of a text follows."""

    def __missing__(self, word: bytes) -> int:
        return RARE | xxhash.xxh64_intdigest(word) >> 2

    def of(self, words: np.ndarray) -> np.ndarray:
        found = np.fromiter(map(self.get, words, repeat(-1)), np.int64, len(words))
        rare = np.flatnonzero(found < 0)
        found[rare] = RARE | (np.fromiter(map(xxhash.xxh64_intdigest, words[rare]), np.uint64, len(rare)) >> np.uint64(2)).astype(np.int64)
        return found


def coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of binary ``texts`` as ``tokens`` has them, without the end: distinct words, each token's place among them, tokens of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words, sizes = split.flatten(), pc.list_value_length(split).to_numpy()
    full = pc.binary_length(words).to_numpy() > 0  # white space at an end of a text leaves an empty word there
    if not full.all():
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[full], minlength=len(sizes))
        words = words.filter(pa.array(full))
    found = words.dictionary_encode()
    return found.dictionary.view(pa.binary()), found.indices.to_numpy(), sizes


def slices(batch: pa.RecordBatch):
    """Parts of a batch of about ``SLICE`` bytes of text."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64))
    cuts = np.flatnonzero(np.diff(ends // SLICE, prepend=0)) + 1
    for start, stop in pairwise(np.unique(np.concatenate([[0], cuts, [batch.num_rows]])).tolist()):
        yield batch.slice(start, stop - start)


def chunks(batches, numbers: Numbers, most: int):
    """(ids, tokens of each text, numbers of all words with 0 before each text); a text alone may be longer than a chunk."""
    ids, sizes, found, n = [], [], [], 0

    def chunk():
        return ids, np.concatenate(sizes), np.concatenate(found)

    for part in (part for batch in batches for part in slices(batch)):
        words, codes, each = coded(part.column("text"))
        given = part.column("doc_id").to_pylist() if "doc_id" in part.schema.names else [None] * part.num_rows
        each = each.astype(np.int64) + 1  # with the end
        starts = np.concatenate([[0], np.cumsum(each + 1)])  # with the 0 before each text
        row, word = np.empty(starts[-1], np.int64), np.ones(starts[-1], bool)
        row[starts[:-1]], row[starts[1:] - 1] = 0, numbers[END]
        word[starts[:-1]] = word[starts[1:] - 1] = False
        row[word] = numbers.of(words.to_numpy(zero_copy_only=False))[codes]
        at = 0
        while at < len(each):
            stop = int(np.searchsorted(starts[1:] - 1, most - n + starts[at], "right"))
            stop = max(stop, at if n else at + 1)
            ids += given[at:stop]
            sizes.append(each[at:stop])
            found.append(row[starts[at] : starts[stop]])
            n += int(starts[stop] - starts[at])
            at = stop
            if at < len(each):
                yield chunk()
                ids, sizes, found, n = [], [], [], 0
    if ids:
        yield chunk()
    pa.default_memory_pool().release_unused()  # else a worker holds it on into other stages


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the place of each value among them."""
    place, found = pd.factorize(values)
    order = np.argsort(found)
    rank = np.empty(len(found), np.int64)
    rank[order] = np.arange(len(found))
    return found[order], rank[place]


def _places(u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct u and w in order, and a key of each pair in the order of (u, w); a part's pairs are many, so few copies are held."""
    ws, place = _distinct(w)
    us, key = _distinct(u)
    key *= max(1, len(ws))
    key += place
    return us, ws, key


def counted(numbers: np.ndarray, text: np.ndarray | None = None):
    """u, w, text and count of the distinct pairs of a chunk, in order of (u, w)."""
    distinct, place = _distinct(numbers)
    follows = np.flatnonzero(numbers[1:] != 0)
    key, texts = place[follows] * len(distinct) + place[follows + 1], 1 if text is None else int(text[-1]) + 1
    key, c = np.unique(key if text is None else key * texts + text, return_counts=True)
    pair = key // texts
    return distinct[pair // len(distinct)], distinct[pair % len(distinct)], key % texts, c


def part_of(u: np.ndarray, w: np.ndarray, parts: int) -> np.ndarray:
    key = np.where(w >= RARE, w, np.where(u >= RARE, u, (u << 31) + w)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((key ^ key >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    types = (pa.int32(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["part", "chunk", "kind", "block"])


def _dealt(u, w, parts: int, chunk: int, kind: int, columns) -> list[tuple]:
    return [(part, chunk, kind, pack(*(x[at] for x in columns))) for part, at in runs(part_of(u, w, parts))]


def word_counts(texts: DataFrame) -> DataFrame:
    flush = pitmanyor.FLUSH

    def count(batches):
        found, n = [], 0

        def rows():
            whole = pa.concat_tables(found).group_by("word", use_threads=False).aggregate([("n", "sum")])
            return pa.table({"word": whole["word"], "n": whole["n_sum"]})

        for part in (part for batch in batches for part in slices(batch)):
            words, codes, _ = coded(part.column("text"))
            found.append(pa.table({"word": words, "n": np.bincount(codes, minlength=len(words))}))
            found.append(pa.table({"word": pa.array([END], pa.binary()), "n": pa.array([part.num_rows], pa.int64())}))
            n += len(words) + 1
            if n > 2 * flush:
                found = [rows()]
                n = len(found[0])
                if n > flush:
                    yield from found[0].combine_chunks().to_batches()
                    found, n = [], 0
        if found:
            yield from rows().combine_chunks().to_batches()
        pa.default_memory_pool().release_unused()

    return texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("cw"))


def pair_blocks(texts: DataFrame, numbers, parts: int) -> DataFrame:
    """One block (u, w, count) in order of (u, w) for each part."""
    most = CHUNK

    def count(batches):
        for _, _, found in chunks(batches, numbers.value, most):
            u, w, _, c = counted(found)
            yield _rows(_dealt(u, w, parts, 0, PAIRS, (u, w, c)))

    def merge(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        u, w, c = unpack_all(blocks["block"], "iii")
        us, ws, pair = _places(u, w)
        del u, w
        order = np.argsort(pair)
        pair, c = pair[order], c[order]
        del order
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        u, w = us[pair // len(ws)], ws[pair % len(ws)]
        return pd.DataFrame({"part": [key[0]], "chunk": [0], "kind": [PAIRS], "block": [pack(u[first], w[first], np.add.reduceat(c, first))]})

    return texts.mapInArrow(count, BLOCKS).groupBy("part").applyInPandas(merge, BLOCKS)


def pair_rows(pairs: DataFrame, keep) -> DataFrame:
    """The rows u, w, c of blocks where ``keep`` holds of the three columns."""

    def run(batches):
        for batch in batches:
            for block in batch.column("block").to_pylist():
                columns = unpack(block, "iii")
                at = keep(*columns)
                yield pa.RecordBatch.from_arrays([pa.array(x[at]) for x in columns], names=["u", "w", "c"])

    return pairs.mapInArrow(run, "u long, w long, c long")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(33)) * PRIMES[1]
    h = (h ^ h >> np.uint64(29)) * PRIMES[2]
    return h ^ h >> np.uint64(32)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << np.uint64(bits) | x >> np.uint64(64 - bits)


def draws(seed: int, number: int, *columns: np.ndarray) -> np.ndarray:
    """A draw in [0, 1) for each row, repeatable however rows are dealt: the low 52 bits of Spark's ``xxhash64`` of the same values."""
    h = np.full(1, 42, np.uint64)
    for x in (seed, number):
        h = h + PRIMES[4] + np.uint64(4) ^ np.full(1, x & 0xFFFFFFFF, np.uint64) * PRIMES[0]
        h = _mixed(_turned(h, 23) * PRIMES[1] + PRIMES[2])
    for x in columns:
        h = h + PRIMES[4] + np.uint64(8) ^ _turned(x.astype(np.uint64) * PRIMES[1], 31) * PRIMES[0]
        h = _mixed(_turned(h, 27) * PRIMES[0] + PRIMES[3])
    return (h & np.uint64((1 << 52) - 1)).astype(np.float64) / float(1 << 52)


def of_kind(blocks: pd.DataFrame, kind: int, types: str) -> list[np.ndarray]:
    return unpack_all(blocks["block"][blocks["kind"] == kind], types)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["part", "chunk", "kind", "block"]).astype({"part": "int32", "chunk": "int64", "kind": "int32"})


def _told(part: int, words: list, contexts: list, parts: int, ranges: int) -> list[tuple]:
    """What a part tells of dense words and of contexts (ids, then columns): to the range of a dense one, to the part of any other."""
    ids, *columns = (np.concatenate(x) for x in zip(words, contexts, strict=True))
    role = np.repeat([0, 1], [len(words[0]), len(contexts[0])])
    to = np.where(ids >= RARE, ranges + part_of(ids, np.zeros_like(ids), parts), ids % ranges)
    return [(key - ranges, part, SENT, pack(ids[at], role[at], *(x[at] for x in columns))) for key, at in runs(to)]


def _heard(blocks: pd.DataFrame, n: int, ranges: int, columns: int) -> np.ndarray:
    """Sums of what was told of the words of a range: by word, role and column."""
    sums = np.zeros((n, 2, columns), np.int64)
    for block in blocks["block"][blocks["kind"] == SENT]:
        ids, role, *told = unpack(block, "ii" + "i" * columns)
        sums[ids // ranges, role] += np.stack(told, axis=1)  # a word has one row a role in a block
    return sums


def first_seats(pairs: DataFrame, parts: int, ranges: int) -> DataFrame:
    """From one table of each dish: a part's seats that can change, its words that are not dense, and what it tells."""

    def run(batches):
        for batch in batches:
            for part, block in zip(batch.column("part").to_pylist(), batch.column("block").to_pylist(), strict=True):
                u, w, c = unpack(block, "iii")
                start = u == 0
                many, single = ~start & (c > 1), ~start & (c == 1)
                ids, at = _distinct(w)
                n, once, more = (np.bincount(at, x, len(ids)).astype(np.int64) for x in (c, np.where(start, c, single), many))
                far = ids >= RARE
                moving, alone = far & ((more > 0) | (once > 1)), far & (more == 0) & (once < 2)
                one = np.ones(len(c), np.int64)
                rows = [(part, 0, SEATS, pack(*(x[many] for x in (u, w, c, one)))), (part, 0, ALONE, pack(ids[alone], n[alone]))]
                rows.append((part, 0, WORDS, pack(*(x[moving] for x in (ids, n, once, once + more, one[: len(ids)])))))
                words = [x[~far] for x in (ids, n, once, more)]
                ids, at = _distinct(u[~start])
                contexts = [ids, *(np.bincount(at, x[~start], len(ids)).astype(np.int64) for x in (c, single, many))]
                sums = (single.sum(), (~start & (c == 2)).sum(), c[start].sum() + (~start).sum(), alone.sum())
                rows.append((part, 0, TOTALS, pack(*(np.array([x], np.int64) for x in sums))))
                yield _rows(rows + _told(part, words, contexts, parts, ranges))

    return pairs.mapInArrow(run, BLOCKS)


def first_shared(seats: DataFrame, size: int, ranges: int) -> DataFrame:
    """Dense words by range, other contexts by part, and the replies to the parts that hold seats of these."""

    def run(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        if part < 0:
            ids = np.arange(part + ranges, size, ranges)
            (cw, fixed, more), (cu, once, twice) = _heard(blocks, len(ids), ranges, 3).transpose(1, 2, 0)
            return _frame([(part, 0, SHARED, pack(ids, cw, fixed, cu, once, fixed + more, np.minimum(fixed + more, 1), once + twice))])
        told = [(sender, *unpack(block, "iiiii")) for sender, block in zip(blocks["chunk"].tolist(), blocks["block"], strict=True)]
        ids, at = _distinct(np.concatenate([x[1] for x in told]))
        n, once, more = (np.bincount(at, np.concatenate([x[k] for x in told]), len(ids)).astype(np.int64) for k in (3, 4, 5))
        tu, moving = once + more, more > 0
        rows = [(part, 0, CONTEXTS, pack(*(x[moving] for x in (ids, n, once, tu)))), (part, 0, STILL, pack(*(x[~moving] for x in (ids, n, once))))]
        for sender, some, _, _, _, seats in told:
            some = some[seats > 0]
            rows.append((sender, part, REPLY, pack(some, tu[np.searchsorted(ids, some)])))
        return _frame(rows)

    return seats.filter(F.col("kind") == SENT).groupBy("part").applyInPandas(run, BLOCKS)


def seated(seats: DataFrame, shared: DataFrame, dense, totals: Totals, seed: int, number: int, kept: int, keeps: bool, parts: int, ranges: int) -> DataFrame:
    """Tables of all seats drawn anew, then those at the parent of the words that are not dense; ``kept``: samples so far."""

    def run(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        (d0, d1), (s0, s1) = totals.discounts, totals.strengths
        part, (dense_c0, dense_t0, dense_tu) = int(key[0]), dense.value
        u, w, c, t, *ts = of_kind(blocks, SEATS, "iiii" + "i" * kept)
        ids, cw, fixed, c0, t0, *samples = of_kind(blocks, WORDS, "iiiii" + "ii" * kept)
        far_u, reply = _sorted(of_kind(blocks, REPLY, "ii"))
        rare_w, rare_u = np.flatnonzero(w >= RARE), np.flatnonzero(u >= RARE)
        at_w, at_u = np.searchsorted(ids, w[rare_w]), np.searchsorted(far_u, u[rare_u])

        def looked(dense, at, rare, place, values):
            found = dense[np.where(at < RARE, at, 0)]
            found[rare] = values[place]
            return found

        rise = at_parent_without(looked(dense_c0, w, rare_w, at_w, c0), looked(dense_t0, w, rare_w, at_w, t0), t, totals)
        t = draw_tables(c, s1 + d1 * (looked(dense_tu, u, rare_u, at_u, reply) - t), d1, draws(seed, number, u, w), rise)
        c0 = fixed + np.bincount(at_w, t[rare_w], len(ids)).astype(np.int64)
        t0 = draw_tables(c0, s0 + d0 * (totals.tables[-1] - t0), d0, draws(seed, number, ids), 1 / (totals.vocabulary + 1))
        rows = [(part, 0, SEATS, pack(u, w, c, t, *ts, *[t] * keeps)), (part, 0, WORDS, pack(ids, cw, fixed, c0, t0, *samples, *[c0, t0] * keeps))]
        rows.append((part, 0, TOTALS, pack(c0.sum(keepdims=True), t0.sum(keepdims=True))))
        sums = [np.bincount(x[x < RARE], t[x < RARE], 1).astype(np.int64) for x in (w, u)]
        words, contexts = ([np.flatnonzero(x), x[x > 0]] for x in sums)
        here = np.bincount(at_u, t[rare_u], len(far_u)).astype(np.int64)
        contexts = [np.concatenate([contexts[0], far_u]), np.concatenate([contexts[1], here])]
        return _frame(rows + _told(part, words, contexts, parts, ranges))

    given = seats.filter(F.col("kind").isin(SEATS, WORDS)).unionByName(shared.filter(F.col("kind") == REPLY))
    return given.groupBy("part").applyInPandas(run, BLOCKS)


def shares(seats: DataFrame, shared: DataFrame, totals: Totals, seed: int, number: int, kept: int, keeps: bool, ranges: int) -> DataFrame:
    """What parts share after a sweep: customers and tables at the parent of dense words, tables of dense contexts and of others."""

    def run(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        part, d0, s0 = int(key[0]), totals.discounts[0], totals.strengths[0]
        if part < 0:
            ids, cw, fixed, cu, once, c0, t0, tu, *samples = of_kind(blocks, SHARED, "i" * (8 + 3 * kept))
            heard = _heard(blocks, len(ids), ranges, 1)
            c0, tu = fixed + heard[:, 0, 0], once + heard[:, 1, 0]
            t0 = draw_tables(c0, s0 + d0 * (totals.tables[-1] - t0), d0, draws(seed, number, ids), 1 / (totals.vocabulary + 1))
            block = pack(ids, cw, fixed, cu, once, c0, t0, tu, *samples, *[c0, t0, tu] * keeps)
            return _frame([(part, 0, SHARED, block), (part, 0, TOTALS, pack(c0.sum(keepdims=True), t0.sum(keepdims=True)))])
        ids, cu, once, tu, *samples = of_kind(blocks, CONTEXTS, "iiii" + "i" * kept)
        tu, sent = once.copy(), blocks[blocks["kind"] == SENT]
        told = [(sender, *unpack(block, "iii")) for sender, block in zip(sent["chunk"].tolist(), sent["block"], strict=True)]
        places = [np.searchsorted(ids, some) for _, some, _, _ in told]
        for at, (_, _, _, t) in zip(places, told, strict=True):
            tu[at] += t
        rows = [(part, 0, CONTEXTS, pack(ids, cu, once, tu, *samples, *[tu] * keeps))]
        return _frame(rows + [(sender, part, REPLY, pack(some, tu[at])) for at, (sender, some, _, _) in zip(places, told, strict=True)])

    given = seats.filter(F.col("kind") == SENT).unionByName(shared.filter(F.col("kind").isin(SHARED, CONTEXTS)))
    return given.groupBy("part").applyInPandas(run, BLOCKS)


def _blocks(frame: DataFrame, kind: int, types: str):
    """The blocks of a kind on the driver, one at a time; for dense words and sums by part only."""
    for row in frame.filter(F.col("kind") == kind).select("block").toArrow().column("block").to_pylist():
        yield unpack(row, types)


def _arrays(shared: DataFrame, size: int, types: str, start: int, stop: int) -> list[np.ndarray]:
    """Columns of what is known of dense words by number, at most ``DENSE``; the first column of their blocks is the number."""
    out = [np.zeros(size, np.int64 if x == "i" else np.float64) for x in types[start:stop]]
    for ids, *columns in _blocks(shared, SHARED, types):
        for array, column in zip(out, columns[start - 1 : stop - 1], strict=True):
            array[ids] = column
    return out


class PairModel:
    """A fitted model of all contexts, in blocks: of pairs, of seats (u, w, c, t, ts: tables of pairs seen twice or more, per sample), and of words: dense
    ones (number, cw, cu, ps: parent probability per sample, back: share that goes to the parent, per sample), others (w, cw, ps) and contexts that are not
    dense (u, cu, back). ``many``, ``words``, ``contexts`` and ``pairs`` have them as rows. ``sweeps`` has the totals of all sweeps: the parent's
    customers, which are the contexts' tables and the first words, and its tables."""

    def __init__(self, numbers: Numbers, parts: int, blocks: DataFrame, seats: DataFrame, known: DataFrame, samples: list[Totals], sweeps: list[Totals], n_tokens: int):
        self.numbers, self.parts, self.blocks, self.seats, self.known = numbers, parts, blocks, seats, known
        self.samples, self.sweeps, self.n_tokens, self.vocabulary = samples, sweeps, n_tokens, samples[0].vocabulary

    def unknown(self) -> list[float]:
        return [float(total.parent(np.zeros(1), np.zeros(1))[0]) for total in self.samples]

    def seat_rows(self, keep) -> DataFrame:
        """u, w, c, ts of the seats where ``keep`` holds of the first three."""
        n = len(self.samples)

        def run(batches):
            for batch in batches:
                for block in batch.column("block").to_pylist():
                    u, w, c, _, *ts = unpack(block, "iiii" + "i" * n)
                    at = keep(u, w, c)
                    yield pa.RecordBatch.from_arrays([*(pa.array(x[at]) for x in (u, w, c)), _listed([x[at] for x in ts])], names=["u", "w", "c", "ts"])

        return self.seats.mapInArrow(run, "u long, w long, c long, ts array<long>")

    @property
    def many(self) -> DataFrame:
        return self.seat_rows(lambda u, w, c: c > 1)

    def _known(self, kind: int, names: str, word: bool) -> DataFrame:
        n = len(self.samples)
        own = "ii" + "f" * n

        def run(batches):
            for batch in batches:
                for found, block in zip(batch.column("kind").to_pylist(), batch.column("block").to_pylist(), strict=True):
                    if found == SHARED:
                        ids, cw, cu, *rest = unpack(block, "iii" + "f" * (2 * n))
                        count, each = (cw, rest[:n]) if word else (cu, rest[n:])
                        at = count > 0
                        ids, count, each = ids[at], count[at], [x[at] for x in each]
                    else:
                        ids, count, *each = unpack(block, own)
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(count), _listed(each)], names=[x.split()[0] for x in names.split(", ")])

        return self.known.filter(F.col("kind").isin(SHARED, kind)).mapInArrow(run, names)

    @property
    def words(self) -> DataFrame:
        return self._known(WORDS, "w long, cw long, ps array<double>", True)

    @property
    def contexts(self) -> DataFrame:
        return self._known(CONTEXTS, "u long, cu long, back array<double>", False)

    @property
    def pairs(self) -> DataFrame:
        """u, w, c, pu: every pair learnt, and the probability of w after u."""
        rows = pair_rows(self.blocks, lambda u, w, c: c > 0).join(self.many.drop("c"), ["u", "w"], "left")
        rows = rows.join(self.words, "w").join(self.contexts, "u", "left")
        d, s = self.samples[0].discounts[1], self.samples[0].strengths[1]
        each = []
        for at in range(len(self.samples)):
            own = F.greatest(F.col("c") - d * F.coalesce(F.col("ts")[at], F.lit(1)), F.lit(0.0)) / (s + F.col("cu"))
            each.append(F.when(F.col("u") == 0, F.col("ps")[at]).otherwise(own + F.col("back")[at] * F.col("ps")[at]))
        return rows.select("u", "w", "c", (sum(each, F.lit(0.0)) / len(each)).alias("pu"))


def _listed(columns: list[np.ndarray]) -> pa.Array:
    """Columns as one of lists, a list a row."""
    n = len(columns[0])
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(columns), pa.int32()), pa.array(np.stack(columns, axis=1).ravel()))


def known(frame: DataFrame, samples: list[Totals]) -> DataFrame:
    """Blocks of words and contexts with their probabilities at the parent and shares that go there, per sample."""

    def run(batches):
        n = len(samples)
        (d0, d1), (s0, s1) = samples[0].discounts, samples[0].strengths

        def parents(c0s, t0s):
            for total, c0, t0 in zip(samples, c0s, t0s, strict=True):
                base = (s0 + d0 * float(total.tables[-1])) / (total.vocabulary + 1)
                yield (np.maximum(c0 - d0 * t0, 0.0) + base) / (s0 + float(total.customers[-1]))

        def back(cu, tus):
            return [(s1 + d1 * tu) / (s1 + cu) for tu in tus]

        for batch in batches:
            for part, kind, block in zip(*(batch.column(x).to_pylist() for x in ("part", "kind", "block")), strict=True):
                if kind == SHARED:
                    ids, cw, _, cu, _, _, _, _, *rest = unpack(block, "i" * (8 + 3 * n))
                    columns = [ids, cw, cu, *parents(rest[::3], rest[1::3]), *back(cu, rest[2::3])]
                elif kind == WORDS:
                    ids, cw, _, _, _, *rest = unpack(block, "i" * (5 + 2 * n))
                    columns = [ids, cw, *parents(rest[::2], rest[1::2])]
                elif kind == ALONE:
                    ids, cw = unpack(block, "ii")
                    kind, columns = WORDS, [ids, cw, *parents([np.ones(len(ids))] * n, [1] * n)]
                elif kind == CONTEXTS:
                    ids, cu, _, _, *rest = unpack(block, "i" * (4 + n))
                    columns = [ids, cu, *back(cu, rest)]
                else:
                    ids, cu, once = unpack(block, "iii")
                    kind, columns = CONTEXTS, [ids, cu, *back(cu, [once] * n)]
                yield _rows([(part, 0, kind, pack(*columns))])

    return frame.mapInArrow(run, BLOCKS)


def fit(documents: DataFrame, sweeps: int, burn_in: int, strengths, seed: int) -> PairModel:
    spark, texts, paths = documents.sparkSession, pitmanyor._texts(documents), {}

    def delete(name: str) -> None:
        if name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop(name))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    def keep(name: str, df: DataFrame) -> DataFrame:
        """Written and read back; the table it takes the place of, from which it was made, is deleted."""
        path = scratch_path(spark, f"lm-{name}")
        df.write.parquet(path)
        delete(name)
        paths[name] = path
        return spark.read.schema(df.schema).parquet(path)

    counts = keep("counts", word_counts(texts))
    n = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("cw"), F.lit(0)).alias("n"), F.count_if(F.col("cw") == 1).alias("n1"), F.count_if(F.col("cw") == 2).alias("n2")).first()
    least = max(1, -(-n["n"] // DENSE))
    often = counts.filter(F.col("cw") >= least).toArrow()  # bounded by DENSE
    often = often.sort_by([("cw", "descending"), ("word", "ascending")]).column("word").to_pylist()
    numbers, size = Numbers((word, at + 1) for at, word in enumerate(often)), len(often) + 1
    del often
    delete("counts")
    broadcast, parts, ranges = spark.sparkContext.broadcast(numbers), max(1, -(-n["n"] // PART)), -(-size // RANGE)
    pairs = keep("pairs", pair_blocks(texts, broadcast, parts))
    first = keep("first", first_seats(pairs, parts, ranges))
    told = keep("told", first_shared(first, size, ranges))
    once, twice, customers, alone = (sum(x) for x in zip([0] * 4, *([int(x[0]) for x in row] for row in _blocks(first, TOTALS, "iiii")), strict=True))
    discounts = (discount(n["n1"], n["n2"]), discount(once, twice))
    totals, every, seats, shared = Totals(np.array([customers]), np.array([n["v"]]), n["v"], discounts, strengths), [], first, told
    for number in range(sweeps):
        kept, keeps = max(0, number - burn_in), number >= burn_in
        dense = spark.sparkContext.broadcast(tuple(_arrays(shared, size, "i" * (8 + 3 * kept), 5, 8)))
        seats = keep("seats", seated(seats, shared, dense, totals, seed, number, kept, keeps, parts, ranges))
        shared = keep("shared", shares(seats, shared, totals, seed, number, kept, keeps, ranges))
        sums = [[int(x[0]) for x in row] for frame in (seats, shared) for row in _blocks(frame, TOTALS, "ii")]
        totals = Totals(np.array([sum(c for c, _ in sums) + alone]), np.array([sum(t for _, t in sums) + alone]), n["v"], discounts, strengths)
        every.append(totals)
    last = seats.filter(F.col("kind") == WORDS).unionByName(shared.filter(F.col("kind").isin(SHARED, CONTEXTS)))
    last = last.unionByName(first.filter(F.col("kind") == ALONE)).unionByName(told.filter(F.col("kind") == STILL))
    found = keep("known", known(last, every[burn_in:]))
    for name in ("first", "told", "shared"):
        delete(name)
    return PairModel(numbers, parts, pairs, seats.filter(F.col("kind") == SEATS), found, every[burn_in:], every, n["n"])


def _at(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``keys``, and whether they are there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def _sorted(columns: list[np.ndarray]) -> list[np.ndarray]:
    order = np.argsort(columns[0], kind="stable")
    return [x[order] for x in columns]


def _frequent(model: PairModel, least: int, ps: np.ndarray, cu: np.ndarray, back: np.ndarray):
    """Keys of the pairs of dense words seen ``least`` times or more, in order, and the logarithms of their probabilities; bounded by FREQUENT."""
    d, s = model.samples[0].discounts[1], model.samples[0].strengths[1]
    first = pair_rows(model.blocks, lambda u, w, c: (u == 0) & (c >= least) & (w < RARE)).select("w").toArrow()
    rows = model.seat_rows(lambda u, w, c: (c >= least) & (u < RARE) & (w < RARE)).toArrow()
    u, w, c = (rows.column(x).to_numpy() for x in ("u", "w", "c"))
    ts = pc.list_flatten(rows.column("ts")).to_numpy().reshape(len(u), len(model.samples))
    p = (np.maximum(c[:, None] - d * ts, 0) / (s + cu[u])[:, None] + back[u] * ps[w]).mean(axis=1)
    w0 = first.column("w").to_numpy()
    keys, logs = np.concatenate([w0, (u << 31) + w]), np.log10(np.concatenate([ps[w0].mean(axis=1), p]))
    return _sorted([keys, logs])


def score(documents: DataFrame, model: PairModel) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10) of every document."""
    spark, samples, parts = documents.sparkSession, len(model.samples), model.parts
    types = "iii" + "f" * (2 * samples)
    cw, cu, *rest = _arrays(model.known, len(model.numbers) + 1, types, 1, len(types))
    ps, back, unknown = np.stack(rest[:samples], axis=1), np.stack(rest[samples:], axis=1), np.array(model.unknown())
    back[cu == 0] = 1  # no context: all goes to the parent, as for first words
    least = max(2, -(-model.n_tokens // pitmanyor.FREQUENT))
    divisor = math.log10(model.n_tokens + model.vocabulary + 1)
    shared = spark.sparkContext.broadcast((model.numbers, ps, cw, back, cu, *_frequent(model, least, ps, cu, back)))
    d, s, most = model.samples[0].discounts[1], model.samples[0].strengths[1], CHUNK

    def ask(batches):
        numbers, _, cw, _, _, keys, logs = shared.value
        chunk = TaskContext.get().partitionId() << 32
        for ids, sizes, found in chunks(batches, numbers, most):
            u, w, text, n = counted(found, np.repeat(np.arange(len(sizes)), sizes))
            near = w < RARE
            count = cw[np.where(near, w, 0)]
            known = np.bincount(text, n * (near & (count > 0)), len(sizes)).astype(np.int64)
            base = np.bincount(text, np.where(near, n * (np.log10(count + 1) - divisor), 0.0), len(sizes))
            at, there = _at(keys, (u << 31) + w)
            there &= near & (u < RARE)
            part = np.bincount(text[there], n[there] * logs[at[there]], len(sizes))
            null = np.array([x is None for x in ids], np.int64)
            texts = pack(np.array([x or 0 for x in ids], np.int64), null, sizes.astype(np.int64), known, base, part)
            rest = ~there
            u, w, text, n = u[rest], w[rest], text[rest], n[rest]
            yield _rows([(chunk % parts, chunk, TEXTS, texts), *_dealt(u, w, parts, chunk, ASKED, (u, w, text, n))])
            chunk += 1

    def summed(text, known, base, part):
        distinct, at = np.unique(text, return_inverse=True)
        return pack(distinct, np.bincount(at, known, len(distinct)).astype(np.int64), np.bincount(at, base, len(distinct)), np.bincount(at, part, len(distinct)))

    def answer(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        _, dense_ps, dense_cw, dense_back, dense_cu, _, _ = shared.value
        asked, out = blocks[blocks["kind"] == ASKED], []
        passed = blocks[blocks["kind"] == TEXTS]
        pu, pw, pc = of_kind(blocks, PAIRS, "iii")
        us, ws, pairs = _places(pu, pw)  # in order, as the block is
        pt = np.ones((len(pairs), samples))
        pt[(pu != 0) & (pc > 1)] = np.stack(of_kind(blocks, SEATS, "iiii" + "i" * samples)[4:], axis=1)  # in the same order
        del pu, pw
        rare_w, rare_cw, *rare_ps = _sorted(of_kind(blocks, WORDS, "ii" + "f" * samples))
        rare_u, rare_cu, *rare_back = _sorted(of_kind(blocks, CONTEXTS, "ii" + "f" * samples))
        rare_ps, rare_back = np.stack(rare_ps, axis=1), np.stack(rare_back, axis=1)
        for chunk, block in zip(asked["chunk"].tolist(), asked["block"], strict=True):
            u, w, text, n = unpack(block, "iiii")
            (at_u, in_u), (at_w, in_w) = _at(us, u), _at(ws, w)
            at, there = _at(pairs, at_u * max(1, len(ws)) + at_w)
            there &= in_u & in_w
            c, t = np.zeros(len(u)), np.ones((len(u), samples))
            c[there], t[there] = pc[at[there]], pt[at[there]]
            far = w >= RARE
            p0, count = dense_ps[np.where(far, 0, w)], np.zeros(len(u))
            at, there = _at(rare_w, w[far])
            p0[far] = unknown
            p0[np.flatnonzero(far)[there]], count[np.flatnonzero(far)[there]] = rare_ps[at[there]], rare_cw[at[there]]
            known = np.where(far & (count > 0), n, 0)
            base = np.where(far, n * (np.log10(count + 1) - divisor), 0.0)
            own, far_u = np.maximum(c[:, None] - d * t, 0), u >= RARE
            below, share = dense_cu[np.where(far_u, 0, u)].astype(np.float64), dense_back[np.where(far_u, 0, u)]
            at, there = _at(rare_u, u[far_u])
            share[far_u], below[far_u] = 1.0, 0.0
            share[np.flatnonzero(far_u)[there]], below[np.flatnonzero(far_u)[there]] = rare_back[at[there]], rare_cu[at[there]]
            own[u == 0] = 0
            half = far & far_u
            p = np.log10(np.where(half, 1.0, (own / (s + below)[:, None] + share * p0).mean(axis=1)))
            out.append((key[0], chunk, SUMS, summed(text, known, base, n * p)))
            if half.any():
                columns = (u, text, n, *own.T, *p0.T)
                out += _dealt(u[half], np.zeros(half.sum(), np.int64), parts, chunk, HALVES, [x[half] for x in columns])
        made = pd.DataFrame(out, columns=["part", "chunk", "kind", "block"]).astype({"part": "int32", "chunk": "int64", "kind": "int32"})
        return pd.concat([made, passed], ignore_index=True) if len(passed) else made

    def finish(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        """Pairs of which neither word is dense, where their contexts are."""
        halves, out = blocks[blocks["kind"] == HALVES], []
        rare_u, rare_cu, *rare_back = _sorted(of_kind(blocks, CONTEXTS, "ii" + "f" * samples))
        rare_back = np.stack(rare_back, axis=1)
        for chunk, block in zip(halves["chunk"].tolist(), halves["block"], strict=True):
            u, text, n, *rest = unpack(block, "iii" + "f" * (2 * samples))
            own, p0 = np.stack(rest[:samples], axis=1), np.stack(rest[samples:], axis=1)
            at, there = _at(rare_u, u)
            share, below = np.ones((len(u), samples)), np.zeros(len(u))
            share[there], below[there] = rare_back[at[there]], rare_cu[at[there]]
            p = np.log10((own / (s + below)[:, None] + share * p0).mean(axis=1))
            nothing = np.zeros(len(u))
            out.append((key[0], chunk, SUMS, summed(text, nothing, nothing, n * p)))
        return pd.DataFrame(out, columns=["part", "chunk", "kind", "block"]).astype({"part": "int32", "chunk": "int64", "kind": "int32"})

    def total(blocks: pd.DataFrame) -> pd.DataFrame:
        ids, null, sizes, known, base, part = of_kind(blocks, TEXTS, "iiiiff")
        for block in blocks["block"][blocks["kind"] == SUMS]:
            text, k, b, p = unpack(block, "iiff")
            known[text] += k
            base[text] += b
            part[text] += p
        doc_id = pd.array(ids, "Int64")
        doc_id[null.astype(bool)] = pd.NA
        return pd.DataFrame({"doc_id": doc_id, "n_tokens": sizes, "n_known": known, "base_score": base, "score": part})

    given = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    far = model.known.filter(F.col("kind") == CONTEXTS)
    learnt = model.blocks.unionByName(model.seats).unionByName(model.known.filter(F.col("kind").isin(WORDS, CONTEXTS)))
    answered = stored(given.mapInArrow(ask, BLOCKS).unionByName(learnt).groupBy("part").applyInPandas(answer, BLOCKS), "lm-sums")
    halves = answered.filter(F.col("kind") == HALVES).unionByName(far).groupBy("part").applyInPandas(finish, BLOCKS)
    rows = answered.filter(F.col("kind") != HALVES).unionByName(halves)
    return rows.groupBy("chunk").applyInPandas(total, "doc_id long, n_tokens long, n_known long, base_score double, score double")
