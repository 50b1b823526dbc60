"""A static range asymmetric numeral coder for token ids, vectorised over interleaved lanes.

A shard is a byte string: header, frequency table, document table, blocks. All blocks of a shard share its table, whose
frequencies sum to 2**SCALE_BITS. A block holds up to ``BLOCK_IDS`` ids dealt over lanes (id i goes to lane i mod lanes); each lane
is a coder state of its own and all lanes share one stream of 32-bit words. Blocks are independent: each starts with its
lanes' states, and every ``CHECKPOINT`` steps a checkpoint repeats states and stream place, so decoding can begin there. Blocks
carry a crc32 of their ids, the shard one of everything before it.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TIDR"
VERSION = 1
SCALE_BITS = 18
LOW = np.uint64(1 << 31)  # states lie in [LOW, LOW << 32)
LANES = 2048
BLOCK_IDS = 1 << 18
CHECKPOINT = 48
NO_ID = -(1 << 63)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and positive frequencies that sum to 2**SCALE_BITS, near their share; the largest take up the rest."""
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    symbols = np.flatnonzero(counts)
    if not len(symbols):
        return symbols, symbols
    total = 1 << SCALE_BITS
    if len(symbols) > total // 2:
        raise ValueError("more distinct ids than the frequency scale can hold")
    share = np.maximum(1, np.floor(counts[symbols] * (total / counts.sum()))).astype(np.int64)
    order = np.argsort(-share, kind="stable")
    over = int(share.sum()) - total
    while over > 0:  # ids rarer than the scale were rounded up; the commonest give it back
        for place in order:
            step = min(over, int(share[place]) // 2)
            share[place] -= step
            over -= step
            if not over:
                break
    share[order[0]] -= over
    return symbols, share


def _encode_block(at: np.ndarray, freq: np.ndarray, start: np.ndarray) -> bytes:
    """``at`` are places in the table."""
    n = len(at)
    lanes = int(min(LANES, max(1, n // 64)))
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, np.uint64)
    words, points, emitted = [], [], 0
    shift, scale = np.uint64(32), np.uint64(SCALE_BITS)
    room = LOW >> scale << shift
    for step in range(steps - 1, -1, -1):
        mine = at[step * lanes : (step + 1) * lanes]
        f, s, x = freq[mine], start[mine], state[: len(mine)]
        full = x >= f * room
        if full.any():
            out = x[full]
            words.append((out & np.uint64(0xFFFFFFFF)).astype("<u4"))  # kept in lane order, read in the same order
            emitted += len(out)
            x = x.copy()
            x[full] = out >> shift
        quotient = x // f
        state[: len(mine)] = (quotient << scale) + (x - quotient * f) + s
        if step and step % CHECKPOINT == 0:
            points.append((step, emitted, state.astype("<u8").tobytes()))
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    points.reverse()
    body = struct.pack("<IHHI", n, lanes, len(points), emitted) + state.astype("<u8").tobytes()
    for step, place, states in points:
        body += struct.pack("<II", step, emitted - place) + states
    return body + stream.tobytes()


def _decode_block(body: bytes, freq: np.ndarray, start: np.ndarray, slots: np.ndarray, from_checkpoint: int = 0) -> tuple[int, np.ndarray]:
    """First id's place and the table places from a checkpoint on (0: the block's start)."""
    n, lanes, n_points, emitted = struct.unpack_from("<IHHI", body)
    at, first, taken = 12, 0, 0
    state = np.frombuffer(body, "<u8", lanes, at).astype(np.uint64)
    at += lanes * 8
    for number in range(1, n_points + 1):
        step, place = struct.unpack_from("<II", body, at)
        if number == from_checkpoint:
            first, taken = step, place
            state = np.frombuffer(body, "<u8", lanes, at + 8).astype(np.uint64)
        at += 8 + lanes * 8
    stream = np.frombuffer(body, "<u4", emitted, at).astype(np.uint64)
    out = np.empty(n, np.int64)
    mask, shift, scale = np.uint64((1 << SCALE_BITS) - 1), np.uint64(32), np.uint64(SCALE_BITS)
    for step in range(first, -(-n // lanes)):
        a, b = step * lanes, min(n, (step + 1) * lanes)
        x = state[: b - a]
        slot = x & mask
        mine = slots[slot]
        out[a:b] = mine
        x = freq[mine] * (x >> scale) + slot - start[mine]
        low = np.flatnonzero(x < LOW)
        if len(low):
            x[low] = x[low] << shift | stream[taken : taken + len(low)]
            taken += len(low)
        state[: b - a] = x
    return first * lanes, out[first * lanes :]


def encode_shard(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, part: int, start: int) -> bytes:
    """One shard: documents in order, ``ids`` all their ids. ``part`` and ``start`` say where the shard stands in the whole."""
    symbols, share = frequencies(ids)
    freq = share.astype(np.uint64)
    begin = np.concatenate([[0], np.cumsum(share)[:-1]]).astype(np.uint64) if len(share) else freq
    place = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.int64)
    place[symbols] = np.arange(len(symbols))
    table = zlib.compress(np.diff(symbols, prepend=0).astype("<u4").tobytes() + share.astype("<u4").tobytes(), 6)
    known = np.array([NO_ID if doc_id is None else doc_id for doc_id in doc_ids], "<i8")
    documents = zlib.compress(known.tobytes() + np.asarray(lengths, "<u8").tobytes(), 6)
    blocks = []
    for at in range(0, len(ids), BLOCK_IDS):
        part_ids = ids[at : at + BLOCK_IDS]
        body = _encode_block(place[part_ids], freq, begin)
        blocks.append(struct.pack("<II", len(body), zlib.crc32(part_ids.astype("<u4").tobytes())) + body)
    head = MAGIC + struct.pack("<HHIqQIIII", VERSION, SCALE_BITS, part, start, len(ids), len(doc_ids), len(symbols), len(table), len(documents))
    shard = b"".join([head, table, documents, struct.pack("<I", len(blocks)), *blocks])
    return shard + struct.pack("<I", zlib.crc32(shard))


def decode_shard(shard: bytes) -> tuple[int, int, list[int | None], np.ndarray, np.ndarray]:
    """part, start, doc ids, lengths, ids; raises ValueError if a checksum does not hold."""
    if shard[:4] != MAGIC or zlib.crc32(memoryview(shard)[:-4]) != struct.unpack("<I", shard[-4:])[0]:
        raise ValueError("not a whole shard")
    _, _, part, start, n_ids, n_docs, n_symbols, n_table, n_documents = struct.unpack_from("<HHIqQIIII", shard, 4)
    at = 4 + struct.calcsize("<HHIqQIIII")
    numbers = np.frombuffer(zlib.decompress(shard[at : at + n_table]), "<u4").astype(np.int64)
    symbols, share = np.cumsum(numbers[:n_symbols]), numbers[n_symbols:]
    at += n_table
    raw = zlib.decompress(shard[at : at + n_documents])
    known, lengths = np.frombuffer(raw, "<i8", n_docs), np.frombuffer(raw, "<u8", n_docs, n_docs * 8).astype(np.int64)
    at += n_documents
    freq = share.astype(np.uint64)
    begin = np.concatenate([[0], np.cumsum(share)[:-1]]).astype(np.uint64) if n_symbols else freq
    slots = np.repeat(np.arange(n_symbols), share)
    (n_blocks,) = struct.unpack_from("<I", shard, at)
    at += 4
    found = [np.zeros(0, "<u4")]
    for _ in range(n_blocks):
        size, crc = struct.unpack_from("<II", shard, at)
        ids = symbols[_decode_block(shard[at + 8 : at + 8 + size], freq, begin, slots)[1]].astype("<u4")
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError("a block's ids do not match their checksum")
        found.append(ids)
        at += 8 + size
    ids = np.concatenate(found)
    if len(ids) != n_ids:
        raise ValueError("a shard lacks ids")
    return part, start, [None if value == NO_ID else int(value) for value in known], lengths, ids
