"""Columns of numbers as one compressed value, so that millions of small rows travel as a few rows of bounded size."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(*columns) -> bytes:
    """Columns of equal length (64-bit integers or doubles): bytes of equal weight side by side, then compressed."""
    parts = [np.int64(len(columns[0])).tobytes()]
    parts += [np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T).tobytes() for x in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(block: bytes, types: str) -> list[np.ndarray]:
    """The columns of a block; a letter a column, i or f."""
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    planes = np.frombuffer(raw, np.uint8, offset=8).reshape(len(types), 8, n)
    return [np.ascontiguousarray(plane.T).view(np.int64 if kind == "i" else np.float64).reshape(n) for plane, kind in zip(planes, types, strict=True)]


def unpack_all(blocks, types: str) -> list[np.ndarray]:
    """The columns of several blocks, one below the other."""
    found = [unpack(block, types) for block in blocks]
    if not found:
        return [np.zeros(0, np.int64 if kind == "i" else np.float64) for kind in types]
    return [np.concatenate(columns) for columns in zip(*found, strict=True)]


def runs(labels: np.ndarray):
    """(label, places) of each distinct label; places keep their order."""
    few = len(labels) and labels.min() >= 0 and labels.max() < 1 << 16
    order = np.argsort(labels.astype(np.uint16) if few else labels, kind="stable")  # 16 bits are sorted by radix
    if not len(order):
        return
    starts = np.flatnonzero(np.concatenate([[True], np.diff(labels[order]) != 0]))
    for places in np.split(order, starts[1:]):
        yield int(labels[places[0]]), places
