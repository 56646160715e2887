"""Small numpy helpers for the operators that see bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def random_table(seed: int, kind: type) -> np.ndarray:
    """256 fixed random values, one for each byte."""
    return np.random.default_rng(seed).integers(0, np.iinfo(kind).max, 256, dtype=kind, endpoint=True)


def binaries(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each value without a copy; null is empty."""
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return (flat[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbouring values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after another."""
    total = int(size.sum())
    first = np.cumsum(size) - size
    return np.arange(total) + np.repeat(start - first, size)


def merge_spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs that half-open spans cover."""
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    first = np.r_[True, lo[1:] > reach[:-1]] if len(lo) else np.empty(0, bool)
    last = np.r_[first[1:], True] if len(lo) else first
    return lo[first], reach[last]


def outside(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> bytes:
    """The bytes that no run covers; runs as merge_spans returns them."""
    if not len(lo):
        return data.tobytes()
    return b"".join(data[a:b].tobytes() for a, b in zip([0, *hi.tolist()], [*lo.tolist(), len(data)], strict=True))
