"""Words of a whole Arrow batch at once: where they lie in its bytes, and 64-bit hashes of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20  # documents worked on together; a longer document makes a slice of its own
_HASH_BYTES = 1 << 18  # a worker keeps 16 bytes for each

_BASE = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_VALUES[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]  # A-Z count as a-z
_POWERS: dict[int, np.ndarray] = {}


def byte_class(*parts: int | range) -> np.ndarray:
    """A table of 256 flags, true at the given bytes."""
    flags = np.zeros(256, dtype=bool)
    for part in parts:
        flags[part if isinstance(part, int) else list(part)] = True
    return flags


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after another, and the n + 1 places where they begin; null is empty."""
    column = column.cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count and np.any(np.diff(offsets)[~column.is_valid().to_numpy(zero_copy_only=False)]):
        column = column.fill_null(b"")
        return text_bytes(column)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes together, one document at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): maximal runs of word bytes inside documents; words of document i are first[i]:first[i+1]."""
    flags = is_word[data]
    if not len(flags):
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(flags) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate([[False], flags[:-1]])
    after = np.concatenate([flags[1:], [False]])
    starts = np.flatnonzero(flags & (~before | edge[:-1]))
    ends = np.flatnonzero(flags & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_HASH_BYTES, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        pair = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            pair.append(np.multiply.accumulate(steps))
        _POWERS[size] = tuple(pair)
    return _POWERS[size]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, A-Z as a-z; spans must be in order."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _HASH_BYTES, side="right")))
        low, high = int(starts[i]), int(ends[j - 1])
        powers, inverses = _powers(high - low)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_VALUES[data[low:high]] * powers[: high - low])])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mixed((sums[e] - sums[s]) * inverses[s] + (e - s).astype(np.uint64))
        i = j
    return out
