"""Periodic runs of words: recursive frequency splitting, then a scan of the lags that are left.

A word inside a run of exponent ``exponent`` occurs at least that often in it. So every word that occurs less often in its
segment splits the segment, and the parts are counted again until nothing splits. What survives is short in prose, and
the whole of a looping text.

The scan takes lags by powers of two. For lags from ``size / 2`` to ``size - 1`` it looks at all strings of ``size`` words
and how far away each occurs next. Inside a run of such a period that distance is the period, from the first word of
the run to its last but ``period + size - 1``, because the root of a run is no power of a shorter string; outside, it is
not. So a stretch of equal distances is a run, with its exact ends and its smallest period. Every power sorts the segments
once: time grows as ``n log(n) ** 2``, not as words times lags.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torqline.llm import words

EXPONENT = 4
SHORTEST = 6


def surviving_segments(symbols: np.ndarray, segment: np.ndarray, least: int, shortest: int) -> np.ndarray:
    """Positions left by frequency splitting, in order.

    ``segment`` numbers the segment of every position and never falls. Positions left that follow one another are a
    segment without a word of fewer than ``least`` occurrences in it; all have ``shortest`` words or more, but those
    that nothing split.
    """
    kinds = int(symbols.max(initial=0)) + 1
    at = np.arange(len(symbols))
    done: list[np.ndarray] = []
    while len(at):
        key = (segment - segment[0]) * kinds + symbols[at]
        order = np.argsort(key, kind="stable")
        new = np.ones(len(at), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        kind = np.cumsum(new) - 1
        rare = np.zeros(len(at), bool)
        rare[order] = np.bincount(kind)[kind] < least
        first = np.ones(len(at), bool)
        first[1:] = segment[1:] != segment[:-1]
        # Segments without a rare word are stable and not counted again.
        part = np.cumsum(first) - 1
        split = np.bincount(part, rare)[part] > 0
        done.append(at[~split])
        first[1:] |= rare[:-1]
        piece = np.cumsum(first)
        keep = split & ~rare
        long_enough = np.bincount(piece[keep], minlength=piece[-1] + 1) >= shortest
        keep &= long_enough[piece]
        at, segment = at[keep], piece[keep]
    return np.sort(np.concatenate([np.zeros(0, np.int64), *done]))


def _numbered(left: np.ndarray, document: np.ndarray) -> np.ndarray:
    """Segments of positions that follow one another inside a document."""
    first = np.ones(len(left), bool)
    first[1:] = (np.diff(left) > 1) | (document[left[1:]] != document[left[:-1]])
    return np.cumsum(first) - 1


def periodic_runs(
    symbols: np.ndarray, document: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, periods) of all maximal runs, by start, then period.

    ``document`` numbers the document of every word and never falls; runs stay inside documents. A run has at least
    ``shortest`` words and ``exponent`` of its smallest periods; exponents below 3 are refused, as a run could then be
    too short for its distances to show.
    """
    if exponent < 3:
        raise ValueError("exponent must be 3 or more")
    nothing = np.zeros(0, np.int64)
    if not len(symbols):
        return nothing, nothing, nothing
    left = surviving_segments(symbols, document, exponent, shortest)
    if not len(left):
        return nothing, nothing, nothing
    segment = _numbered(left, document)
    sizes = np.bincount(segment)
    # A separator that occurs nowhere else ends each segment.
    ends = np.cumsum(sizes)
    name = np.insert(symbols[left], ends, int(symbols.max()) + 1 + np.arange(len(ends)))
    place = np.insert(left, ends, -1)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 2
    while size // 2 * exponent <= int(sizes.max()) and len(name) > size // 2:
        half = size // 2
        key = name[:-half] * (int(name.max()) + 1) + name[half:]
        order = np.argsort(key, kind="stable")
        new = np.ones(len(key), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        distance = np.zeros(len(key), np.int64)
        distance[order[:-1]] = np.where(new[1:], 0, order[1:] - order[:-1])
        name = np.empty(len(key), np.int64)
        name[order] = np.cumsum(new) - 1
        in_lags = (distance >= half) & (distance < size)
        begins, closes = in_lags.copy(), in_lags.copy()
        same = distance[1:] == distance[:-1]
        begins[1:] &= ~same
        closes[:-1] &= ~same
        low, high = np.flatnonzero(begins), np.flatnonzero(closes)
        period = distance[low]
        length = high - low + period + size
        enough = length >= np.maximum(shortest, exponent * period)
        found.append((place[low[enough]], length[enough], period[enough]))
        size *= 2
    starts, lengths, periods = (np.concatenate(c) for c in zip(*found)) if found else (nothing,) * 3
    order = np.lexsort([periods, starts])
    return starts[order], lengths[order], periods[order]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _collapsed(exponent: int, shortest: int):
    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            data, offsets = words.text_bytes(batch.column(1))
            for i, j in words.slices(offsets):
                texts = [data[a:b].tobytes().split() for a, b in zip(offsets[i:j], offsets[i + 1 : j + 1])]
                number: dict[bytes, int] = {}
                symbols = np.array([number.setdefault(w, len(number)) for text in texts for w in text], np.int64)
                counts = np.array([len(text) for text in texts], np.int64)
                first = np.concatenate([[0], np.cumsum(counts)])
                document = np.repeat(np.arange(j - i), counts)
                starts, lengths, periods = periodic_runs(symbols, document, exponent, shortest)
                edges = np.zeros(len(symbols) + 1, np.int64)
                np.add.at(edges, starts + periods, 1)
                np.add.at(edges, starts + lengths, -1)
                dropped = np.cumsum(edges[:-1]) > 0
                owner = document[starts]
                cut = np.searchsorted(owner, np.arange(j - i + 1))
                runs, kept = [], []
                for d, text in enumerate(texts):
                    a, b = cut[d], cut[d + 1]
                    columns = (starts[a:b] - first[d], lengths[a:b], periods[a:b])
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in zip(*(c.tolist() for c in columns))])
                    if b > a:
                        gone = dropped[first[d] : first[d + 1]].tolist()
                        text = [w for w, g in zip(text, gone) if not g]
                    kept.append(b" ".join(text))
                collapsed = pa.array(kept, pa.large_binary()).cast(pa.large_string())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(counts), pa.array(runs, _RUNS), collapsed.cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return collapse


def collapsed_runs(docs: DataFrame, exponent: int = EXPONENT, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, runs (start and length in words, smallest period; by start, then period) and collapsed text.

    Words are runs of characters other than white space, compared as they are. A run is a stretch of consecutive words
    with ``exponent`` or more of its smallest periods and ``shortest`` or more words that no neighbouring word extends.
    Words inside any run after its first period are dropped; the others are joined by one space. Null, empty and blank
    texts have no words, no runs and an empty collapsed text; rows without an id and repeated rows are treated like all
    others; other columns are not read. A very long text is worked on alone in memory of a small multiple of its size.
    A map over documents: nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run = "array<struct<start:long,length:long,period:long>>"
    return rows.mapInArrow(_collapsed(exponent, shortest), f"doc_id long, n_words long, runs {run}, collapsed string")
