"""Benchmark decontamination: an FM-index per training shard, searched for benchmark phrases.

A task indexes the words of the documents it reads, a shard of bounded size at a time: suffix array, Burrows-Wheeler
transform in a wavelet matrix with popcount ranks, and suffix positions sampled at regular places. All phrases are
searched backwards together; their occurrences are located by walking to sampled positions, and overlapping ones
merge into removal spans.

The index holds every word that can take part in an occurrence: a word outside the benchmark's vocabulary ends a
stretch, and stretches shorter than the shortest phrase are left out. Stretches never join, as each ends in a separator.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torqline.llm import words

WINDOW = 10  # words of a benchmark phrase
SHARD_SYMBOLS = 1 << 20  # an index is built when a shard has this many words to hold
SHARD_BYTES = 48 << 20  # or this much text
BLOCK_WINDOWS = 200_000  # phrases sent to the tasks and searched together
SAMPLE_RATE = 16

_WORD = words.byte_class(
    range(ord("0"), ord("9") + 1), range(ord("A"), ord("Z") + 1), range(ord("a"), ord("z") + 1), range(0x80, 0x100)
)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; symbol 0 is a separator, each one different and below all others."""
    n = len(symbols)
    rank = symbols.astype(np.int64) + n
    zero = np.flatnonzero(symbols == 0)
    rank[zero] = np.arange(len(zero))
    order = np.argsort(rank, kind="stable")
    step, ordered = 1, rank[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]) if n else 0
    while n and rank.max() < n - 1:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        step *= 2
    return order


class _Bits:
    """A bit vector with ranks by counts per 64-bit word and popcounts."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=bool)
        padded[: len(bits)] = bits
        self.blocks = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.blocks), dtype=np.int64)])
        self.ones = int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        block, rest = i >> 6, (i & 63).astype(np.uint64)
        return self.before[block] + np.bitwise_count(self.blocks[block] & ((np.uint64(1) << rest) - np.uint64(1)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.blocks[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) > 0


class FMIndex:
    """An index of integer symbols; 0 separates texts and is never part of a phrase."""

    def __init__(self, symbols: np.ndarray, alphabet: int, sample_rate: int = SAMPLE_RATE):
        self.size = len(symbols)
        order = suffix_array(symbols)
        last = symbols[order - 1]
        counts = np.bincount(symbols, minlength=alphabet)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.levels: list[tuple[_Bits, int]] = []
        column = last
        for bit in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            ones = (column >> bit & 1).astype(bool)
            self.levels.append((_Bits(ones), len(column) - int(ones.sum())))
            column = np.concatenate([column[~ones], column[ones]])
        self.first = self._walk(np.arange(alphabet), np.zeros(alphabet, np.int64))
        # Every walk ends at a sample: positions at regular places, and those that follow a separator.
        sampled = (order % sample_rate == 0) | (last == 0)
        self.sampled = _Bits(sampled)
        self.positions = order[sampled]

    def _walk(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for depth, (bits, zeros) in enumerate(self.levels):
            one = (symbol >> (len(self.levels) - 1 - depth) & 1).astype(bool)
            ones = bits.rank(i)
            i = np.where(one, zeros + ones, i - ones)
        return i

    def step(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """The row reached by putting ``symbol`` before the first i rows."""
        return self.before[symbol] + self._walk(symbol, i) - self.first[symbol]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each phrase (its symbols at the left of a row of ``phrases``)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        for j in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((lengths > j) & (low < high))
            symbol = phrases[live, j]
            low[live], high[live] = self.step(symbol, low[live]), self.step(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes in these rows."""
        out, walked = np.empty(len(rows), np.int64), 0
        at, left = rows.copy(), np.arange(len(rows))
        while len(left):
            done = self.sampled.get(at)
            out[left[done]] = self.positions[self.sampled.rank(at[done])] + walked
            left, at = left[~done], at[~done]
            symbol, i = np.zeros(len(at), np.int64), at
            for bits, zeros in self.levels:
                one = bits.get(i)
                ones = bits.rank(i)
                symbol = symbol * 2 + one
                i = np.where(one, zeros + ones, i - ones)
            at = self.before[symbol] + i - self.first[symbol]
            walked += 1
        return out


def benchmark_phrases(benchmark: DataFrame, window: int = WINDOW) -> tuple[np.ndarray, list[dict]]:
    """The vocabulary (sorted word hashes) and blocks of distinct phrases with the items they belong to.

    The benchmark is the stated set of queries: its words pass the driver, in blocks. Rows without an id or without
    words give none.
    """
    hashes, lengths, items = [], [], []
    for row in benchmark.select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")
    ).dropna().distinct().toLocalIterator():
        data, offsets = words.text_bytes(pa.array([row["text"]]))
        starts, ends, _ = words.word_spans(data, offsets, _WORD)
        own = words.span_hashes(data, starts, ends)
        if len(own):
            size = min(window, len(own))
            rows = np.zeros((len(own) - size + 1, window), np.uint64)
            rows[:, :size] = np.lib.stride_tricks.sliding_window_view(own, size)
            hashes.append(rows)
            lengths.append(np.full(len(rows), size))
            items += [row["item"]] * len(rows)
    if not hashes:
        return np.zeros(0, np.uint64), []
    phrases, lengths, items = np.concatenate(hashes), np.concatenate(lengths), np.array(items, dtype=object)
    in_use = np.arange(window)[None, :] < lengths[:, None]
    vocabulary = np.unique(phrases[in_use])
    symbols = np.where(in_use, np.searchsorted(vocabulary, phrases) + 1, 0)
    distinct, number = np.unique(symbols, axis=0, return_inverse=True)
    number = number.ravel()
    order = np.argsort(number, kind="stable")
    at = np.searchsorted(number[order], np.arange(len(distinct) + 1))
    blocks = []
    for i in range(0, len(distinct), BLOCK_WINDOWS):
        part = distinct[i : i + BLOCK_WINDOWS]
        blocks.append(
            {
                "phrases": part,
                "lengths": (part > 0).sum(axis=1),
                "items": [sorted(set(items[order[at[k] : at[k + 1]]])) for k in range(i, i + len(part))],
            }
        )
    return vocabulary, blocks


class _Shard:
    """Documents of a task, gathered until their index is built."""

    def __init__(self, vocabulary: np.ndarray, shortest: int):
        self.vocabulary, self.shortest = vocabulary, shortest
        self.batches: list[pa.RecordBatch] = []
        self.n_words: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, ...]] = []  # symbol, document, first byte, end byte; 0 ends a stretch
        self.docs = self.symbols = self.bytes = 0

    def add(self, batch: pa.RecordBatch, column: pa.Array) -> None:
        data, offsets = words.text_bytes(column)
        for i, j in words.slices(offsets):
            own, cut = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            starts, ends, first = words.word_spans(own, cut, _WORD)
            self.n_words.append(np.diff(first))
            hashes = words.span_hashes(own, starts, ends)
            place = np.searchsorted(self.vocabulary, hashes)
            known = place < len(self.vocabulary)
            known[known] = self.vocabulary[place[known]] == hashes[known]
            doc = np.repeat(np.arange(j - i), np.diff(first))
            opens = known.copy()
            opens[1:] &= ~(known[:-1] & (doc[1:] == doc[:-1]))
            begin = np.flatnonzero(opens)
            run = np.cumsum(opens) - 1
            size = np.bincount(run[known], minlength=len(begin)) if len(begin) else np.zeros(0, np.int64)
            keep = known.copy()
            keep[known] = size[run[known]] >= self.shortest
            at = np.flatnonzero(keep)
            if len(at):
                # A separator goes after the last word of each stretch.
                cuts = np.flatnonzero(np.append(run[at][1:] != run[at][:-1], True)) + 1
                columns = (place[at] + 1, doc[at] + self.docs, starts[at] - cut[doc[at]], ends[at] - cut[doc[at]])
                self.parts.append(tuple(np.insert(c, cuts, 0) for c in columns))
                self.symbols += len(at) + len(cuts)
            self.docs += j - i
        self.batches.append(batch)
        self.bytes += len(data)

    def found(self, blocks: list) -> Iterator[tuple[pa.RecordBatch, np.ndarray, dict[int, tuple[int, list, list]]]]:
        """Per batch: words of each document, and for contaminated ones (words hit, item ids, byte spans)."""
        hit: dict[int, tuple[int, list, list]] = {}
        if self.parts:
            symbol, doc, start, end = (np.concatenate(c) for c in zip(*self.parts))
            index = FMIndex(symbol, len(self.vocabulary) + 1)
            edges = np.zeros(len(symbol) + 1, np.int64)
            items: dict[int, set] = {}
            for block in blocks:
                block = block.value
                low, high = index.search(block["phrases"], block["lengths"])
                count = high - low
                phrase = np.repeat(np.arange(len(count)), count)
                rows = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
                at = index.locate(rows)
                np.add.at(edges, at, 1)
                np.add.at(edges, at + block["lengths"][phrase], -1)
                for key in np.unique(doc[at] * len(count) + phrase).tolist():
                    items.setdefault(key // len(count), set()).update(block["items"][key % len(count)])
            marked = np.cumsum(edges[:-1]) > 0
            opens = np.flatnonzero(marked & ~np.concatenate([[False], marked[:-1]]))
            closes = np.flatnonzero(marked & ~np.concatenate([marked[1:], [False]]))
            spans: dict[int, list] = {}
            sizes: dict[int, int] = {}
            for a, b in zip(opens.tolist(), closes.tolist()):
                d = int(doc[a])
                spans.setdefault(d, []).append((int(start[a]), int(end[b])))
                sizes[d] = sizes.get(d, 0) + b - a + 1
            hit = {d: (sizes[d], sorted(items[d]), spans[d]) for d in spans}
        n_words = np.concatenate([np.zeros(0, np.int64), *self.n_words])
        first = 0
        for batch in self.batches:
            n = batch.num_rows
            yield batch, n_words[first : first + n], {d - first: hit[d] for d in hit if first <= d < first + n}
            first += n


def _shards(batches: Iterator[pa.RecordBatch], text_at: int, vocabulary, blocks: list, shortest: int):
    shard = _Shard(vocabulary.value, shortest)
    for batch in batches:
        shard.add(batch, batch.column(text_at))
        if shard.symbols >= SHARD_SYMBOLS or shard.bytes >= SHARD_BYTES:
            yield from shard.found(blocks)
            shard = _Shard(vocabulary.value, shortest)
    yield from shard.found(blocks)


_FOUND = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items (ids as sorted strings) and spans (bytes to remove) of every document.

    Words are runs of ASCII letters and digits and of all other non-ASCII characters, A-Z as a-z. A phrase is
    ``window`` consecutive words of a benchmark text, or the whole of a shorter one. A word is hit where any
    occurrence of a phrase covers it; spans join hit words that follow one another. Null and empty texts have no
    words; without a benchmark nothing is hit; repeated rows get equal results; other columns are not read.
    """
    vocabulary, blocks = benchmark_phrases(benchmark, window)
    shortest = min((int(b["lengths"].min()) for b in blocks), default=window)
    context = docs.sparkSession.sparkContext
    vocabulary, blocks = context.broadcast(vocabulary), [context.broadcast(b) for b in blocks]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch, n_words, hit in _shards(batches, 1, vocabulary, blocks, shortest):
            rows = [hit.get(i, (0, [], [])) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.list_(pa.string())),
                    pa.array([[{"start": s, "end": e} for s, e in r[2]] for r in rows], span),
                ],
                names=["doc_id", "n_words", "n_hit", "items", "spans"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(find, _FOUND)


def without_phrases(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs``, all rows and columns, with the removal spans cut out of ``text`` and ``n_chars`` counted anew there.

    Documents without an occurrence stay as they are. ``text`` must be a string column; ``n_chars`` is optional.
    """
    vocabulary, blocks = benchmark_phrases(benchmark, window)
    shortest = min((int(b["lengths"].min()) for b in blocks), default=window)
    context = docs.sparkSession.sparkContext
    vocabulary, blocks = context.broadcast(vocabulary), [context.broadcast(b) for b in blocks]
    names = docs.columns
    text_at = names.index("text")
    chars_at = names.index("n_chars") if "n_chars" in names else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, hit in _shards(batches, text_at, vocabulary, blocks, shortest):
            columns = list(batch.columns)
            if hit:
                texts = columns[text_at].to_pylist()
                chars = columns[chars_at].to_pylist() if chars_at is not None else None
                for i, (_, _, spans) in hit.items():
                    raw, kept, at = texts[i].encode(), [], 0
                    for start, end in spans:
                        kept.append(raw[at:start])
                        at = end
                    texts[i] = (b"".join(kept) + raw[at:]).decode()
                    if chars is not None:
                        chars[i] = len(texts[i])
                columns[text_at] = pa.array(texts, columns[text_at].type)
                if chars is not None:
                    columns[chars_at] = pa.array(chars, columns[chars_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(cut, docs.schema)
