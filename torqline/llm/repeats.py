"""Removal of long repeated passages by run-length indexes.

A byte goes if a string of ``span`` bytes that covers it also starts anywhere else in the corpus. Every such string
(window) belongs to exactly one bucket: the hash of the smallest of the short grams in it. Windows that follow one another
in a document and share a bucket travel together as one piece of text. Only pieces whose bucket holds another piece
are cut out at all, equal pieces are kept once, and each task indexes the pieces of its buckets, a shard of bounded
size at a time. Equal windows have the gram of their bucket at the same place, so pieces are first cut down to the windows
around whose gram another piece of the bucket reads the same; what cannot repeat is not sorted:

* suffix array and Burrows-Wheeler transform of the shard, kept as runs;
* at the first and the last row of each run, the text position (a sampled run end) and how far its suffix agrees with the
  suffix in the row before or behind;
* streamed over the text, these samples give for every position how far it agrees with any other position: between
  samples the value falls by one per byte. Where it reaches ``span``, a window repeats.

Buckets too large for one index are settled by counting window hashes, one row per window, instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torqline.llm import words
from torqline.llm.common import TEXT_BATCH, sent_if_small, stored

SPAN = 400
GRAM = 32
SHARD_BYTES = 1 << 20  # pieces indexed together
BUCKET_BYTES = 8 << 20  # distinct pieces of one bucket up to which it is indexed
PARTS = 4  # ranges of places of the gram in a window; any number gives the same result
_PLACE_BITS = np.uint64(30)
_PLACE = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)


def _rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every string of ``size`` bytes."""
    table = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    out = np.empty(max(0, len(data) - size + 1), np.uint64)
    step = max(1 << 20, 2 * size)
    for low in range(0, len(out), step - size + 1):
        part = data[low : low + step]
        powers, inverses = words._powers(len(part))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(table[part] * powers[: len(part)])])
        n = len(part) - size + 1
        out[low : low + n] = words.mixed((sums[size:] - sums[:n]) * inverses[:n])
    return out


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


class Windows:
    """The windows of several documents laid end to end, as pieces.

    ``doc``, ``start`` (in the slice), ``count`` (windows), ``key`` and ``anchor`` (where the gram of the key begins, in the
    piece) describe the pieces; ``here`` flags windows that
    also start elsewhere in their own document. Of those only the first of each kind is in a piece.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, span: int, gram: int):
        self.span, n = span, len(data)
        self.here = np.zeros(n + 1, dtype=bool)
        edges = np.zeros(n + 1, np.int64)
        long = np.flatnonzero(np.diff(offsets) >= span)
        np.add.at(edges, offsets[long], 1)
        np.add.at(edges, offsets[long + 1] - span + 1, -1)
        valid = np.cumsum(edges)[:n] > 0
        if not len(long):
            self.doc = self.start = self.count = self.anchor = np.zeros(0, np.int64)
            self.key = np.zeros(0, np.uint64)
            return
        grams = _rolling(data, gram)
        ordered = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        anchor = np.zeros(n, np.int64)
        least = _sliding_least(ordered, span - gram + 1)
        anchor[: len(least)] = (least & _PLACE).astype(np.int64)
        self._pieces(valid, anchor, grams, offsets)
        pair = words.mixed(self.doc.astype(np.uint64)) ^ self.key
        _, number, times = np.unique(pair, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(times[number] > 1)
        if len(twice):
            count = self.count[twice]
            at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.start[twice], count)
            hashes = _rolling(data, span)[at] ^ words.mixed(np.repeat(self.doc[twice], count).astype(np.uint64))
            _, first, number, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            again = times[number] > 1
            self.here[at[again]] = True
            later = again.copy()
            later[first] = False
            valid[at[later]] = False
            self._pieces(valid, anchor, grams, offsets)

    def _pieces(self, valid: np.ndarray, anchor: np.ndarray, grams: np.ndarray, offsets: np.ndarray) -> None:
        same = np.zeros(len(valid), dtype=bool)
        same[1:] = valid[1:] & valid[:-1] & (anchor[1:] == anchor[:-1])
        self.start = np.flatnonzero(valid & ~same)
        self.count = np.add.reduceat(valid, self.start, dtype=np.int64) if len(self.start) else self.start
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        self.key = grams[anchor[self.start]]
        self.anchor = anchor[self.start] - self.start


def _slices(column: pa.Array, span: int, gram: int):
    data, offsets = words.text_bytes(column)
    for i, j in words.slices(offsets, 2 << 20):
        own, cut = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        yield i, own, cut, Windows(own, cut, span, gram)


def _keys(span: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, cut, windows in _slices(batch.column(2), span, gram):
                doc = pa.array(windows.doc + i)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(doc),
                        batch.column(1).take(doc),
                        pa.array(windows.key.view(np.int64)),
                        pa.array(windows.start - cut[windows.doc]),
                    ],
                    names=["text_a", "text_b", "bucket", "start"],
                )

    return find


_PIECE = "text_a long, text_b long, bucket long, start long, count long, anchor long, piece binary, here array<long>"


def _cut_pieces(span: int, gram: int):
    """The pieces in the given buckets; and, in a row without a bucket, runs of windows that repeat in their own text."""
    schema = pa.schema(
        [(c, pa.int64()) for c in ("text_a", "text_b", "bucket", "start", "count", "anchor")]
        + [("piece", pa.binary()), ("here", pa.list_(pa.int64()))]
    )

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for i, own, cut, windows in _slices(batch.column(2), span, gram):
                raw, out = own.tobytes(), []
                for d in range(len(cut) - 1):
                    wanted = batch.column(3)[i + d].as_py()
                    low, high = np.searchsorted(windows.doc, [d, d + 1])
                    keys = windows.key[low:high].view(np.int64)
                    for k in np.flatnonzero(np.isin(keys, np.array(wanted or [], np.int64))).tolist():
                        start, count = int(windows.start[low + k]), int(windows.count[low + k])
                        place = (start - int(cut[d]), count, int(windows.anchor[low + k]))
                        out.append((a[i + d], b[i + d], int(keys[k]), *place, raw[start : start + count + span - 1], None))
                    runs = _runs(windows.here[cut[d] : cut[d + 1]])
                    if len(runs):
                        out.append((a[i + d], b[i + d], None, 0, 0, 0, None, runs.ravel().tolist()))
                columns = zip(*out) if out else [[]] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return cut_out


def _runs(flags: np.ndarray) -> np.ndarray:
    """Rows (first, end) of the runs of true flags."""
    padded = np.concatenate([[False], flags, [False]]).astype(np.int8)
    change = np.diff(padded)
    return np.stack([np.flatnonzero(change == 1), np.flatnonzero(change == -1)], axis=1)


class RunLengthIndex:
    """Runs of the Burrows-Wheeler transform of several texts, with samples at both ends of each run."""

    def __init__(self, texts: list[bytes]):
        joined = b"".join(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes + 1) - 1
        symbols = np.zeros(len(joined) + len(texts), np.int64)  # 0 closes a text; each one sorts by its place
        inside = np.ones(len(symbols), dtype=bool)
        inside[ends] = False
        symbols[inside] = np.frombuffer(joined, np.uint8).astype(np.int64) + 1
        self.size = len(symbols)
        self.left = np.repeat(ends, sizes + 1) - np.arange(self.size)  # bytes up to the end of the own text
        order = self._sorted(symbols)
        before = symbols[order - 1]
        before[order == 0] = 0
        head = np.ones(self.size, dtype=bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        self.heads = np.flatnonzero(head)
        self.symbols = before[self.heads]
        tails = np.append(self.heads[1:], self.size) - 1
        up, down = self.heads[self.heads > 0], tails[tails < self.size - 1]
        hashes = self._sums(symbols)
        self.head_at, self.head_agree = self._with_rest(order, self.heads, up, self._agree(hashes, order[up], order[up - 1]))
        self.tail_at, self.tail_agree = self._with_rest(order, tails, down, self._agree(hashes, order[down], order[down + 1]))

    @staticmethod
    def _with_rest(order, rows, compared, agree) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the sampled rows in text order, with agreement 0 where there is no row to compare."""
        value = np.zeros(len(rows), np.int64)
        value[np.isin(rows, compared, assume_unique=True)] = agree
        sort = np.argsort(order[rows])
        return order[rows][sort], value[sort]

    def _sorted(self, symbols: np.ndarray) -> np.ndarray:
        """Suffixes in order, each up to the end of its text, equal ones by place; only unsettled ones are sorted on."""
        n, depth = self.size, 6
        key, padded = np.zeros(n, np.int64), np.concatenate([symbols, np.zeros(depth, np.int64)])
        live = np.ones(n, dtype=bool)
        for k in range(depth):
            key = (key << 9) + np.where(live, padded[k : k + n], 0)
            live &= padded[k : k + n] > 0
        at = np.argsort(key)
        rank = np.empty(n, np.int64)
        ordered = key[at]
        slot = np.arange(n)
        while True:
            new = np.ones(len(at), dtype=bool)
            new[1:] = ordered[1:] != ordered[:-1]
            opens = np.flatnonzero(new)
            size = np.diff(np.append(opens, len(at)))
            rank[at] = np.repeat(slot[opens], size)
            at = at[np.repeat(size > 1, size)]
            if not len(at) or depth > self.left.max():
                break
            behind = np.where(self.left[at] > depth, rank[np.minimum(at + depth, n - 1)] + 1, 0)
            key = rank[at] * (n + 1) + behind
            by = np.argsort(key)
            at, ordered = at[by], key[by]
            own = ordered // (n + 1)
            first = np.ones(len(at), dtype=bool)
            first[1:] = own[1:] != own[:-1]
            opens = np.flatnonzero(first)
            size = np.diff(np.append(opens, len(at)))
            slot = own + np.arange(len(at)) - np.repeat(opens, size)
            depth *= 2
        return np.argsort(rank, kind="stable")

    @staticmethod
    def _sums(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        powers, inverses = words._powers(len(symbols))
        value = np.random.default_rng(17).integers(1, 1 << 63, 257, dtype=np.uint64) | np.uint64(1)
        return np.concatenate([[np.uint64(0)], np.cumsum(value[symbols] * powers[: len(symbols)])]), inverses

    def _agree(self, hashes, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Bytes in which the suffixes at p and q agree, by binary search over hashes."""
        sums, inverses = hashes
        low, high = np.zeros(len(p), np.int64), np.minimum(self.left[p], self.left[q])
        while len(p) and (low < high).any():
            mid = (low + high + 1) >> 1
            same = (sums[p + mid] - sums[p]) * inverses[p] == (sums[q + mid] - sums[q]) * inverses[q]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def matching_statistics(self) -> np.ndarray:
        """For every position, in how many bytes it agrees with some other position; from the samples alone."""
        place, out = np.arange(self.size), np.zeros(self.size, np.int64)
        for at, agree in ((self.head_at, self.head_agree), (self.tail_at, self.tail_agree)):
            k = np.searchsorted(at, place, side="right") - 1
            out = np.maximum(out, np.where(k >= 0, agree[k] - (place - at[k]), 0))
        return out


_FOUND = "piece_a long, piece_b long, runs array<long>"


def _met(buckets: np.ndarray, anchors: np.ndarray, pieces: list[bytes], span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of the part of each piece whose windows can repeat in another piece of its bucket.

    The windows that have the gram ``low`` to ``high`` bytes behind their start hold all bytes from ``low`` before it to
    ``span - high`` behind. Where no other piece of the bucket reads the same there, none of them repeats.
    """
    sizes = np.array([len(piece) for piece in pieces], np.int64)
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(pieces), np.uint8)
    powers, inverses = words._powers(len(data))
    table = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(table[data] * powers[: len(data)])])
    least, most = anchors - (sizes - span), anchors
    first, end = sizes.copy(), np.zeros(len(sizes), np.int64)
    step = -(-(span - gram + 1) // PARTS)
    for low in range(0, span - gram + 1, step):
        high = min(low + step, span - gram + 1) - 1
        own = np.flatnonzero((least <= high) & (most >= low))
        at = begins[own] + anchors[own]
        read = words.mixed((sums[at - high + span] - sums[at - low]) * inverses[at - low])
        _, number, times = np.unique(
            read ^ words.mixed(buckets[own].view(np.uint64)), return_inverse=True, return_counts=True
        )
        met = own[times[number] > 1]
        first[met] = np.minimum(first[met], anchors[met] - np.minimum(high, most[met]))
        end[met] = np.maximum(end[met], anchors[met] - np.maximum(low, least[met]) + span)
    return first, end


def _index_buckets(span: int, shard_bytes: int, gram: int):
    """Runs of repeated windows in each distinct piece; the pieces of a bucket come together, in order of the bucket."""

    def settle(shard: list[tuple]) -> pa.RecordBatch:
        parts: dict[bytes, list[tuple[int, int, int]]] = {}
        if shard:
            buckets, _, _, anchors, pieces = zip(*shard)
            first, end = _met(np.array(buckets, np.int64), np.array(anchors, np.int64), list(pieces), span, gram)
            for (_, a, b, _, piece), i, j in zip(shard, first.tolist(), end.tolist()):
                if i < j:
                    parts.setdefault(piece[i:j], []).append((a, b, i))
        agree = RunLengthIndex(list(parts)).matching_statistics() if parts else np.zeros(0)
        ids_a, ids_b, runs, at = [], [], [], 0
        for part, owners in parts.items():
            found = _runs(agree[at : at + len(part)] >= span)
            if len(owners) > 1:
                found = np.array([[0, len(part) - span + 1]])
            at += len(part) + 1
            if len(found):
                for a, b, i in owners:
                    ids_a.append(a)
                    ids_b.append(b)
                    runs.append((found + i).ravel().tolist())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids_a, pa.int64()), pa.array(ids_b, pa.int64()), pa.array(runs, pa.list_(pa.int64()))],
            names=["piece_a", "piece_b", "runs"],
        )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size, last = [], 0, None
        for batch in batches:
            for bucket, a, b, anchor, piece in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if size >= shard_bytes and bucket != last:
                    yield settle(shard)
                    shard, size = [], 0
                shard.append((bucket, a, b, anchor, piece))
                size, last = size + len(piece), bucket
        yield settle(shard)

    return index


def _hash_windows(span: int):
    names = ["piece_a", "piece_b", "place", "window_a", "window_b"]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, piece in zip(*(batch.column(c).to_pylist() for c in range(3))):
                own = np.frombuffer(piece, np.uint8)
                one, two = _rolling(own, span), _rolling(own[::-1], span)[::-1]
                n = len(one)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, v)) for v in (a, b)] + [pa.array(np.arange(n)), pa.array(one.view(np.int64)), pa.array(np.ascontiguousarray(two).view(np.int64))],
                    names=names,
                )

    return windows


def _covered(runs: list[int], span: int) -> list[tuple[int, int]]:
    """Merged byte spans of runs (first, end, first, end, ...) of windows."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(zip(runs[::2], runs[1::2])):
        stop = end + span - 1
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((first, stop))
    return out


def _remove(span: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept = [], [], []
            for text, runs in zip(batch.column(2), batch.column(3), strict=True):
                raw, at, parts = (text.as_py() or "").encode(), 0, []
                found = _covered(runs.as_py(), span)
                for first, stop in found:
                    parts.append(raw[at:first])
                    at = stop
                parts.append(raw[at:])
                kept.append(b"".join(parts))
                removed.append(len(raw) - len(kept[-1]))
                spans.append([{"start": s, "end": e} for s, e in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                ],
                names=["text_a", "text_b", "n_removed", "spans", "kept_sha256"],
            )

    return remove


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (bytes to remove, in order) and kept_sha256 of every document.

    Texts are UTF-8 bytes, null counts as empty, matches never cross documents. Texts shorter than ``span`` stay whole.
    Of rows with the same text every byte goes if it is ``span`` bytes long or longer; rows are told apart by position
    only, so null or repeated ids do no harm. An empty table gives an empty result; other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_a"), F.xxhash64(F.lit(17), "text").alias("text_b"), "text"
    )
    each = stored(
        rows.select(
            "doc_id", "text_a", "text_b", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole")
        ),
        "texts",
    )
    ident = ["text_a", "text_b"]
    long = rows.filter(F.octet_length("text") >= span).select(*ident, "text")
    keys = stored(long.mapInArrow(_keys(span, gram), "text_a long, text_b long, bucket long, start long"), "keys", TEXT_BATCH)
    where = F.struct(*ident, "start")
    shared = keys.groupBy("bucket").agg(F.min(where).alias("low"), F.max(where).alias("high")).filter("low < high")
    wanted = keys.join(shared.select("bucket"), "bucket").groupBy(*ident).agg(F.collect_set("bucket").alias("buckets"))
    # A text with repeats of its own must be cut even if nothing else shares its buckets: it has windows left out.
    pieces = stored(
        long.groupBy(*ident).agg(F.first("text").alias("text")).join(wanted, ident, "left")
        .mapInArrow(_cut_pieces(span, gram), _PIECE)
        .withColumn("piece_a", F.xxhash64("piece"))
        .withColumn("piece_b", F.xxhash64(F.lit(19), "piece")),
        "pieces",
        TEXT_BATCH,
    )
    own = ["piece_a", "piece_b"]
    cut = pieces.filter("bucket IS NOT NULL")
    distinct = stored(
        cut.groupBy("bucket", *own).agg(F.first("piece").alias("piece"), F.count("*").alias("times"), F.max("count").alias("count"), F.max("anchor").alias("anchor")),
        "distinct",
    )
    # Buckets with one distinct piece have nothing to compare: it repeats as a whole or not at all.
    sizes = distinct.groupBy("bucket").agg(F.count("*").alias("pieces"), F.sum(F.octet_length("piece")).alias("bytes")).filter("pieces > 1")
    varied = distinct.join(sizes, "bucket").select("bucket", *own, "anchor", "piece", "bytes")
    indexed = (
        varied.filter(F.col("bytes") <= bucket_bytes)
        .select("bucket", *own, "anchor", "piece")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_index_buckets(span, shard_bytes, gram), _FOUND)
    )
    counted = (
        varied.filter(F.col("bytes") > bucket_bytes)
        .select(*own, "piece")
        .mapInArrow(_hash_windows(span), "piece_a long, piece_b long, place long, window_a long, window_b long")
    )
    twice = counted.groupBy("window_a", "window_b").count().filter("count > 1").select("window_a", "window_b")
    counted = counted.join(twice, ["window_a", "window_b"]).select(*own, F.array("place", F.col("place") + 1).alias("runs"))
    whole = distinct.filter("times > 1").select(*own, F.array(F.lit(0).cast("long"), "count").alias("runs"))
    found = indexed.unionByName(whole)
    if not sizes.filter(F.col("bytes") > bucket_bytes).isEmpty():
        found = found.unionByName(counted)
    found = stored(found, "found", TEXT_BATCH)
    placed = cut.join(found, own).select(
        *ident, F.transform("runs", lambda x: x + F.col("start")).alias("runs")
    )
    here = pieces.filter("here IS NOT NULL").select(*ident, F.col("here").alias("runs"))
    marks = stored(
        placed.unionByName(here).groupBy(*ident).agg(F.flatten(F.collect_list("runs")).alias("runs")), "marks"
    )
    size = marks.agg(F.count("*"), F.sum(F.size("runs"))).first()
    marked = rows.select(*ident, "text").join(sent_if_small(marks, 1, 48 * size[0] + 8 * (size[1] or 0)), ident)
    removed = marked.mapInArrow(
        _remove(span),
        "text_a long, text_b long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string",
    ).dropDuplicates(ident)
    copies = each.groupBy(*ident).agg(F.count("*").alias("copies"))
    all_gone = (F.col("copies") > 1) & (F.col("n_bytes") >= span)
    whole_span = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return (
        each.join(copies, ident)
        .join(removed, ident, "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(all_gone, whole_span).otherwise(F.coalesce("spans", F.array().cast(removed.schema["spans"].dataType))).alias("spans"),
            F.when(all_gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
        )
    )
