"""Line dedup: lines that many documents share go; documents get keep bitmaps, not texts.

Keys of lines (128 bits) are range-partitioned by key, document and position and sorted in that order, so a partition
streams the occurrences of a key one after another, the first one first, and holds no more of them than documents are
needed to decide. As the ranges are cut by all three, a key with a third of all lines lies in many partitions. Keys at the
two ends of a partition are left open there and settled from the counts of all partitions: they are two a partition
at most, however many lines they have.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torqline.llm import words
from torqline.llm.common import sent_if_small, stored

MIN_DOCUMENTS = 10
MIN_CHARS = 1
_KEY = ["key_a", "key_b"]
_OUT_ROWS = 1 << 16


def _line_keys(min_chars: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_row", "doc_id", "pos", *_KEY]
        for batch in batches:
            data, offsets = words.text_bytes(batch.column(2))
            for i, j in words.slices(offsets):
                at, pos, digests = [], [], []
                for d in range(i, j):
                    for k, line in enumerate(data[offsets[d] : offsets[d + 1]].tobytes().split(b"\n")):
                        line = line.strip(b" \t\n\v\f\r").lower()
                        if len(line) >= 4 * min_chars or len(line.decode()) >= min_chars:
                            at.append(d)
                            pos.append(k)
                            digests.append(hashlib.blake2b(line, digest_size=16).digest())
                key = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                rows = pa.array(at, pa.int64())
                columns = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(pos, pa.int64())]
                whole = pa.RecordBatch.from_arrays([*columns, pa.array(key[:, 0]), pa.array(key[:, 1])], names=names)
                for k in range(0, whole.num_rows, _OUT_ROWS):
                    yield whole.slice(k, _OUT_ROWS)

    return cut


def _shared(min_docs: int):
    """Of sorted lines: those of keys in ``min_docs`` documents, and all of the first and the last key, marked open.

    ``lead`` marks the first line of a key here.
    """
    names = [*_KEY, "doc_id", "_row", "pos", "open", "lead"]

    def batch_of(columns: np.ndarray, keep: np.ndarray, is_open: np.ndarray, lead: np.ndarray) -> pa.RecordBatch:
        key_a, key_b, doc, no_doc, row, pos = (c[keep] for c in columns)
        arrays = [pa.array(key_a), pa.array(key_b), pa.array(doc, mask=no_doc.astype(bool)), pa.array(row), pa.array(pos)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(is_open[keep]), pa.array(lead[keep])], names=names)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = last_row = None  # of the last line seen
        docs = 0  # documents of that key so far
        opening = False  # that key is the first of the partition
        held: list[np.ndarray] = []  # its lines, while it is not decided
        for batch in batches:
            if not batch.num_rows:
                continue
            doc = batch.column(1)
            columns = np.stack(
                [
                    batch.column(3).to_numpy(),
                    batch.column(4).to_numpy(),
                    doc.fill_null(0).to_numpy(),
                    doc.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
                    batch.column(0).to_numpy(),
                    batch.column(2).to_numpy(),
                ]
            )
            goes_on = key == (columns[0, 0], columns[1, 0])
            new = np.ones(batch.num_rows, bool)
            new[1:] = (columns[:2, 1:] != columns[:2, :-1]).any(axis=0)
            new[0] = not goes_on
            new_doc = new.copy()
            new_doc[1:] |= columns[4, 1:] != columns[4, :-1]
            new_doc[0] |= last_row != columns[4, 0]
            # Number 0 is the key of the batch before, if it goes on here.
            number = np.cumsum(new)
            counts = np.bincount(number, new_doc)
            if goes_on:
                counts[0] += docs
            shared = counts[number] >= min_docs
            is_open = number == (1 if key is None else 0 if opening else -1)
            if held and goes_on and counts[0] >= min_docs:
                before = np.concatenate(held, axis=1)
                lead = np.arange(before.shape[1]) == 0
                yield batch_of(before, np.ones_like(lead), np.zeros_like(lead), lead)
                held = []
            if number[-1] > 0:
                held = []
            yield batch_of(columns, is_open | shared, is_open, new)
            opening = bool(is_open[-1])
            if not opening and not shared[-1]:
                held.append(columns[:, number == number[-1]])
            key, last_row, docs = (columns[0, -1], columns[1, -1]), columns[4, -1], counts[-1]
        if held:
            before = np.concatenate(held, axis=1)
            every = np.ones(before.shape[1], bool)
            yield batch_of(before, every, every, ~every)

    return stream


def pack_runs(dropped: np.ndarray) -> bytes:
    """A keep bitmap from the sorted positions of dropped lines: lengths of runs, kept and dropped in turn, kept first.

    Lengths are 7 bits a byte, low bits first, with the high bit on all but the last byte. Lines behind the last run stay.
    """
    gaps = np.flatnonzero(np.diff(dropped) > 1)
    low = dropped[np.concatenate([[0], gaps + 1])]
    high = dropped[np.concatenate([gaps, [len(dropped) - 1]])] + 1
    out = bytearray()
    for n in np.diff(np.stack([low, high], axis=1).ravel(), prepend=0).tolist():
        while n >= 128:
            out.append(n & 127 | 128)
            n >>= 7
        out.append(n)
    return bytes(out)


def dropped_runs(bitmap: bytes) -> list[tuple[int, int]]:
    """First line and end of each run of dropped lines of a keep bitmap."""
    edges, at, n, shift = [], 0, 0, 0
    for byte in bitmap:
        n |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            at += n
            edges.append(at)
            n = shift = 0
    return list(zip(edges[::2], edges[1::2]))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone = [np.sort(np.array(x, np.int64)) for x in batch.column(1).to_pylist()]
        keep = pa.array([pack_runs(x) for x in gone], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), keep, pa.array([len(x) for x in gone], pa.int64())], names=["_row", "keep", "n_dropped"]
        )


def keep_bitmaps(rows: DataFrame, min_docs: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS, keep_first: bool = False) -> DataFrame:
    """_row, keep (a bitmap, see ``pack_runs``) and n_dropped of the documents that lose lines.

    ``rows`` has _row (not null, another one for every document), doc_id and text. With ``keep_first`` the first line
    of each key, by doc_id (null first), _row and position, stays.
    """
    lines = rows.select("_row", "doc_id", "text").mapInArrow(
        _line_keys(min_chars), "_row long, doc_id long, pos long, key_a long, key_b long"
    )
    order = [*_KEY, "doc_id", "_row", "pos"]
    schema = "key_a long, key_b long, doc_id long, _row long, pos long, open boolean, lead boolean"
    dealt = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored(dealt.mapInArrow(_shared(min_docs), schema), "shared-lines")
    ends = found.filter("open").select(*_KEY).distinct()  # two a partition at most
    ends = sent_if_small(ends, ends.count(), 40)
    whole = (
        found.join(ends, _KEY)
        .groupBy(*_KEY)
        .agg(F.count_distinct("_row").alias("docs"), F.min(F.struct("doc_id", "_row", "pos")).alias("first"))
        .filter(F.col("docs") >= min_docs)
    )
    whole = stored(whole, "open-keys")
    is_first = F.struct("doc_id", "_row", "pos") == F.col("first")
    settled = found.filter("open").join(sent_if_small(whole, whole.count(), 80), _KEY)
    inside = found.filter("NOT open")
    if keep_first:
        settled, inside = settled.filter(~is_first), inside.filter("NOT lead")
    dropped = inside.select("_row", "pos").unionByName(settled.select("_row", "pos"))
    lists = dropped.groupBy("_row").agg(F.collect_list("pos").alias("lost"))
    return lists.mapInArrow(_bitmaps, "_row long, keep binary, n_dropped long")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines, kept = [], []
        for text, keep in zip(batch.column(1).cast(pa.large_binary()).to_pylist(), batch.column(2).to_pylist()):
            text = text or b""
            n_lines.append(text.count(b"\n") + 1)
            if keep is not None:
                lines, parts, at = text.split(b"\n"), [], 0
                for first, end in dropped_runs(keep):
                    parts += lines[at:first]
                    at = end
                text = b"\n".join(parts + lines[at:])
            kept.append(text)
        texts = pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_lines, pa.int64()), batch.column(3), batch.column(2), texts],
            names=["doc_id", "n_lines", "n_dropped", "keep", "kept"],
        )


def without_shared_lines(
    docs: DataFrame, min_docs: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS, keep_first: bool = False
) -> DataFrame:
    """doc_id, n_lines, n_dropped, keep (null if no line goes) and kept, the text of the other lines, of every document.

    Lines end at a line feed. Their key is the line without white space at both ends, A-Z as a-z; keys of at least
    ``min_chars`` characters found in at least ``min_docs`` documents lose all their lines (all but the first of all
    with ``keep_first``). Every row is a document, repeated rows and rows without an id too. Null and empty texts have
    one empty line; an empty key is dropped only if ``min_chars`` is 0. A document all of whose lines go keeps an empty
    text. Other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    bitmaps = stored(keep_bitmaps(rows, min_docs, min_chars, keep_first), "bitmaps")
    size = bitmaps.agg(F.count("*").alias("n"), F.max(F.octet_length("keep")).alias("most")).first()
    small = sent_if_small(bitmaps, size["n"], 32 + (size["most"] or 0))
    each = rows.join(small, "_row", "left").select("doc_id", "text", "keep", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"))
    return each.mapInArrow(_kept, "doc_id long, n_lines long, n_dropped long, keep binary, kept string")
