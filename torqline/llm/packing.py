"""Best-fit packing of token sequences with certified bin counts.

Partitions pack their pieces by best-fit decreasing. Lower bounds from dual feasible functions say how many bins any
packing of a partition needs, and how many the whole table needs. A partition that uses as many bins as its bound is
certified. As long as the bins beyond the bound of the whole are no more than the gaps of partitions, only partitions with
a gap hand over the pieces of their emptiest bins, and certified ones stay as they are. What exceeds those gaps is lost
between partitions, each of which may end in a bin that is nearly empty: then all hand over their emptiest bins. The
pieces meet in new, fewer partitions and are packed again, until the bound of the whole table is met or one partition holds
all that is left. Where a round needs as many bins as before, the pieces stay as they were, and the emptier half of
their bins tries again.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torqline.llm.common import stored
from torqline.llm.tokens import encoder

CAPACITY = 4096
PIECES_PER_PARTITION = 8192
_ROUND_BITS = 56  # a sequence number holds the round above these bits, the partition above 24
_BATCH_PIECES = 4096

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = f"{_PIECES}, seq long, part long, bin long, offset long, room long, gap long"


def lower_bound(histogram: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs; ``histogram[x]`` counts the pieces of length x (0 to capacity).

    The largest bound over two families of dual feasible functions: one rounds pieces above capacity - k up to the
    capacity and those below k down to nothing (k = 0 gives the total length); the other takes
    floor((k + 1) x / capacity) / k, and x / capacity itself where (k + 1) x / capacity is whole.
    """
    count = histogram.astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    pieces = np.concatenate([[0], np.cumsum(count)])
    lengths = np.concatenate([[0], np.cumsum(count * size)])
    k = np.arange(capacity // 2 + 1)
    large = pieces[-1] - pieces[capacity - k + 1]
    middle = lengths[capacity - k + 1] - lengths[k]
    best = int(np.max(large - (-middle // capacity)))
    for k in range(1, 33):
        whole = (k + 1) * size % capacity == 0
        # In units of 1 / (k * capacity), so that sums stay exact.
        value = np.where(whole, k * size, (k + 1) * size // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each piece and the room left in each bin; longest pieces first, each into the fullest bin."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    present = 0  # bit r is set where a bin with room r exists
    for i in order.tolist():
        length = int(lengths[i])
        fitting = present >> length
        if fitting:
            left = (fitting & -fitting).bit_length() - 1 + length
            b = by_room[left].pop()
            if not by_room[left]:
                present &= ~(1 << left)
        else:
            left, b = capacity, len(room)
            room.append(capacity)
        bins[i], offsets[i] = b, capacity - left
        room[b] = left - length
        by_room[room[b]].append(b)
        present |= 1 << room[b]
    return bins, offsets, np.array(room, dtype=np.int64)


def _cutter(tokenizer: str, end_id: int, capacity: int):
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = encoder(tokenizer), struct.pack("<I", end_id)
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * 5
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = ids_of.encode(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((doc_id.as_py(), piece, at // 4, len(part) // 4, zlib.crc32(part)))
                if len(out) >= _BATCH_PIECES:
                    yield flush()
        yield flush()

    return cut


def _packer(capacity: int):
    def pack(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values("seq", ignore_index=True)
        bins, offsets, room = best_fit_decreasing(pieces["length"].to_numpy(), capacity)
        histogram = np.bincount(pieces["length"], minlength=capacity + 1)
        gap = len(room) - lower_bound(histogram, capacity)
        return pieces.assign(bin=bins, offset=offsets, room=room[bins], gap=gap)

    return pack


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    pieces_per_partition: int = PIECES_PER_PARTITION,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Documents are their ids and ``end_id``; only longer ones are cut, at every ``capacity`` ids. Null texts count as
    empty (one id). Rows with the same or no doc_id are documents of their own. An empty table gives an
    empty result. Other columns are not read.

    Only histograms of piece lengths (``capacity`` + 1 counts) and bin counts reach the driver. A partition packs
    ``pieces_per_partition`` pieces on average, dealt out by number, whatever their document.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pool = stored(
        rows.mapInArrow(_cutter(tokenizer, end_id, capacity), _PIECES).withColumn(
            "seq", F.monotonically_increasing_id()
        ),
        "pieces",
    )
    result = pack_pieces(pool, capacity, pieces_per_partition)
    return result.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_pieces(pool: DataFrame, capacity: int, pieces_per_partition: int = PIECES_PER_PARTITION) -> DataFrame:
    """The rows of a stored table of pieces, whose ``seq`` differ, with ``sequence_id`` and ``offset``.

    Lengths are 1 to ``capacity``. A round packs its pieces into fewer bins than they had, or lets the fuller half of
    them stay, so rounds end.
    """
    histogram = np.zeros(capacity + 1, np.int64)
    for row in pool.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    bound = lower_bound(histogram, capacity)
    own = [f.name for f in pool.schema]
    held, settled, used = int(histogram.sum()), [], 0
    previous, gone = None, {}  # how the pieces of the pool lie now, and their bins by room
    for turn in range(1 << (63 - _ROUND_BITS)):
        parts = max(1, math.ceil(held / pieces_per_partition))
        placed = stored(
            pool.withColumn("part", F.pmod(F.xxhash64(F.lit(turn), "seq"), F.lit(parts)))
            .groupBy("part")
            .applyInPandas(_packer(capacity), _PLACED),
            "packed",
        ).withColumn(
            "sequence_id",
            F.shiftleft(F.lit(turn).cast("long"), _ROUND_BITS) + F.shiftleft("part", 24) + F.col("bin"),
        )
        # A bin counts where its first piece lies. Rooms are numbers up to the capacity, so this is a small table.
        first = F.col("offset") == 0
        found = (
            placed.groupBy((F.col("gap") > 0).alias("gapped"), "room")
            .agg(
                F.count_if(first).alias("bins"),
                F.count("*").alias("pieces"),
                F.sum(F.when(first & (F.col("bin") == 0), F.col("gap"))).alias("gap"),
            )
            .collect()
        )
        rooms = {(r["gapped"], r["room"]): (r["bins"], r["pieces"]) for r in found}
        bins = sum(n for n, _ in rooms.values())
        if previous is not None and bins >= sum(n for n, _ in gone.values()):
            # No help: the pieces lie as before, and the emptier half of those bins tries again.
            placed, rooms, bins = previous, gone, sum(n for n, _ in gone.values())
            every, limit = True, _fuller_half(gone)
        else:
            every = used + bins - bound > sum(r["gap"] or 0 for r in found)
            limit = _release_limit(rooms, every)
        gone = {(gapped, room): n for (gapped, room), n in rooms.items() if (every or gapped) and room > limit}
        if parts == 1 or used + bins <= bound or not gone:
            settled.append(placed)
            break
        leaves = (F.col("room") > limit) & (F.lit(every) | (F.col("gap") > 0))
        settled.append(placed.filter(~leaves))
        previous = placed.filter(leaves)
        used += bins - sum(n for n, _ in gone.values())
        pool, held = previous.select(*own), sum(pieces for _, pieces in gone.values())
    else:
        settled.append(previous)
    result = settled[0]
    for more in settled[1:]:
        result = result.unionByName(more)
    return result


_Rooms = dict[tuple[bool, int], tuple[int, int]]  # (bins, pieces) by (whether the partition has a gap, room)


def _fuller_half(rooms: _Rooms) -> int:
    """The room up to which bins hold at least half of the pieces."""
    total, held, limit = sum(pieces for _, pieces in rooms.values()), 0, 0
    for key in sorted(rooms, key=lambda key: key[1]):
        held, limit = held + rooms[key][1], key[1]
        if 2 * held >= total:
            break
    return limit


def _release_limit(rooms: _Rooms, every: bool) -> int:
    """Bins with more room than this are packed again: the emptiest, holding all but a hundredth of the total room.

    Bins of certified partitions count only if ``every`` partition takes part.
    """
    bins: dict[int, int] = {}
    for (gapped, room), (n, _) in rooms.items():
        if every or gapped:
            bins[room] = bins.get(room, 0) + n
    total, kept, limit = sum(room * n for room, n in bins.items()), 0, 0
    for room in sorted(bins):
        kept += room * bins[room]
        if kept > total / 100:
            break
        limit = room
    return limit
