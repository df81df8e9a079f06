"""Token ids in files of length-delimited binary records, with an offset index for shuffled reads.

A record is: payload length (unsigned 64-bit), masked CRC-32 of these 8 bytes (32-bit), payload, masked CRC-32 of the
payload (32-bit); all little-endian. A payload is: a byte 1 if the document has an id, else 0; the id (signed
64-bit); the bytes per token id, 2 or 4 (one byte); the token ids. Beside each data file lies an index of 24-byte
entries, one per record: offset, record length, number of ids (unsigned 64-bit each).

Data files hold the documents in ascending id order, file after file. They are written under a name of the
attempt and moved in place, so a repeated task replaces its file by an equal one.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from torqline.llm.common import shuffle_partitions, stored
from torqline.llm.tokens import encoder
from torqline.session import scratch_path

_HEAD, _BODY, _INDEX = "<QI", "<BqB", "<QQQ"
_HEAD_BYTES, _BODY_BYTES, _INDEX_BYTES = map(struct.calcsize, (_HEAD, _BODY, _INDEX))
_MASK = 0xA282EAD8  # fixed value: keeps the checksum of data that holds checksums apart from its own
_READ_ROWS = 2048
MEMO_PIECES = 1_000_000  # pieces with their ids that a worker remembers here: some 200 bytes each


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """``ids``: little-endian unsigned 32-bit ids; kept in ``width`` bytes each."""
    if width == 2:
        ids = np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes()
    payload = struct.pack(_BODY, doc_id is not None, doc_id or 0, width) + ids
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked_crc(length)) + payload + struct.pack("<I", masked_crc(payload))


def unframe(head: bytes, rest: bytes) -> tuple[int | None, bytes]:
    """(doc_id, little-endian unsigned 32-bit ids) of a record cut after its first 12 bytes."""
    payload, (crc,) = rest[:-4], struct.unpack("<I", rest[-4:])
    if struct.unpack(_HEAD, head)[1] != masked_crc(head[:8]) or crc != masked_crc(payload):
        raise ValueError("a record does not match its checksum")
    known, doc_id, width = struct.unpack_from(_BODY, payload)
    ids = payload[_BODY_BYTES :]
    if width == 2:
        ids = np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes()
    return (doc_id if known else None), ids


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _writer(folder: str, tokenizer: str, end_id: int, width: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(folder)
        part = TaskContext.get().partitionId()
        own = f"{base}/.{part}-{uuid.uuid4().hex}"
        end, ids_of = struct.pack("<I", end_id), encoder(tokenizer, MEMO_PIECES)
        at = records = tokens = 0
        with store.open_output_stream(f"{own}.bin") as data, store.open_output_stream(f"{own}.idx") as index:
            for batch in batches:
                texts = (text.as_py() for text in batch.column(1))
                for doc_id, ids in zip(batch.column(0).to_pylist(), ids_of.encode_all(texts), strict=True):
                    ids += end
                    record = frame(doc_id, ids, width)
                    data.write(record)
                    index.write(struct.pack(_INDEX, at, len(record), len(ids) // 4))
                    at, records, tokens = at + len(record), records + 1, tokens + len(ids) // 4
        for kind in ("bin", "idx"):
            store.move(f"{own}.{kind}", f"{base}/part-{part:06d}.{kind}")
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "records": [records], "tokens": [tokens], "bytes": [at]},
            schema=pa.schema([(n, pa.int64()) for n in ("part", "records", "tokens", "bytes")]),
        )

    return write


def write_records(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
) -> DataFrame:
    """Encodes every whole text, appends ``end_id`` and writes the records; returns the manifest of the files.

    The manifest has ``folder``, ``part``, ``records``, ``tokens``, ``bytes`` and ``first`` (ids in all files before).
    ``folder`` must be new and shared by all executors; without one it lies in the session's shared folder.
    Null texts count as empty (one id, the end). Null ids come first; rows with the same id follow one another in
    the order of a hash of their text. An empty table writes empty files. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "records")
    store, base = _opened(folder)
    store.create_dir(base, recursive=True)
    width = 2 if max(encoder(tokenizer).library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions(
        "doc_id", F.xxhash64("text")
    )
    manifest = stored(
        ordered.mapInArrow(
            _writer(folder, tokenizer, end_id, width), "part long, records long, tokens long, bytes long"
        ),
        "manifest",
    )
    rows, first = [], 0
    for row in sorted(manifest.collect(), key=lambda r: r["part"]):  # one row per file
        rows.append((folder, *row, first))
        first += row["tokens"]
    return spark.createDataFrame(
        rows, "folder string, part long, records long, tokens long, bytes long, first long"
    )


_READ_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )
    for batch in batches:
        for file in batch.to_pylist():
            store, base = _opened(file["folder"])
            start, out, held = file["first"], [], 0
            with store.open_input_stream(f"{base}/part-{file['part']:06d}.bin") as data:
                while head := data.read(_HEAD_BYTES):
                    doc_id, ids = unframe(head, data.read(struct.unpack(_HEAD, head)[0] + 4))
                    out.append((doc_id, start, len(ids) // 4, ids))
                    start, held = start + len(ids) // 4, held + len(ids)
                    if len(out) == _READ_ROWS or held > 1 << 23:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)
                        out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)


def read_records(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (binary), read back with all checksums verified."""
    files = manifest.filter("records > 0")
    n = files.count()
    return files.repartition(max(1, n), "part").mapInArrow(_reader, _READ_SCHEMA)


def _shuffled_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, opened = [], {}
        for entry in batch.to_pylist():
            key = (entry["folder"], entry["part"])
            if key not in opened:
                store, base = _opened(entry["folder"])
                opened[key] = store.open_input_file(f"{base}/part-{entry['part']:06d}.bin")
            opened[key].seek(entry["offset"])
            record = opened[key].read(entry["length"])
            doc_id, ids = unframe(record[: _HEAD_BYTES], record[_HEAD_BYTES :])
            out.append({"doc_id": doc_id, "ids": ids})
        for file in opened.values():
            file.close()
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())]))


def _index_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file in batch.to_pylist():
            store, base = _opened(file["folder"])
            with store.open_input_stream(f"{base}/part-{file['part']:06d}.idx") as data:
                while block := data.read(_INDEX_BYTES << 14):
                    entries = np.frombuffer(block, dtype="<u8").reshape(-1, 3).astype(np.int64)
                    n = len(entries)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file["folder"]] * n), pa.array([file["part"]] * n, pa.int64())]
                        + [pa.array(entries[:, k]) for k in range(3)],
                        names=["folder", "part", "offset", "length", "n_tokens"],
                    )


def read_index(manifest: DataFrame) -> DataFrame:
    """One row per record: folder, part, offset, length, n_tokens; from the index files alone."""
    return manifest.filter("records > 0").mapInArrow(
        _index_reader, "folder string, part long, offset long, length long, n_tokens long"
    )


def read_shuffled(manifest: DataFrame, seed: int) -> DataFrame:
    """doc_id and ids in an order that ``seed`` draws: index entries are shuffled, records fetched by their offset."""
    drawn = read_index(manifest).withColumn("at", F.xxhash64(F.lit(seed), "part", "offset"))
    spread = drawn.repartition(shuffle_partitions(manifest.sparkSession), "at").sortWithinPartitions("at")
    return spread.drop("at").mapInArrow(_shuffled_reader, "doc_id long, ids binary")


def record_digests(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    read = read_records(write_records(docs, tokenizer, end_id))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
