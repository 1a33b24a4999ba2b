"""Token ids in length-delimited binary records with masked checksums, and an offset index beside each file.

A record is its payload's length (8 bytes), the masked CRC-32C of those 8 bytes,
the payload, and the masked CRC-32C of the payload, all little-endian: the layout
that TFRecord readers know. The payload is a document's ids as unsigned integers
of 16 bits where the vocabulary has no id above 65,535, else of 32 bits. The index
is a Parquet file with one row per record and the bytes of an id, so that a
shuffled read seeks to the records it wants and no other.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.llm.common import file_system, publish
from gleaner.llm.tokens import encoder, vocabulary_path
from gleaner.session import scratch_dir

END_ID = 2
WORD_BPE = "word_bpe_49k.json"
#: Fixed values of the record layout: the reflected CRC-32C polynomial and the mask.
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8
LANE = 512
FRAME = 16
#: A file is closed once it holds this many payload bytes.
FILE_BYTES = 32 << 20
#: Records that a shuffled read fetches at once.
SEEKS = 1024


@cache
def _table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(POLYNOMIAL) * (table & np.uint32(1)))
    return table


@cache
def _pair_table() -> np.ndarray:
    """As ``_table``, for two bytes at a time."""
    pairs = np.arange(1 << 16, dtype=np.uint32)
    first = _table()[pairs & np.uint32(255)]
    return (first >> np.uint32(8)) ^ _table()[(first ^ (pairs >> np.uint32(8))) & np.uint32(255)]


@cache
def _past_lane() -> np.ndarray:
    """Four tables of 256: what a checksum becomes after LANE zero bytes, by its bytes."""
    values = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).ravel()
    for _ in range(LANE):
        values = (values >> np.uint32(8)) ^ _table()[values & np.uint32(255)]
    return values.reshape(4, 256)


def crc32c(payloads: list[bytes]) -> np.ndarray:
    """CRC-32C of each byte string, all in step.

    Zero bytes in front leave a checksum that starts at zero as it is, and the
    usual start value acts like inverting the first four bytes. So the strings are
    padded in front to whole lanes, all lanes advance together two bytes a step, and
    a string's lanes are then joined from left to right. Strings of under four bytes
    advance alone.
    """
    lengths = np.array([len(p) for p in payloads], np.int64)
    lanes = -(-lengths // LANE)
    ends = np.cumsum(lanes)
    block = np.zeros((int(ends[-1]) if len(ends) else 0, LANE), np.uint8)
    flat = block.reshape(-1)
    for payload, end, length in zip(payloads, ends * LANE, lengths, strict=True):
        if length >= 4:
            flat[end - length : end] = np.frombuffer(payload, np.uint8)
            flat[end - length : end - length + 4] ^= 255
    state = np.zeros(len(block), np.uint32)
    table = _pair_table()
    for column in np.ascontiguousarray(block.view("<u2").T):
        state = (state >> np.uint32(16)) ^ table[(state ^ column) & np.uint32(0xFFFF)]
    past = _past_lane()
    total = np.zeros(len(payloads), np.uint32)
    order = np.argsort(-lanes, kind="stable")
    deepest = lanes[order]
    first = (ends - lanes)[order]
    for lane in range(int(deepest[0]) if len(deepest) else 0):
        open_ = order[: np.searchsorted(-deepest, -lane)]
        t = total[open_]
        t = past[0][t & 255] ^ past[1][t >> 8 & 255] ^ past[2][t >> 16 & 255] ^ past[3][t >> 24]
        total[open_] = t ^ state[first[: len(open_)] + lane]
    for k in np.flatnonzero(lengths < 4):
        alone = 0xFFFFFFFF
        for byte in payloads[k]:
            alone = alone >> 8 ^ int(_table()[(alone ^ byte) & 255])
        total[k] = alone
    return total ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK)


def frames(payloads: list[bytes]) -> Iterator[bytes]:
    """The record of each payload."""
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    for head, payload, a, b in zip(heads, payloads, masked(crc32c(heads)), masked(crc32c(payloads)), strict=True):
        yield b"%b%b%b%b" % (head, struct.pack("<I", a), payload, struct.pack("<I", b))


def unframed(data: bytes, offsets: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """The payloads of records at ``offsets`` of ``data``; raises where a length or a checksum is wrong."""
    heads = [data[o : o + 8] for o in offsets.tolist()]
    payloads = [data[o + 12 : o + 12 + n] for o, n in zip(offsets.tolist(), lengths.tolist(), strict=True)]
    sums = np.array([struct.unpack_from("<I", data, o + 8)[0] for o in offsets.tolist()], np.uint32)
    ends = np.array(
        [struct.unpack_from("<I", data, o + 12 + n)[0] for o, n in zip(offsets.tolist(), lengths.tolist(), strict=True)], np.uint32
    )
    stated = np.array([struct.unpack("<Q", h)[0] for h in heads], np.int64)
    if (stated != lengths).any() or (masked(crc32c(heads)) != sums).any() or (masked(crc32c(payloads)) != ends).any():
        raise ValueError("a record's length or checksum does not match")
    return payloads


def write_records(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encodes every text, ends it with ``end_id`` and writes records in ascending doc_id order.

    Returns one row per file: part, file_no, path, index_path, n_records,
    n_tokens. Rows ordered by (part, file_no) hold ascending doc_ids; null doc_ids
    come first, and rows with equal doc_id stand in the order of their texts. A
    null text is an empty one. An empty table gives no file. The rows of this
    table come from the writing itself: materialise it, so as to write once.
    """
    path = path or vocabulary_path(WORD_BPE)
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode, width = encoder(path).encode, 2 if max(encoder(path).largest_id, end_id) < 1 << 16 else 4
        end = np.array([end_id], f"<u{width}").tobytes()
        rows, ids, size, number = [], [], 0, 0
        for batch in batches:
            kind = batch.schema.field(0).type
            for k, own in enumerate(encode(x.as_py() for x in batch.column(1))):
                rows.append(batch.column(0)[k].as_py())
                ids.append(np.frombuffer(own, "<u4").astype(f"<u{width}").tobytes() + end)
                size += len(ids[-1])
                if size >= FILE_BYTES:
                    yield _file(folder, part, number, rows, ids, kind, width)
                    rows, ids, size, number = [], [], 0, number + 1
        if rows:
            yield _file(folder, part, number, rows, ids, kind, width)

    # Texts are dealt out before they are encoded: finding the ranges runs what comes before it once more.
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return ordered.mapInArrow(
        written, "part int, file_no int, path string, index_path string, n_records long, n_tokens long"
    )


def _file(folder: str, part: int, number: int, docs: list, ids: list[bytes], kind: pa.DataType, width: int) -> pa.RecordBatch:
    name = f"{folder}/part-{part:06d}-{number:06d}"
    sizes = np.array([len(i) for i in ids], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes + FRAME)[:-1]])

    def records(stream):
        for at in range(0, len(ids), 1024):
            stream.write(b"".join(frames(ids[at : at + 1024])))

    table = pa.table({"doc_id": pa.array(docs, kind), "offset": offsets, "length": sizes, "id_bytes": np.full(len(ids), width, np.int32)})
    publish(f"{name}.records", records)
    publish(f"{name}.index", lambda stream: pq.write_table(table, stream))
    total = int(sizes.sum()) // width
    return pa.RecordBatch.from_pylist(
        [{"part": part, "file_no": number, "path": f"{name}.records", "index_path": f"{name}.index", "n_records": len(ids), "n_tokens": total}],
        pa.schema([("part", pa.int32()), ("file_no", pa.int32()), ("path", pa.string()), ("index_path", pa.string()), ("n_records", pa.int64()), ("n_tokens", pa.int64())]),
    )


def read_records(files: DataFrame, id_type: str = "long", keep_ids: bool = True) -> DataFrame:
    """One row per record of ``files`` (write_records' rows): part, file_no, position, doc_id, n_tokens, ids_crc32[, ids].

    Seeks by the index, some megabytes at a time, and checks every length and
    checksum. ``position`` is the record's number in its file; ``ids`` and the
    checksum ``ids_crc32`` are of unsigned 32-bit ids, whatever the file's width.
    """
    schema = f"part int, file_no int, position long, doc_id {id_type}, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = file_system(row["path"])
                _, index_path = file_system(row["index_path"])
                with store.open_input_file(index_path) as f:
                    index = pq.read_table(f)
                offsets = index["offset"].to_numpy()
                lengths = index["length"].to_numpy()
                width = index["id_bytes"][0].as_py()  # a file has a record at least
                with store.open_input_file(path) as f:
                    low = 0
                    while low < len(offsets):
                        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + (4 << 20))))
                        stop = int(offsets[high - 1] + lengths[high - 1] + FRAME)
                        data = f.read_at(stop - int(offsets[low]), int(offsets[low]))
                        stored = unframed(data, offsets[low:high] - offsets[low], lengths[low:high])
                        ids = [np.frombuffer(i, f"<u{width}").astype("<u4").tobytes() for i in stored]
                        n = high - low
                        columns = [
                            pa.array(np.full(n, row["part"], np.int32)),
                            pa.array(np.full(n, row["file_no"], np.int32)),
                            pa.array(np.arange(low, high, dtype=np.int64)),
                            index["doc_id"].slice(low, n).combine_chunks(),
                            pa.array(lengths[low:high] // width),
                            pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                            *([pa.array(ids, pa.binary())] if keep_ids else []),
                        ]
                        yield pa.RecordBatch.from_arrays(
                            columns, names=["part", "file_no", "position", "doc_id", "n_tokens", "ids_crc32", "ids"][: 6 + keep_ids]
                        )
                        low = high

    return files.select("part", "file_no", "path", "index_path").mapInArrow(read, schema)


def index_rows(files: DataFrame, id_type: str = "long") -> DataFrame:
    """One narrow row per record of ``files``, from the index files alone: part, file_no, position, path, offset, length, width, doc_id."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = file_system(row["index_path"])
                with store.open_input_file(path) as f:
                    index = pq.read_table(f)
                n = len(index)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["part"], np.int32)), pa.array(np.full(n, row["file_no"], np.int32)),
                        pa.array(np.arange(n)), pa.array([row["path"]] * n, pa.string()),
                        *(index[c].combine_chunks() for c in ("offset", "length", "id_bytes", "doc_id")),
                    ],
                    names=["part", "file_no", "position", "path", "offset", "length", "width", "doc_id"],
                )

    schema = f"part int, file_no int, position long, path string, offset long, length long, width int, doc_id {id_type}"
    return files.select("part", "file_no", "path", "index_path").mapInArrow(read, schema)


def shuffled_records(files: DataFrame, seed: int = 0, parts: int | None = None, id_type: str = "long") -> DataFrame:
    """All records once, in an order that the seed alone decides: turn, part, file_no, position, doc_id, ids.

    Index rows are dealt to tasks and ordered by a hash of the seed and the record's
    place; each task then seeks to its records and to no other. Rows ordered by
    (turn, part, file_no, position) stand in the shuffled order; ``turn`` rises within a task.
    """
    parts = parts or max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    place = ["part", "file_no", "position"]
    turned = index_rows(files, id_type).withColumn("turn", F.xxhash64(F.lit(seed), *place))
    dealt = turned.repartition(parts, "turn").sortWithinPartitions("turn", *place)
    return _sought(dealt.select("turn", *place, "path", "offset", "length", "width", "doc_id"), id_type)


def chosen_records(files: DataFrame, chosen: DataFrame, id_type: str = "long") -> DataFrame:
    """The records of ``files`` that ``chosen`` (part, file_no, position) names, in no order: columns as in ``shuffled_records``, turn 0."""
    rows = index_rows(files, id_type).join(chosen.select("part", "file_no", "position").distinct(), ["part", "file_no", "position"])
    columns = [F.lit(0).cast("long").alias("turn"), "part", "file_no", "position", "path", "offset", "length", "width", "doc_id"]
    return _sought(rows.select(*columns), id_type)


def _sought(rows: DataFrame, id_type: str) -> DataFrame:
    """Index rows with the ids of their records; reads of a group go in the order of the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SEEKS):
                some = batch.slice(at, SEEKS)
                paths, offsets, lengths, widths = (some.column(c).to_pylist() for c in ("path", "offset", "length", "width"))
                found: list[bytes] = [b""] * some.num_rows
                order = sorted(range(some.num_rows), key=lambda k: (paths[k], offsets[k]))
                for name, group in itertools.groupby(order, key=lambda k: paths[k]):
                    store, path = file_system(name)
                    with store.open_input_file(path) as f:
                        for k in group:
                            data = f.read_at(lengths[k] + FRAME, offsets[k])
                            own = unframed(data, np.zeros(1, np.int64), np.array([lengths[k]], np.int64))[0]
                            found[k] = np.frombuffer(own, f"<u{widths[k]}").astype("<u4").tobytes()
                kept = ["turn", "part", "file_no", "position", "doc_id"]
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in kept), pa.array(found, pa.binary())], names=[*kept, "ids"])

    return rows.mapInArrow(read, f"turn long, part int, file_no int, position long, doc_id {id_type}, ids binary")


def file_starts(files: DataFrame) -> DataFrame:
    """(part, file_no, base): the ids in all files before; one row per file is all the window holds."""
    before = Window.partitionBy(F.lit(0)).orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("part", "file_no", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))


def token_table(spark: SparkSession, docs: DataFrame, folder: str | None = None, path: str | None = None) -> DataFrame:
    """Writes the records of ``docs`` below ``folder``, reads them back and gives doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all records before, with their end ids. The
    records of a file, a bounded number, are summed up by one task.
    """
    folder = folder or scratch_dir(spark, "records")
    write_records(docs, f"{folder}/data", path).write.parquet(f"{folder}/files")
    files = spark.read.parquet(f"{folder}/files")
    many = files.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "part", "file_no")
    records = read_records(many, docs.schema["doc_id"].dataType.simpleString(), keep_ids=False)
    inside = Window.partitionBy("part", "file_no").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    return (
        records.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(file_starts(files), ["part", "file_no"])
        .select("doc_id", (F.col("base") + F.col("_inside")).alias("start"), "n_tokens", "ids_crc32")
    )
