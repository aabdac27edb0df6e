"""Token ids as length-delimited binary records with masked checksums, and an offset index for shuffled reads.

A shard is one file of records in ascending document order, each framed as

    length (u64) | masked CRC-32 of the length (u32) | payload | masked CRC-32 of the payload (u32)

with the payload ``flags (u8) | document id (i64) | ids``. Bit 0 of the flags: the id is null; bit 1: ids take four
bytes instead of two. All numbers are little-endian. The index is a second file with an entry per record,
``offset (u64) | ids (u64)``, so that a reader can fetch any record, in any order, without scanning the shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkassay.llm.common import shuffle_width
from sparkassay.llm.tokens import default_vocabulary, encoder

#: Fixed value: the constant added by the mask, as in other formats with masked checksums.
MASK = 0xA282EAD8
NULL_ID, WIDE = 1, 2
HEAD, FRAME, ENTRY = "<Bq", "<QI", "<QQ"
MANIFEST = "shard int, path string, records long, ids long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17 & 0xFFFFFFFF)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((struct.pack(FRAME, len(payload), masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(data: memoryview, at: int) -> bytes:
    """The payload of the record at ``at``; a wrong checksum or length raises ValueError."""
    size, check = struct.unpack_from(FRAME, data, at)
    if masked(bytes(data[at : at + 8])) != check:
        raise ValueError(f"damaged length at byte {at}")
    payload = bytes(data[at + struct.calcsize(FRAME) : at + struct.calcsize(FRAME) + size])
    if len(payload) != size or masked(payload) != struct.unpack_from("<I", data, at + struct.calcsize(FRAME) + size)[0]:
        raise ValueError(f"damaged record at byte {at}")
    return payload


def to_payload(doc_id: int | None, ids: bytes) -> bytes:
    values = np.frombuffer(ids, "<u4")
    wide = bool(len(values)) and int(values.max()) > 0xFFFF
    flags = (doc_id is None) * NULL_ID | wide * WIDE
    return struct.pack(HEAD, flags, doc_id or 0) + (ids if wide else values.astype("<u2").tobytes())


def from_payload(payload: bytes) -> tuple[int | None, bytes]:
    flags, doc_id = struct.unpack_from(HEAD, payload)
    ids = payload[struct.calcsize(HEAD) :]
    return None if flags & NULL_ID else doc_id, ids if flags & WIDE else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def store(path: str):
    """File system and path inside it; any scheme that pyarrow knows (file, hdfs, s3, gs)."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


def write_records(
    docs: DataFrame, folder: str, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    end_id: int = 0,
) -> DataFrame:
    """Encode every text, append ``end_id``, write shards in ascending id order; returns the manifest of the shards.

    Ranges of ids are dealt to tasks (rows of one id are ordered and dealt by a hash of their text), sorted, and each
    task streams its rows to one shard and its index under names of its own. The manifest (``shard, path, records,
    ids``) is written to ``folder`` after all shards and lists those that count, so a task that runs twice does no
    harm. Memory holds one Arrow batch of texts.

    A null text is an empty one (a record with ``end_id`` alone), a null id sorts first and stays null, repeated rows
    are written once each, an empty table gives an empty manifest. Other columns are not read.
    """
    path = vocabulary or default_vocabulary()
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}"
        records = total = place = 0
        data = index = None
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                if data is None and some.num_rows:
                    files, inside = store(name)
                    data, index = files.open_output_stream(f"{inside}.rec"), files.open_output_stream(f"{inside}.idx")
                texts = [text or "" for text in some.column(1).to_pylist()]
                framed, entries = [], []
                for doc_id, ids in zip(some.column(0).to_pylist(), encoder(path).encode(texts)):
                    record = frame(to_payload(doc_id, ids + end))
                    framed.append(record)
                    entries.append(struct.pack(ENTRY, place, len(ids) // 4 + 1))
                    place += len(record)
                    total += len(ids) // 4 + 1
                if framed:
                    data.write(b"".join(framed))
                    index.write(b"".join(entries))
                records += len(framed)
        if data is not None:
            data.close()
            index.close()
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "path": name, "records": records, "ids": total}],
                pa.schema([("shard", pa.int32()), ("path", pa.string()), ("records", pa.int64()), ("ids", pa.int64())]),
            )

    spark = docs.sparkSession
    files, inside = store(folder)
    files.create_dir(inside, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(shuffle_width(spark), "id", "tie")
    rows = rows.sortWithinPartitions("id", "tie").select("id", "text")
    rows.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of a folder: ``doc_id, start, ids``; ``start`` counts the ids of all records before it.

    Shards are dealt out one by one; each is read through its index and every checksum is verified.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = spark.read.parquet(f"{folder}/manifest").withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "ids"]
        for batch in batches:
            for one in batch.to_pylist():
                files, inside = store(one["path"])
                with files.open_input_stream(f"{inside}.idx") as file:
                    index = np.frombuffer(file.read(), "<u8").reshape(-1, 2)
                if len(index) != one["records"] or int(index[:, 1].sum()) != one["ids"]:
                    raise ValueError(f"{one['path']}: the index does not fit the manifest")
                starts = one["start"] + np.concatenate([[0], np.cumsum(index[:, 1].astype(np.int64))[:-1]])
                with files.open_input_file(f"{inside}.rec") as file:
                    ends = np.append(index[1:, 0], file.size()).astype(np.int64)
                    at = 0
                    while at < len(index):  # some records at a time, about 8 MB
                        begin = int(index[at, 0])
                        stop = max(at + 1, int(np.searchsorted(ends, begin + 8_000_000)))
                        file.seek(begin)
                        data = memoryview(file.read(int(ends[stop - 1]) - begin))
                        found = [from_payload(unframe(data, int(offset) - begin)) for offset in index[at:stop, 0]]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([doc_id for doc_id, _ in found], pa.int64()), pa.array(starts[at:stop], pa.int64()),
                            pa.array([ids for _, ids in found], pa.binary()),
                        ], names=names)
                        at = stop

    dealt = shards.select("path", "records", "ids", "start").repartition(shuffle_width(spark))
    return dealt.mapInArrow(read, "doc_id long, start long, ids binary")


def read_record(path: str, number: int) -> tuple[int | None, bytes]:
    """One record of a shard by its number, by a single look into the index."""
    files, inside = store(path)
    with files.open_input_file(f"{inside}.idx") as file:
        file.seek(struct.calcsize(ENTRY) * number)
        offset, _ = struct.unpack(ENTRY, file.read(struct.calcsize(ENTRY)))
    with files.open_input_file(f"{inside}.rec") as file:
        file.seek(offset)
        head = file.read(struct.calcsize(FRAME))
        return from_payload(unframe(memoryview(head + file.read(struct.unpack(FRAME, head)[0] + 4)), 0))
