"""Best-fit packing of token pieces into sequences under several capacities (vector best-fit decreasing)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from sparkassay.llm.tokens import REMEMBERED, default_vocabulary, encoder

#: Pieces and tokens packed at a time; bins with room stay open for what follows.
GROUP_PIECES, GROUP_TOKENS, OPEN_BINS = 16_384, 8_000_000, 2_048


class Bins:
    """Open bins of one task. A piece goes to the bin whose weighted residual norm after it is the smallest."""

    def __init__(self, capacity: tuple[float, float, float], weights: tuple[float, float, float], first: int):
        self.capacity = np.asarray(capacity, float)
        self.scale = np.asarray(weights, float) / self.capacity**2
        self.room = np.empty((3, 0))  # left tokens, documents and attention cost of each open bin
        self.ids = np.empty(0, np.int64)
        self.fill = np.empty(0, np.int64)
        self.next = first

    def place(self, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of each piece; longer pieces choose first."""
        places, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        order = np.argsort(-lengths, kind="stable")
        room = np.concatenate([self.room, np.empty((3, len(lengths)))], axis=1)
        ids = np.concatenate([self.ids, np.empty(len(lengths), np.int64)])
        fill = np.concatenate([self.fill, np.empty(len(lengths), np.int64)])
        used, shortest = len(self.ids), lengths.min(initial=1)
        for turn, at in enumerate(order):
            if turn % 512 == 511:  # bins that no piece fits in any more are put aside
                keep = np.flatnonzero((room[0, :used] >= shortest) & (room[1, :used] >= 1))
                room[:, : len(keep)], ids[: len(keep)], fill[: len(keep)] = room[:, keep], ids[keep], fill[keep]
                used = len(keep)
            if lengths[at] == self.capacity[0]:  # fills a bin alone
                places[at], offsets[at] = self.next, 0
                self.next += 1
                continue
            need = np.array([lengths[at], 1.0, float(lengths[at]) ** 2])
            left = room[:, :used] - need[:, None]
            fits = left.min(axis=0) >= 0 if used else np.zeros(0, bool)
            if fits.any():
                norm = np.where(fits, self.scale @ (left * left), np.inf)
                bin_at = int(norm.argmin())
            else:
                bin_at, used = used, used + 1
                room[:, bin_at], ids[bin_at], fill[bin_at] = self.capacity, self.next, 0
                self.next += 1
            places[at], offsets[at] = ids[bin_at], fill[bin_at]
            room[:, bin_at] -= need
            fill[bin_at] += lengths[at]
        keep = np.flatnonzero((room[:, :used] >= 1).all(axis=0))
        keep = keep[np.argsort(-room[0, keep], kind="stable")[:OPEN_BINS]]
        self.room, self.ids, self.fill = room[:, keep], ids[keep], fill[keep]
        return places, offsets


SCHEMA = StructType([
    StructField("piece", IntegerType()), StructField("start", LongType()), StructField("ids", BinaryType()),
    StructField("sequence_id", LongType()), StructField("offset", LongType()),
])


def best_fit_sequences(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = 2,
    length: int = 1024, documents: int | None = None, attention: float | None = None,
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01), group_tokens: int = GROUP_TOKENS,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Pieces of all documents with their token ids, packed into sequences.

    ``group_tokens`` bounds the tokens packed at a time and ``remembered`` the token pieces each Python worker keeps
    encoded; both trade memory for time and change no result.

    Returns ``id_col, piece, start, ids, sequence_id, offset``; ``ids`` are little-endian unsigned 32-bit numbers.
    A document is its ids and ``end_id``. One longer than ``length`` is cut: the first piece takes the remainder, so
    all others are full. A bin holds at most ``length`` tokens, ``documents`` pieces (default: as many as tokens) and
    a sum of squared piece lengths of ``attention`` (default: ``length`` squared, so only tokens bind); among the
    bins with room for all three, the piece goes where the weighted norm of what is left is smallest.

    Each task packs the pieces of its own input split in groups of bounded size, longest first, and leaves bins with
    room open for its later groups: nothing is shuffled, and a split wastes a few bins at most. Sequence numbers
    carry the partition number in their upper half. A task that runs again makes the same rows.

    A null text is an empty one (a piece with ``end_id`` alone). Null or repeated ids are packed like all others.
    An empty table gives no rows. Other columns are not read.
    """
    if (attention or length**2) < length**2 or (documents or length) < 1:
        raise ValueError("a full piece must fit into an empty bin")
    path = vocabulary or default_vocabulary()
    capacity = (float(length), float(documents or length), float(attention or length**2))
    id_field = docs.select(F.col(id_col)).schema[0]
    schema = StructType([id_field, *SCHEMA])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins = Bins(capacity, weights, TaskContext.get().partitionId() << 33)
        end = np.array([end_id], "<u4").tobytes()
        owners, numbers, starts, parts, tokens = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = np.fromiter((len(part) // 4 for part in parts), np.int64, len(parts))
            places, offsets = bins.place(lengths)
            columns = [
                pa.array(owners, kind), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()),
                pa.array(parts, pa.binary()), pa.array(places), pa.array(offsets),
            ]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        kind = pa.int64()
        for batch in batches:
            kind = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                texts = [text or "" for text in some.column(1).to_pylist()]
                for owner, ids in zip(some.column(0).to_pylist(), encoder(path, remembered).encode(texts)):
                    ids += end
                    size = len(ids) // 4
                    cuts = [0, *range(size % length or length, size + 1, length)]
                    for number, (begin, stop) in enumerate(zip(cuts, cuts[1:])):
                        owners.append(owner)
                        numbers.append(number)
                        starts.append(begin)
                        parts.append(ids[4 * begin : 4 * stop])
                    tokens += size
                if len(parts) >= GROUP_PIECES or tokens >= group_tokens:
                    yield flush()
                    owners, numbers, starts, parts, tokens = [], [], [], [], 0
        if parts:
            yield flush()

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(pack, schema)
