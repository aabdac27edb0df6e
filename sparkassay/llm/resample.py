"""Importance resampling of documents towards a target distribution of hashed word features.

Features are the words of a text after lower-casing A-Z only (runs of 1 to ``ngram`` words, joined by a space); each
feature falls into the bucket ``crc32(utf8) mod buckets``. The CRC-32 of every feature comes from a position table:
CRC-32 is affine in the message, so a feature's value is the XOR of one precomputed contribution per byte, chosen by
the byte and its distance from the end of the feature, XOR a constant of its length. Per Arrow batch the words are
flattened into one byte array, contributions are gathered from the table and XOR-reduced per feature span with
``np.bitwise_xor.reduceat``; spans longer than the table fold blockwise (Horner steps of "append ``TABLE`` zero bytes",
itself a table per byte of the 32-bit value).

A corpus pass counts the features per bucket in ``docs`` (s, total S) and in ``target`` (t, total T), pre-aggregated
in each task, so only ``buckets`` numbers per task are shuffled. The gain of a bucket is
``floor(1000 * ln((t+1)(S+B) / ((s+1)(T+B))))`` (B = buckets); a document's weight is the sum of gains over its features.
``draw`` adds Gumbel noise from ``sha256(<salt>:<id>)`` and ranks the documents with at least ``min_words`` words by
score (ties to the smaller id) across range partitions: a slim table is range-partitioned and sorted, its rows are
numbered per partition, and only the partition counts (one number per partition) meet on the driver.

Cases: a null text has no words (0 features, weight 0); an empty table gives empty results and all gains from zero
counts; a very long text or word costs time in proportion to its bytes (a slice of a batch holds at most
``SLICE_BYTES`` of text, or one text); repeated rows get equal weights and scores and consecutive ranks; a null id
hashes as ``<salt>:`` and sorts last among equal scores. Input columns named like the outputs are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sparkassay.llm.fim import slices
from sparkassay.session import cut_lineage

#: The word pattern (its complement splits), the reflected CRC-32 polynomial.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
POLY = 0xEDB88320
TABLE = 64
SLICE_BYTES = 2 << 20
OUTPUTS = ("n_features", "weight", "score", "rank")


def _zero_byte(r: np.ndarray, byte_table: np.ndarray) -> np.ndarray:
    return (r >> np.uint32(8)) ^ byte_table[r & np.uint32(0xFF)]


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Position table ``[distance from end, byte]`` of raw CRC contributions, and the shift by ``TABLE`` zero bytes
    as four tables, one per byte of a 32-bit value."""
    r = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        r = np.where(r & 1, (r >> np.uint32(1)) ^ np.uint32(POLY), r >> np.uint32(1)).astype(np.uint32)
    byte_table = r
    position = np.empty((TABLE, 256), np.uint32)
    position[0] = byte_table
    for d in range(1, TABLE):
        position[d] = _zero_byte(position[d - 1], byte_table)
    shift = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8))).astype(np.uint32)
    for _ in range(TABLE):
        shift = _zero_byte(shift, byte_table)
    return position, shift


@lru_cache(maxsize=4096)
def length_constant(n: int) -> int:
    """CRC-32 of n zero bytes: what the initial and final XOR add to the raw (linear) CRC of any n bytes."""
    return zlib.crc32(bytes(n))


def span_crc32(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each span ``data[start : start + length]`` (lengths above 0) by the position table."""
    position, shift = tables()
    if len(lengths) == 0:
        return np.zeros(0, np.uint32)
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths  # place of each span in the gathered bytes
    owner = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(total, dtype=np.int64) - first[owner]
    gathered = data[starts[owner] + inside]
    distance = lengths[owner] - 1 - inside
    contribution = position.reshape(-1)[(distance % TABLE) * 256 + gathered]
    blocks = (lengths + TABLE - 1) // TABLE
    # segments: per span its blocks of TABLE bytes counted from its end, in byte order (highest block first)
    span_of = np.repeat(np.arange(len(lengths)), blocks)
    block_no = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    k = blocks[span_of] - 1 - block_no
    seg_start = first[span_of] + np.maximum(0, lengths[span_of] - (k + 1) * TABLE)
    partial = np.bitwise_xor.reduceat(contribution, seg_start)
    raw = partial[np.cumsum(blocks) - blocks].copy()  # the highest block of each span
    for step in range(1, int(blocks.max())):
        longer = np.flatnonzero(blocks > step)
        acc = raw[longer]
        shifted = shift[0][acc & 0xFF] ^ shift[1][(acc >> 8) & 0xFF] ^ shift[2][(acc >> 16) & 0xFF] ^ shift[3][acc >> 24]
        raw[longer] = shifted ^ partial[(np.cumsum(blocks) - blocks)[longer] + step]
    sizes, which = np.unique(lengths, return_inverse=True)
    constants = np.array([length_constant(int(n)) for n in sizes], np.uint32)
    return raw ^ constants[which]


def features(texts: pa.Array, ngram: int = 1) -> tuple[pa.Array, np.ndarray]:
    """Features of each text as UTF-8 (runs of 1 to ``ngram`` words) and the index of the text each belongs to."""
    whole = pc.fill_null(texts.cast(pa.large_string()), pa.scalar("", pa.large_string()))
    # a fresh copy: ascii_lower misreads slices whose offsets do not start at zero
    lowered = pc.ascii_lower(whole.take(pa.array(np.arange(len(whole), dtype=np.int64))))
    parts = pc.split_pattern_regex(lowered, SPLIT)
    words = parts.flatten()
    parent = np.asarray(pc.list_parent_indices(parts), np.int64)
    keep = np.asarray(pc.greater(pc.binary_length(words), 0))
    words, parent = words.filter(pa.array(keep)), parent[keep]
    out, owners = [words], [parent]
    for n in range(2, ngram + 1):
        same = parent[n - 1 :] == parent[: len(parent) - n + 1] if len(parent) >= n else np.zeros(0, bool)
        pieces = [words.slice(i, len(words) - n + 1) for i in range(n)] if len(parent) >= n else []
        if pieces:
            joined = pc.binary_join_element_wise(*pieces, pa.scalar(" ", pa.large_string()))
            out.append(joined.filter(pa.array(same)))
            owners.append(parent[: len(parent) - n + 1][same])
    return pa.concat_arrays([a.cast(pa.large_string()) for a in out]), np.concatenate(owners)


def buckets_of(feats: pa.Array, buckets: int) -> np.ndarray:
    binary = feats.cast(pa.large_binary())
    bounds = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
    data = binary.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return span_crc32(raw, bounds[:-1], np.diff(bounds)).astype(np.int64) % buckets


def bucket_counts(df: DataFrame, text_col: str, buckets: int, ngram: int) -> DataFrame:
    """``bucket, n``: features per bucket over all rows, summed per task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                feats, _ = features(part.column(text_col), ngram)
                totals += np.bincount(buckets_of(feats, buckets), minlength=buckets)
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int64()), "n": pa.array(totals[used], pa.int64())})

    counted = df.select(F.col(text_col)).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str, buckets: int, ngram: int) -> np.ndarray:
    """The gain of every bucket; ``buckets`` numbers, so their size is fixed whatever the corpus."""
    s = np.zeros(buckets, np.float64)
    t = np.zeros(buckets, np.float64)
    for into, df in ((s, docs), (t, target)):
        for row in bucket_counts(df, text_col, buckets, ngram).collect():
            into[row["bucket"]] = row["n"]
    big_s, big_t = s.sum(), t.sum()
    return np.floor(1000.0 * np.log((t + 1.0) * (big_s + buckets) / ((s + 1.0) * (big_t + buckets)))).astype(np.int64)


def feature_weights(
    docs: DataFrame, target: DataFrame, text_col: str = "text", target_text_col: str = "text", buckets: int = 10_000,
    ngram: int = 1, keep_text: bool = True,
) -> DataFrame:
    """Adds ``n_features`` and ``weight`` (sum of bucket gains over the features) to every row of ``docs``."""
    table = gains(docs, target.select(F.col(target_text_col).alias(text_col)), text_col, buckets, ngram)
    kept = [c for c in docs.columns if c not in OUTPUTS and (keep_text or c != text_col)]
    rows = docs.select(*kept, *([] if keep_text else [text_col]))
    fields = [f for f in rows.schema.fields if f.name in kept]
    schema = StructType([*fields, StructField("n_features", LongType()), StructField("weight", LongType())])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                feats, owner = features(part.column(text_col), ngram)
                rows = part.num_rows
                n = np.bincount(owner, minlength=rows).astype(np.int64)
                weight = np.bincount(owner, weights=table[buckets_of(feats, buckets)], minlength=rows)
                columns = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(n), pa.array(np.round(weight).astype(np.int64))], schema=pa.schema(
                        [*(part.schema.field(c) for c in kept), pa.field("n_features", pa.int64()), pa.field("weight", pa.int64())]
                    )
                )

    return rows.mapInArrow(weigh, schema)


def gumbel(id_col: Column, salt: str) -> Column:
    """``floor(-1000 ln(-ln((h + 0.5) / 2^32)))`` with h the first eight hex digits of sha256(``<salt>:<id>``)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    u = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def draw(
    weighted: DataFrame, id_col: str = "doc_id", percent: int = 10, salt: str = "2024", min_words: int = 20,
) -> DataFrame:
    """Adds ``score`` (weight plus Gumbel noise) and ``rank`` (1, 2, ... by score, then id, for the
    ``floor(percent * N / 100)`` best of the N rows with at least ``min_words`` features; null for all others)."""
    scored = weighted.withColumn("score", (F.col("weight") + gumbel(F.col(id_col), salt)).cast("long"))
    scored = cut_lineage(scored.withColumn("__row", F.monotonically_increasing_id()), "resample-scored")
    eligible = scored.where(F.col("n_features") >= min_words).select("__row", id_col, "score")
    wanted = percent * eligible.count() // 100
    if wanted == 0:
        return scored.withColumn("rank", F.lit(None).cast("long")).drop("__row")
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("__row").asc()]
    width = int(weighted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = eligible.repartitionByRange(width, *order).sortWithinPartitions(*order)
    ranged = cut_lineage(ranged.withColumn("__pos", F.monotonically_increasing_id()), "resample-ranged")
    part, inside = F.shiftright("__pos", 33), F.col("__pos").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, before = {}, 0
    for row in sorted(counts, key=lambda r: r["part"]):
        offsets[row["part"]] = before
        before += row["n"]
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv]), part)
    ranks = ranged.select("__row", (offset + inside + 1).alias("rank")).where(F.col("rank") <= wanted)
    return scored.join(ranks, "__row", "left").drop("__row")


def importance_resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 10_000,
    ngram: int = 1, percent: int = 10, salt: str = "2024", min_words: int = 20, keep_text: bool = True,
) -> DataFrame:
    """Every row of ``docs`` with ``n_features``, ``weight``, ``score`` and ``rank`` (null where not drawn)."""
    weighted = feature_weights(docs, target, text_col, "text", buckets, ngram, keep_text)
    return draw(weighted, id_col, percent, salt, min_words)
