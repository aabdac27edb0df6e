"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles, banded and verified."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkassay.llm.graph import components
from sparkassay.llm.shingles import MIX_A, bucket, document_frequencies, inverse_frequencies, mix, shingle_hashes
from sparkassay.session import cut_lineage

#: Draws of the sampler's random numbers; a shingle's hash chooses one per sample.
DRAWS_BITS = 16
#: Shingles weighed at a time.
BLOCK = 1024
#: Members of a bucket that one task compares with each other or with another such part.
PART = 1024


class Sampler:
    """Consistent weighted samples: two sets agree in a sample with the probability of their weighted Jaccard."""

    def __init__(self, samples: int, seed: int):
        rng = np.random.default_rng(seed)
        size = 1 << DRAWS_BITS
        self.rate = rng.gamma(2.0, 1.0, size)
        self.log_c = np.log(rng.gamma(2.0, 1.0, size))
        self.shift = rng.random(size)
        self.factors = rng.integers(1, 2**63, samples, np.uint64) * np.uint64(2) + np.uint64(1)
        self.buffers = np.empty((4, samples * BLOCK))

    def sample(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """A 64-bit name of the chosen shingle and weight level for each sample."""
        best, names = np.full(len(self.factors), np.inf), np.zeros(len(self.factors), np.uint64)
        rows = np.arange(len(self.factors))
        for at in range(0, len(hashes), BLOCK):
            some, log_w = hashes[at : at + BLOCK], np.log(weights[at : at + BLOCK])
            # the same four blocks of memory again and again, which stay in the processor's cache
            one, rate, shift, level = self.buffers[:, : len(rows) * len(some)].reshape(4, len(rows), len(some))
            draw = np.multiply(self.factors[:, None], some, out=one.view(np.uint64))
            draw >>= np.uint64(64 - DRAWS_BITS)
            draw = draw.view(np.int64)  # below 2^DRAWS_BITS, so "wrap" only spares a check
            self.rate.take(draw, out=rate, mode="wrap")
            self.shift.take(draw, out=shift, mode="wrap")
            np.floor(np.add(np.divide(log_w, rate, out=level), shift, out=level), out=level)
            value = np.subtract(level, shift, out=shift)
            value += 1.0
            value *= rate
            np.subtract(self.log_c.take(draw, out=rate, mode="wrap"), value, out=value)
            least = value.argmin(axis=1)
            found = value[rows, least]
            chosen = mix(some[least] ^ (level[rows, least].astype(np.int64).astype(np.uint64) * np.uint64(MIX_A)))
            names = np.where(found < best, chosen, names)
            best = np.minimum(found, best)
        return names


def describe(text: str | None, width: int) -> tuple[np.ndarray, np.ndarray, bytes | None]:
    """Distinct shingles, their counts, and a name of both (None without words)."""
    hashes, tf = np.unique(shingle_hashes(text, width), return_counts=True)
    name = hashlib.blake2b(hashes.tobytes() + tf.astype("<i8").tobytes(), digest_size=16).digest()
    return hashes, tf, name if len(hashes) else None


def weighted_jaccard(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    _, at, to = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    common = np.minimum(one[1][at], two[1][to]).sum()
    return float(common / (one[1].sum() + two[1].sum() - common))


def with_weights(packed: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (upper halves of their hashes) and their TF-IDF weights."""
    names, counts = np.unique(np.frombuffer(packed, "<u4"), return_counts=True)
    return names, counts * idf[bucket(names.astype(np.uint64) << np.uint64(32))]


def agreements(sketch: np.ndarray) -> np.ndarray:
    """In how many samples each two of the rows agree."""
    if sketch.size * len(sketch) <= 1 << 16:
        return (sketch[:, None] == sketch[None]).sum(axis=2, dtype=np.uint16)
    agree = np.zeros((len(sketch), len(sketch)), np.uint16)
    for column in sketch.T:
        agree += column[:, None] == column[None, :]
    return agree


def verify(group: pa.Table, idf: np.ndarray, similarity: float) -> pa.Table:
    """Links that join the members of one part of a bucket, or of two parts; none that follows from others."""
    by_id = np.argsort(group["id"].to_numpy(), kind="stable")
    sketch = np.frombuffer(b"".join(group["sketch"].to_pylist()), "<u4").reshape(len(group), -1)[by_id]
    same = group["part_a"][0] == group["part_b"][0]
    part, samples = group["part"].to_numpy()[by_id], sketch.shape[1]
    agree = agreements(sketch)
    # the estimate lies over five standard deviations above this for a pair at the threshold
    slack = 5.0 * np.sqrt(similarity * (1 - similarity) / samples)
    able = np.triu(agree >= (similarity - slack) * samples, 1)
    if not same:
        able &= part[:, None] != part[None, :]
    left, right = np.nonzero(able)
    order = np.argsort(-agree[left, right].astype(int), kind="stable")
    sets = [None] * len(group)
    root = list(range(len(group)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    ids, packed, out = group["id"].to_numpy()[by_id], group["shingles"], []
    for x, y in zip(left[order].tolist(), right[order].tolist()):
        a, b = find(x), find(y)
        if a == b:
            continue
        for at in (x, y):
            if sets[at] is None:
                sets[at] = with_weights(packed[int(by_id[at])].as_py(), idf)
        if weighted_jaccard(sets[x], sets[y]) >= similarity:
            root[max(a, b)] = min(a, b)
            out.append((ids[x], ids[y]))
    ends = np.array(out, np.int64).reshape(-1, 2)
    return pa.table({"a": ends[:, 0], "b": ends[:, 1]})


def near_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8,
    bands: int = 10, rows: int = 4, seed: int = 5,
) -> DataFrame:
    """Class of every document: ``id_col, class_id, kept``; a class is joined by links and named by its smallest id.

    Shingles are runs of ``width`` words in lower case; a shingle weighs its count in the document times the inverse
    document frequency of its hash bucket (2^20 buckets counted over all documents). ``bands * rows`` consistent
    weighted samples are drawn per document; documents that agree in all samples of a band meet in a bucket and link
    if their weighted Jaccard similarity, computed from all their shingles, is at least ``similarity``.

    Documents with equal weighted shingles are one. Buckets with the same members are compared once. A bucket is
    compared by pairs of parts of ``PART`` members, which skip pairs already joined, so a group of thousands of
    copies costs a link per member. A pair at 0.8 misses all bands with 0.5 %, at 0.9 with 0.00002 %.

    Null and empty texts have no words and link with nothing, so do null ids; they are kept, in a class of their own.
    Rows that repeat an id are of one class. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    seen, counts = document_frequencies(texts, "text", width)
    shared = spark.sparkContext.broadcast(inverse_frequencies(seen, counts))

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler, idf = Sampler(bands * rows, seed), shared.value
        for batch in batches:
            out = []
            for text in batch["text"]:
                hashes, tf, content = describe(text, width)
                if content is None:
                    out.append((None, None, None))
                    continue
                names = sampler.sample(hashes, tf * idf[bucket(hashes)])
                keys = names.reshape(bands, rows)
                key = np.arange(bands, dtype=np.uint64)
                for column in keys.T:
                    key = mix(key * np.uint64(MIX_A) + column)
                out.append((content, key.view(np.int64), (names >> np.uint64(32)).astype("<u4").tobytes()))
            yield pd.DataFrame(out, columns=["content", "keys", "sketch"]).assign(id=batch["id"].to_numpy())

    signed = texts.mapInPandas(sign, "content binary, keys array<long>, sketch binary, id long")
    signed = cut_lineage(signed, "signatures")
    able = signed.where(F.col("content").isNotNull() & F.col("id").isNotNull())
    reps = able.groupBy("content").agg(F.min("id").alias("rep"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    reps = cut_lineage(reps, "distinct")
    placed = reps.select("rep", F.posexplode("keys").alias("band", "key"))
    full = placed.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("members"),
        F.sum(F.xxhash64("rep", F.lit(1)).cast("decimal(38,0)")).alias("again"),
    ).where("n > 1")
    once = full.groupBy("n", "members", "again").agg(F.min(F.struct("band", "key")).alias("first"))
    once = cut_lineage(once.select("n", "first.band", "first.key"), "buckets")
    parts = F.ceil(F.col("n") / PART)
    busy = placed.join(once, ["band", "key"]).withColumn("parts", parts)
    busy = busy.withColumn("part", F.pmod(F.xxhash64("rep"), "parts"))
    busy = busy.groupBy("rep").agg(F.collect_list(F.struct("band", "key", "part", "parts")).alias("buckets"))
    busy = cut_lineage(busy.join(reps.select("rep", "content", "sketch"), "rep"), "members")  # a bucket per band at most

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, content in zip(batch["id"], batch["text"], batch["content"]):
                hashes, tf, own = describe(text, width)
                if own == content:  # an id may stand for other texts too
                    out.append((doc_id, np.repeat((hashes >> np.uint64(32)).astype("<u4"), tf).tobytes()))
            yield pd.DataFrame(out, columns=["id", "shingles"])

    chosen = texts.join(busy.select(F.col("rep").alias("id"), "content"), "id").mapInPandas(pack, "id long, shingles binary")
    chosen = cut_lineage(chosen.groupBy("id").agg(F.first("shingles").alias("shingles")), "shingles")
    members = busy.drop("content").withColumnRenamed("rep", "id").join(chosen, "id").select(
        "id", "sketch", "shingles", F.explode("buckets").alias("bucket")
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bucket.parts") - 1))
    members = members.withColumn("other", other).select(
        "id", "sketch", "shingles", "bucket.band", "bucket.key", "bucket.part",
        F.least("bucket.part", "other").alias("part_a"), F.greatest("bucket.part", "other").alias("part_b"),
    )
    links = members.groupBy("band", "key", "part_a", "part_b").applyInArrow(
        lambda group: verify(group, shared.value, similarity), "a long, b long"
    )
    classes = components(cut_lineage(links, "links"))
    named = reps.join(classes, F.col("rep") == F.col("id"), "left")
    named = cut_lineage(named.select("content", F.coalesce("component", "rep").alias("class_id")), "classes")
    out = able.select("id", "content").join(named, "content").select("id", "class_id")
    alone = signed.where(F.col("content").isNull() | F.col("id").isNull()).select("id", F.col("id").alias("class_id"))
    out = out.unionByName(alone)
    return out.select(
        F.col("id").alias(id_col), "class_id", F.coalesce(F.col("id") == F.col("class_id"), F.lit(True)).alias("kept")
    )
