"""Word shingles of whole texts as hashes, and their document frequencies over a corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Odd multipliers of the finalising mix (fixed values, as in splitmix64).
MIX_A, MIX_B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
STEP = 0x9E3779B97F4A7C15
#: Document frequencies are kept per hash bucket; 2^20 numbers at any corpus size.
BUCKET_BITS = 20
CHUNK = 4096


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each white-space separated word in lower case."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; a shorter text that has words is one shingle of all of them."""
    words = word_hashes(text)
    if not len(words):
        return words
    count, width = max(1, len(words) - width + 1), min(width, len(words))
    total = np.full(count, width, np.uint64)
    for at in range(width):
        total = total * np.uint64(STEP) + words[at : at + count]
    return mix(total)


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame, text_col: str, width: int) -> tuple[int, np.ndarray]:
    """Number of documents with words, and per hash bucket how many of them hold one of its shingles.

    Each task counts its split into one array and returns it in chunks, which are summed per chunk. The result has
    2^20 numbers however large the corpus is, so it may go to the driver and to every task.
    """
    size = 1 << BUCKET_BITS

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, found = 0, np.zeros(size, np.int64)
        for batch in batches:
            for text in batch["text"]:
                own = np.unique(bucket(shingle_hashes(text, width)))
                found[own] += 1
                seen += bool(len(own))
        parts = found.astype(np.int32 if found.max() < 2**31 else np.int64).reshape(-1, CHUNK)
        rows = [(at, seen if at == 0 else 0, part.astype("<i8").tobytes()) for at, part in enumerate(parts) if part.any()]
        yield pd.DataFrame(rows, columns=["chunk", "docs", "counts"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(one, "<i8") for one in group["counts"])
        return pd.DataFrame({"chunk": group["chunk"].iloc[:1], "docs": [group["docs"].sum()], "counts": [total.tobytes()]})

    schema = "chunk int, docs long, counts binary"
    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInPandas(count, schema)
    out, seen = np.zeros((size // CHUNK, CHUNK), np.int64), 0
    for row in parts.groupBy("chunk").applyInPandas(add, schema).collect():  # at most 256 rows
        out[row["chunk"]] = np.frombuffer(row["counts"], "<i8")
        seen += row["docs"]
    return seen, out.ravel()


def inverse_frequencies(seen: int, counts: np.ndarray) -> np.ndarray:
    """ln((1 + documents) / (1 + documents with the bucket)) + 1."""
    return np.log((1.0 + seen) / (1.0 + counts)) + 1.0
