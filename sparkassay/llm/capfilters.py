"""Near-duplicate vectors: spherical-cap filters from random product codes, list-decoded, joined and verified."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkassay.llm.graph import components
from sparkassay.llm.kdtree import usable
from sparkassay.session import cut_lineage

#: Independent codes, and how many filters of each a pair at the threshold shares in expectation. The filters of one
#: code depend on each other, so many codes with one shared filter miss far fewer pairs than one code with many.
CODES, SHARED = 16, 1.0
#: Random vectors that share a filter with a vector, in expectation.
CHANCE = 0.3
#: Filters per vector and code at most, in expectation; few dimensions or many rows would ask for more.
PER_VECTOR = 5.0
#: Members of a filter that one task compares with each other or with another such part.
PART = 1024


@dataclass(frozen=True)
class Code:
    """Two codebooks on the halves of a randomly turned space; a filter is a pair of codewords."""

    turn: np.ndarray
    left: np.ndarray
    right: np.ndarray
    threshold: float

    def decode(self, rows: np.ndarray) -> list[np.ndarray]:
        """All filters whose direction has at least the threshold with each unit row, ascending."""
        half = len(self.left[0])
        turned = rows @ self.turn
        one, two = turned[:, :half] @ self.left.T, turned[:, half:] @ self.right.T
        tops = two.max(axis=1), one.max(axis=1)
        out = []
        for first, second, top_two, top_one in zip(one, two, *tops):
            able = np.flatnonzero(first >= self.threshold - top_two)  # no partner can save the others
            partners = np.flatnonzero(second >= self.threshold - top_one)
            fits = first[able][:, None] + second[partners][None, :] >= self.threshold
            i, j = np.nonzero(fits)
            out.append(able[i] * len(second) + partners[j])
        return out


def cap(dim: int, t: float) -> float:
    """Share of the unit sphere with at least ``t`` in a given direction."""
    u = np.linspace(-1, 1, 8_001)
    weight = (1 - u * u).clip(0) ** ((dim - 3) / 2) if dim > 2 else np.ones_like(u)
    return float(weight[u >= t].sum() / weight.sum())


def both(dim: int, t: float, cosine: float) -> float:
    """Share of directions that have at least ``t`` with both of two vectors at the given cosine."""
    u = np.linspace(t, 1, 200)[:-1]
    weight = (1 - u * u) ** ((dim - 3) / 2)
    limit = (t - cosine * u) / np.sqrt((1 - cosine**2) * (1 - u * u))
    given = np.array([cap(max(dim - 1, 3), x) if x < 1 else 0.0 for x in limit])
    return float((weight * given).sum() / weight.sum()) * cap(dim, t)


def make_codes(rows: int, dim: int, cosine: float, seed: int) -> list[Code]:
    """Codes for this many vectors: caps so narrow that chance meetings are few, and as many as recall needs."""
    size = max(dim + dim % 2, 4)
    share = min(2e-3, max(1e-9, CHANCE / max(rows, 1)))
    low, high = 0.0, 0.999
    for _ in range(30):
        t = (low + high) / 2
        low, high = (t, high) if cap(size, t) > share else (low, t)
    while t > 0 and SHARED * cap(size, t) > PER_VECTOR * both(size, t, cosine):
        t = max(0.0, t - 0.02)  # caps too narrow for a pair at the threshold to share
    words = int(np.ceil(np.sqrt(SHARED / both(size, t, cosine))))
    return [make_code(size, dim, words, t, seed + at) for at in range(CODES)]


def make_code(size: int, dim: int, words: int, t: float, seed: int) -> Code:
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.standard_normal((size, size)))[0][:dim]
    books = [rng.standard_normal((words, size // 2)) for _ in range(2)]
    left, right = (book / np.linalg.norm(book, axis=1, keepdims=True) / np.sqrt(2) for book in books)
    return Code(turn, left, right, t)


def linked(one: np.ndarray, two: np.ndarray, cosine: float) -> np.ndarray:
    """Which pairs have at least the cosine, in doubles."""
    norms = np.linalg.norm(one, axis=1)[:, None] * np.linalg.norm(two, axis=1)[None, :]
    return one @ two.T >= cosine * norms


def shared_before(one: list[np.ndarray], two: list[np.ndarray], filter_id: int) -> np.ndarray:
    """Which pairs also meet in a filter with a smaller number, where they are counted instead."""
    names = {name: at for at, name in enumerate(sorted({int(x) for own in one for x in own if x < filter_id}))}

    def table(lists):
        out = np.zeros((len(lists), len(names)), np.float32)
        for at, own in enumerate(lists):
            out[at, [names[int(x)] for x in own if int(x) in names]] = 1
        return out

    return table(one) @ table(two).T > 0 if names else np.zeros((len(one), len(two)), bool)


def spread(links: np.ndarray) -> np.ndarray:
    """The smallest position that each position reaches by links (symmetric matrix)."""
    label = np.arange(len(links))
    while True:
        least = np.minimum(label, np.where(links, label[None, :], len(links)).min(axis=1, initial=len(links)))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def compare(filter_id: int, ids: np.ndarray, rows: np.ndarray, part: np.ndarray | None, filters, copies: np.ndarray, cosine: float):
    """Links inside a part of a filter, or between two parts: the members that have some, with their roots and counts."""
    out = linked(rows, rows, cosine)
    np.fill_diagonal(out, False)
    if part is not None:
        out &= part[:, None] != part[None, :]
    busy = np.flatnonzero(out.any(axis=1))
    if not len(busy):
        return None
    ids, copies, out = ids[busy], copies[busy], out[np.ix_(busy, busy)]
    own = [filters[at] for at in busy]
    counts = (out & ~shared_before(own, own, filter_id)) @ copies
    return ids, ids[spread(out)], counts


def compare_sorted(batches: Iterator[pd.DataFrame], cosine: float) -> Iterator[pd.DataFrame]:
    """The runs of rows of one filter and pair of parts, in batches that are sorted by them and by id."""
    keys = ["size", "filter", "part_a", "part_b"]
    rest, last = None, False
    batches = iter(batches)
    while not last:
        batch = next(batches, None)
        last = batch is None
        batch = rest if last else batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if batch is None or not len(batch):
            continue
        key = batch[keys].to_numpy()
        starts = np.append(0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1)
        ends = np.append(starts[1:], len(batch))
        if not last:  # the last run may go on
            rest = batch.iloc[starts[-1] :].reset_index(drop=True)
            starts, ends = starts[:-1], ends[:-1]
        ids, copies, part = (batch[c].to_numpy() for c in ("id", "copies", "part"))
        vectors, filters = batch["vector"].to_numpy(), batch["filters"].to_numpy()
        out = []
        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a < 2:
                continue
            rows = np.stack(vectors[a:b]).astype(float)
            two = part[a:b] if key[a, 2] != key[a, 3] else None
            found = compare(int(key[a, 1]), ids[a:b], rows, two, filters[a:b], copies[a:b], cosine)
            if found is not None:
                out.append(np.column_stack(found))
        if out:
            yield pd.DataFrame(np.concatenate(out), columns=["id", "root", "links"])


def near_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, seed: int = 8,
) -> DataFrame:
    """Direct links and component of every vector: ``id_col, n_links, component_id, kept``.

    Equal vectors are one (their copies link each other by definition). Each distinct vector is decoded to all
    filters, pairs of codewords of ``CODES`` random product codes, whose direction it exceeds; vectors that meet in a
    filter are compared in double precision and counted in the smallest filter that they share. The cap and the number
    of filters follow from the row count, so that chance meetings are few and a pair at the threshold shares
    ``CODES * SHARED`` filters in expectation (about one in a thousand such pairs shares none, fewer above it). Only
    filters with a second member get vectors. A filter with many members is compared by pairs of parts of ``PART``
    rows, so no task grows; tasks return sums and one link per member, never pairs. Components come from those links.

    Null ids, null, empty or zero vectors and those with null or non-finite components link with nothing and stay
    (kept, component their own id). Vectors of different length do not meet. A repeated id counts as rows of its own
    with one component. An empty table gives no rows. Other columns are not read.
    """
    vector = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    able = F.coalesce(F.col("id").isNotNull() & usable(vector) & F.exists(vector, lambda x: x != 0), F.lit(False))
    rows = cut_lineage(rows.withColumn("able", able).withColumn("hash", F.xxhash64("vector")), "vectors")
    distinct = rows.where("able").groupBy("hash", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    distinct = cut_lineage(distinct, "distinct")
    sizes = [r["size"] for r in distinct.select(F.size("vector").alias("size")).distinct().collect()]
    count = distinct.count()
    codes = {size: make_codes(count, size, cosine, seed) for size in sizes}

    def decode(batches):
        for batch in batches:
            lengths = batch["vector"].map(len)
            for size, some in batch.groupby(lengths):
                plain = np.stack(some["vector"].to_numpy()).astype(float)
                unit = plain / np.abs(plain).max(axis=1, keepdims=True)
                unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
                found = [
                    [own + at * len(code.left) * len(code.right) for own in code.decode(unit)]
                    for at, code in enumerate(codes[size])
                ]
                filters = [np.concatenate(own) for own in zip(*found)]
                yield pd.DataFrame({"rep": some["rep"], "filters": filters, "size": size})

    decoded = distinct.select("rep", "vector").mapInPandas(decode, "rep long, filters array<long>, size int")
    members = cut_lineage(decoded, "filters")
    named = members.select("rep", "size", F.explode("filters").alias("filter"))
    counts = named.groupBy("size", "filter").agg(F.count("*").alias("n")).where("n > 1")
    counts = cut_lineage(counts, "counts")
    # only filters with a second member go on, and only their members' vectors are sent to them
    met = named.join(counts, ["size", "filter"]).groupBy("rep", "size").agg(
        F.collect_list(F.struct("filter", "n")).alias("met")
    )
    met = cut_lineage(met, "met")
    busy = met.select("rep", "size", F.col("met.filter").alias("filters"), F.explode("met").alias("one")).select(
        "rep", "size", "filters", "one.*"
    )
    parts = F.ceil(F.col("n") / PART).cast("int")
    busy = busy.withColumn("part", F.pmod(F.xxhash64("rep"), parts.cast("long")).cast("int"))
    # part p meets itself and every other part: (p, q) for q >= p and (q, p) for q < p
    busy = busy.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        "rep", "size", "filter", "filters", "part", F.least("part", "other").alias("part_a"),
        F.greatest("part", "other").alias("part_b"),
    )
    busy = busy.join(distinct.select("rep", "vector", "copies"), "rep").withColumnRenamed("rep", "id")
    order = ["size", "filter", "part_a", "part_b"]
    found = busy.repartition(*order).sortWithinPartitions(*order, "id").mapInPandas(
        lambda batches: compare_sorted(batches, cosine), "id long, root long, links long"
    )
    found = cut_lineage(found, "found")
    component = components(found.where("id <> root"), "id", "root")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    classes = distinct.join(links, F.col("rep") == F.col("id"), "left").drop("id")
    classes = classes.join(component, F.col("rep") == F.col("id"), "left").select(
        "hash", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    classes = cut_lineage(classes, "classes")
    alone = rows.where(~F.col("able")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = rows.where("able").join(classes, ["hash", "vector"]).select("id", "n_links", "component_id").unionByName(alone)
    return out.select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
