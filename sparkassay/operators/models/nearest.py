"""K nearest neighbours: exact, by cells of a k-d tree.

Training rows chosen by a hash of their label (about one in ``CELL_ROWS``, at most ``MAX_PIVOTS`` and at most
``PIVOT_BYTES`` of numbers, so what is sent to the tasks has a fixed bound) are halved along their widest feature until
one or two are left: the leaves are the cells. Every training row falls into one cell, and a cell keeps its count and
the box around its rows, one small row per cell. A row to score first meets one block of its own cell; the kth
distance found there bounds its true kth distance. It then meets only the cells whose box is not farther than that
bound. A row whose own block holds fewer than k rows has no such bound; it meets the cells that the boxes alone cannot
rule out (``candidate_cells``). Inside a cell the rows are halved again into leaves of ``LEAF`` rows with boxes, and
the same rule picks the leaves to compare with. Large cells are cut into blocks of at most ``BLOCK`` rows by a hash of
the label, so no task holds more than a block, whatever a cell holds. Every (cell, block) returns up to k candidates
per row; the best k over all of them give the vote, ties by label order.

Neither side is collected; only the tree and the cell table (bounded as above) are sent to the tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.functions.columns import q

CELL_ROWS = 1024  # training rows per cell, on average
MAX_PIVOTS = 2048
PIVOT_BYTES = 32 << 20
BLOCK = 16_384  # rows of one cell compared in one task at most
LEAF = 128  # rows of a leaf inside a cell, at most (or 2 k)
SLICE = 64  # rows compared with all cells at a time: keeps the work in the processor cache
PAIRS = 1 << 22  # a slice of rows times the rows of a block, at most


def _distance(a, b, p: int):
    """Sum of |a - b| ** p, added feature by feature in table order."""
    total = 0.0
    for f in range(a.shape[-1]):
        gap = abs(a[..., f] - b[..., f])
        total = total + (gap * gap if p == 2 else gap**p)
    return total


def to_pivots(x: np.ndarray, pivots: np.ndarray, p: int) -> np.ndarray:
    """Minkowski distances (rooted) of every row to every pivot, in slices of rows."""
    out = np.empty((len(x), len(pivots)))
    for at in range(0, len(x), SLICE):
        out[at : at + SLICE] = _distance(x[at : at + SLICE, None, :], pivots[None, :, :], p) ** (1.0 / p)
    return out


def _vectors(df: DataFrame, features: list[str], inst: str, extra: list) -> DataFrame:
    x = F.array(*[q(f).cast("double") for f in features])
    return df.select(q(inst).alias("id"), x.alias("x"), *extra)


def choose_pivots(train: DataFrame, features: list[str], inst: str) -> np.ndarray:
    """Distinct training vectors whose label hash falls in one of ``CELL_ROWS`` slots; the ``most`` first by hash."""
    most = max(1, min(MAX_PIVOTS, PIVOT_BYTES // (8 * max(1, len(features)))))
    h = F.xxhash64(F.lit("pivot"), q(inst))
    x = F.array(*[q(f).cast("double") for f in features])
    chosen = train.where(F.pmod(h, F.lit(CELL_ROWS)) == 0).select(x.alias("x"), h.alias("h")).orderBy("h").limit(most)
    rows = chosen.collect() or train.select(x.alias("x"), h.alias("h")).orderBy("h").limit(1).collect()
    if not rows:
        return np.zeros((0, len(features)))
    return np.unique(np.array([r["x"] for r in rows], dtype=float).reshape(len(rows), len(features)), axis=0)


def candidate_cells(x: np.ndarray, pivots: np.ndarray, radius: np.ndarray, count: np.ndarray, k: int, p: int) -> list[np.ndarray]:
    """For each row, the cells that can hold one of its k nearest training rows."""
    near = to_pivots(x, pivots, p)
    far = near + radius[None, :]
    order = np.argsort(far, axis=1, kind="stable")
    reach = np.cumsum(count[order], axis=1)
    enough = np.argmax(reach >= k, axis=1)
    bound = np.where(reach[:, -1] >= k, np.take_along_axis(far, order, 1)[np.arange(len(x)), enough], np.inf)
    slack = 1e-9 * (np.abs(bound) + np.abs(near).max(axis=1, initial=0.0) + 1.0)
    close = near - radius[None, :] <= (bound + slack)[:, None]
    return [np.flatnonzero(row) for row in close]


def cell_tree(pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature and cut of every inner node of a full binary tree; node i has the children 2i + 1 and 2i + 2."""
    depth = max(0, len(pivots).bit_length() - 1)
    feature, cut = np.zeros(2**depth - 1, int), np.full(2**depth - 1, np.inf)
    held = {0: pivots}
    for node in range(2**depth - 1):
        own = held.pop(node)
        if len(own):
            feature[node] = np.argmax(own.std(axis=0))
            column = np.sort(own[:, feature[node]])
            steps = np.flatnonzero(column[1:] > column[:-1])  # cuts between distinct values: the one nearest the middle
            if len(steps):
                cut[node] = column[steps[np.argmin(np.abs(2 * (steps + 1) - len(column)))]]
        left = own[:, feature[node]] <= cut[node]
        held[2 * node + 1], held[2 * node + 2] = own[left], own[~left]
    return feature, cut


def to_cells(x: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The cell of every row."""
    node = np.zeros(len(x), int)
    for _ in range((len(feature) + 1).bit_length() - 1):
        right = x[np.arange(len(x)), feature[node]] > cut[node]
        node = 2 * node + 1 + right
    return node - len(feature)


def box_gaps(x: np.ndarray, low: np.ndarray, high: np.ndarray, p: int) -> np.ndarray:
    """Sum of |gap| ** p of every row to every box: no row in a box is nearer."""
    nearest = np.clip(x[:, None, :], low[None, :, :], high[None, :, :])
    return _distance(x[:, None, :], nearest, p)


def reachable_cells(
    x: np.ndarray, bound: np.ndarray, low: np.ndarray, high: np.ndarray, count: np.ndarray, k: int, p: int
) -> list[np.ndarray]:
    """For each row, the cells whose box is not beyond its bound; without a bound, those the boxes cannot rule out."""
    out = []
    centre = (low + high) / 2.0
    radius = _distance(centre, high, p) ** (1.0 / p) * (1 + 1e-9)
    for at in range(0, len(x), SLICE):
        part, limit = x[at : at + SLICE], bound[at : at + SLICE]
        close = box_gaps(part, low, high, p) <= (limit * (1 + 1e-12))[:, None]
        cells = [np.flatnonzero(row) for row in close]
        for i in np.flatnonzero(np.isinf(limit)):
            cells[i] = candidate_cells(part[i : i + 1], centre, radius, count, k, p)[0]
        out += cells
    return out


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=float).reshape(len(column), width)


def _leaves(z: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers of ``z`` halved along the widest feature until no part is above ``size``."""
    todo, done = [np.arange(len(z))], []
    while todo:
        own = todo.pop()
        if len(own) <= size:
            done.append(own)
            continue
        part = z[own]
        order = np.argpartition(part[:, np.argmax(part.max(0) - part.min(0))], len(own) // 2)
        todo += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    return done


def nearest_rows(x: np.ndarray, z: np.ndarray, bound: np.ndarray, k: int, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of ``x``, row of ``z`` and distance sum of the k nearest rows of ``z`` within each row's bound.

    Ties go to the first rows of ``z``; the result is ordered by row, distance, row of ``z``.
    """
    leaves = _leaves(z, max(LEAF, 2 * k))
    low, high = np.array([z[own].min(0) for own in leaves]), np.array([z[own].max(0) for own in leaves])
    slices = []
    step = max(SLICE, PAIRS // max(len(z), 1))
    for at in range(0, len(x), step):
        part, limit = x[at : at + step], bound[at : at + step].copy()
        gaps = box_gaps(part, low, high, p)
        home = gaps.argmin(axis=1)
        for leaf, own in enumerate(leaves):  # the kth distance in the nearest leaf bounds the rest
            rows = np.flatnonzero(home == leaf)
            if len(rows) and len(own) >= k:
                d = _distance(part[rows, None, :], z[None, own, :], p)
                limit[rows] = np.minimum(limit[rows], np.partition(d, k - 1, axis=1)[:, k - 1])
        close = gaps <= (limit * (1 + 1e-12))[:, None]
        found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))]
        for leaf, own in enumerate(leaves):
            rows = np.flatnonzero(close[:, leaf])
            d = _distance(part[rows, None, :], z[None, own, :], p)
            i, j = np.nonzero(d <= limit[rows, None])
            found.append((rows[i], own[j], d[i, j]))
        row, col, d = (np.concatenate(side) for side in zip(*found))
        order = np.lexsort((col, d, row))
        row, col, d = row[order], col[order], d[order]
        keep = np.arange(len(row)) - np.searchsorted(row, np.arange(len(part)))[row] < k
        slices.append((at + row[keep], col[keep], d[keep]))
    return tuple(np.concatenate(side) for side in zip(*slices))


def predict(
    train: DataFrame, df: DataFrame, features: list[str], k: int = 5, weights: str = "uniform", p: int = 2,
    inst: str = "inst_id", class_col: str = "class", out: str = "p",
) -> DataFrame:
    """Add ``out``: the weighted share of class 1 among the k nearest; equal distances by label order."""
    pivots = choose_pivots(train, features, inst)
    if len(pivots) == 0:  # no training rows: no neighbours, no rows, as an inner join of votes gives
        return df.withColumn(out, F.lit(None).cast("double")).limit(0)
    width = len(features)
    feature, cut = cell_tree(pivots)
    right = _vectors(train, features, inst, [q(class_col).cast("double").alias("y")])
    kind, other = dict(df.dtypes)[inst], dict(train.dtypes)[inst]

    def assign(batches):
        for part in batches:
            yield part.assign(cell=to_cells(_matrix(part["x"], width), feature, cut).astype("int32"))

    def boxes(parts):
        held: dict[int, list] = {}
        for part in parts:
            x, cell = _matrix(part["x"], width), part["cell"].to_numpy()
            for c in np.unique(cell):
                own = x[cell == c]
                n, low, high = held.get(c, (0, np.inf, -np.inf))
                held[c] = (n + len(own), np.minimum(low, own.min(0)), np.maximum(high, own.max(0)))
        if held:
            n, low, high = zip(*held.values())
            yield pd.DataFrame({"cell": list(held), "n": n, "low": low, "high": high})

    def merge(part):
        low, high = _matrix(part["low"], width).min(0), _matrix(part["high"], width).max(0)
        return pd.DataFrame({"cell": part["cell"][:1], "n": [part["n"].sum()], "low": [low], "high": [high]})

    cells_of = right.mapInPandas(assign, f"id {other}, x array<double>, y double, cell int")
    box = "cell int, n long, low array<double>, high array<double>"
    table = cells_of.select("x", "cell").mapInPandas(boxes, box).groupBy("cell").applyInPandas(merge, box).orderBy("cell").collect()
    number = np.array([r["cell"] for r in table], dtype="int32")
    count = np.array([r["n"] for r in table], dtype=np.int64)
    low = np.array([r["low"] for r in table], dtype=float).reshape(len(table), width)
    high = np.array([r["high"] for r in table], dtype=float).reshape(len(table), width)
    blocks = np.ones(len(feature) + 1, np.int64)
    blocks[number] = -(-count // BLOCK)

    parts = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("cell") + 1)
    b = cells_of.select(
        F.col("id").alias("id_b"), F.col("x").alias("x_b"), "y", F.col("cell").alias("cell_b"),
        F.pmod(F.xxhash64(F.col("id")), parts).cast("int").alias("block_b"),
    )

    def first_bound(rows, others):
        """The kth distance of each row in one block of its own cell."""
        rows = rows[["id", "x"]].assign(bound=np.inf)
        if len(rows) and len(others) >= k:
            x, z = _matrix(rows["x"], width), _matrix(others["x_b"], width)
            row, _, d = nearest_rows(x, z, np.full(len(x), np.inf), k, p)
            last = np.searchsorted(row, np.arange(len(x)), side="right") - 1
            rows["bound"] = d[last]
        return rows

    def visit(batches):
        for part in batches:
            x = _matrix(part["x"], width)
            cells = reachable_cells(x, part["bound"].to_numpy(), low, high, count, k, p)
            own = np.repeat(np.arange(len(part)), [len(c) for c in cells])
            cell = number[np.concatenate(cells)] if cells else number[:0]
            yield part.iloc[own].assign(cell=cell)

    def nearest(rows, others):
        if rows.empty or others.empty:
            return pd.DataFrame({"id": [], "d": [], "other": [], "y": []})
        others = others.sort_values("id_b")
        x, z = _matrix(rows["x"], width), _matrix(others["x_b"], width)
        row, col, d = nearest_rows(x, z, rows["bound"].to_numpy(), k, p)
        return pd.DataFrame({
            "id": rows["id"].to_numpy()[row], "d": d, "other": others["id_b"].to_numpy()[col], "y": others["y"].to_numpy()[col],
        })

    home = _vectors(df, features, inst, []).mapInPandas(assign, f"id {kind}, x array<double>, cell int")
    bounded = home.withColumn("block", F.lit(0)).groupBy("cell", "block").cogroup(
        b.where(F.col("block_b") == 0).groupBy("cell_b", "block_b")
    ).applyInPandas(first_bound, f"id {kind}, x array<double>, bound double")
    left = bounded.mapInPandas(visit, f"id {kind}, x array<double>, bound double, cell int")
    a = left.select("id", "x", "bound", "cell", F.explode(F.sequence(F.lit(0), parts - 1)).alias("block"))
    found = a.groupBy("cell", "block").cogroup(b.groupBy("cell_b", "block_b")).applyInPandas(
        nearest, f"id {kind}, d double, other {other}, y double"
    )
    order = Window.partitionBy("id").orderBy("d", "other")
    top = found.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k)
    if weights == "distance":
        near = F.pow(F.col("d"), F.lit(1.0 / p))
        zero = F.min("d").over(Window.partitionBy("id")) == 0
        weight = F.when(zero, (F.col("d") == 0).cast("double")).otherwise(1.0 / near)
    else:
        weight = F.lit(1.0)
    top = top.withColumn("w", weight)
    votes = top.groupBy("id").agg((F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias(out))
    return df.join(votes.withColumnRenamed("id", inst), inst).select(*[q(c) for c in df.columns], out)
