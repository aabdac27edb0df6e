"""Iterative imputation: every incomplete feature is regressed on all others, in rounds.

A round costs one pass over the data for all folds and targets together. Tasks fill
their rows from the parameters found so far and add up cross-products; one task per
fold and target sums them and solves its features x features system, so the driver
gets a row of weights per fold and target only. No filled copy of the data is kept
between rounds, so nothing has to be checkpointed and a lost task is just run again.

The weights of a round are fitted to the state at its start, but a row's gaps are filled
one after another, each from the values just filled: these are Gauss-Seidel steps on
the precision matrix, which converge where filling all gaps at once from old values
diverges. A fold stops when its largest change falls below the tolerance, or grows
over two rounds in a row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkassay.functions.columns import q

STATE = T.StructType([
    T.StructField("cv", T.IntegerType()), T.StructField("round", T.IntegerType()),
    T.StructField("target", T.StringType()), T.StructField("intercept", T.DoubleType()),
    T.StructField("coef", T.ArrayType(T.DoubleType())),
])


def fill_rows(x: np.ndarray, start: np.ndarray, rounds: list[tuple[np.ndarray, np.ndarray]]) -> tuple:
    """The rows after all rounds, and after all but the last."""
    gaps = np.isnan(x)
    now = np.where(gaps, start, x)
    before = now
    open_columns = np.flatnonzero(gaps.any(axis=0))
    for weights, intercepts in rounds:
        before, now = now, now.copy()
        for t in open_columns:
            rows = gaps[:, t]
            now[rows, t] = now[rows] @ weights[t] + intercepts[t]
    return now, before


def bayes_ridge(xx: np.ndarray, xy: np.ndarray, yy: float, n: float) -> np.ndarray:
    """Ridge weights with the penalty set by evidence maximisation, from centred cross-products."""
    eig, vec = np.linalg.eigh(xx)
    eig = np.clip(eig, 0.0, None)
    rotated = vec.T @ xy
    noise, prior = 1.0 / max(yy / n, 1e-12), 1.0
    tiny = 1e-6
    old = None
    for _ in range(300):
        weights = vec @ (rotated / (eig + prior / noise))
        error = max(yy - 2.0 * weights @ xy + weights @ xx @ weights, 0.0)
        used = np.sum(noise * eig / (prior + noise * eig))
        prior = (used + 2 * tiny) / (weights @ weights + 2 * tiny)
        noise = (n - used + 2 * tiny) / (error + 2 * tiny)
        if old is not None and np.sum(np.abs(old - weights)) < 1e-3:
            break
        old = weights
    return vec @ (rotated / (eig + prior / noise))


def _round_sums(df: DataFrame, features: list[str], model: dict, targets: dict[int, list[int]]) -> list:
    """Weights of each (cv, target) from the cross-products of its observed rows, and the last change of each cv."""
    d = len(features)
    upper = np.triu_indices(d + 1)
    wide = df.select("fold", *[q(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])

    def partial(batches):
        import pandas as pd

        sums: dict[tuple[int, int], np.ndarray] = {}
        change: dict[int, float] = {}
        for batch in batches:
            fold = batch["fold"].to_numpy()
            values = batch[[f"f{i}" for i in range(d)]].to_numpy(dtype="float64")
            for cv, todo in targets.items():
                x = values[fold != cv]
                if not len(x):
                    continue
                start, rounds = model[cv]
                now, before = fill_rows(x, start, rounds)
                change[cv] = max(change.get(cv, 0.0), float(np.max(np.abs(now - before))))
                row = np.hstack([np.ones((len(now), 1)), now - start])
                for t in todo:
                    seen = row[~np.isnan(x[:, t])]
                    sums[cv, t] = sums.get((cv, t), 0.0) + (seen.T @ seen)[upper]
        yield pd.DataFrame(
            [(cv, t, total.tobytes(), change[cv]) for (cv, t), total in sums.items()], columns=["cv", "t", "sums", "delta"]
        )

    def solve(group):
        import pandas as pd

        cv, t = int(group["cv"].iloc[0]), int(group["t"].iloc[0])
        gram = np.zeros((d + 1, d + 1))
        gram[upper] = sum(np.frombuffer(one) for one in group["sums"])
        gram = np.triu(gram) + np.triu(gram, 1).T
        start, n = model[cv][0], gram[0, 0]
        mean = gram[0, 1:] / n
        cross = gram[1:, 1:] - n * np.outer(mean, mean)
        others = [i for i in range(d) if i != t]
        w = np.zeros(d)
        w[others] = bayes_ridge(cross[np.ix_(others, others)], cross[others, t], cross[t, t], n)
        intercept = start[t] + mean[t] - w @ (start + mean)
        return pd.DataFrame({"cv": [cv], "t": [t], "intercept": [intercept], "coef": [w], "delta": [group["delta"].max()]})

    rows = wide.mapInPandas(partial, "cv int, t int, sums binary, delta double")
    return rows.groupBy("cv", "t").applyInPandas(
        solve, "cv int, t int, intercept double, coef array<double>, delta double"
    ).collect()


def fit_iterative(
    df: DataFrame, features: list[str], k: int, max_iter: int = 30, tol: float = 1e-3
) -> DataFrame:
    """Parameter table ``(cv, round, target, intercept, coef)``; round 0 holds the training means."""
    d = len(features)
    stats = df.groupBy("fold").agg(*[
        c for i, f in enumerate(features) for c in (
            F.count(q(f)).alias(f"n{i}"), F.sum(q(f).cast("double")).alias(f"s{i}"),
            F.count_if(q(f).isNull()).alias(f"g{i}"), F.max(F.abs(q(f).cast("double"))).alias(f"x{i}"),
        )
    ]).collect()
    model, targets, limit = {}, {}, {}
    for cv in range(k):
        rest = [r for r in stats if r["fold"] != cv]
        n = np.array([sum(r[f"n{i}"] for r in rest) for i in range(d)], dtype=float)
        s = np.array([sum(r[f"s{i}"] or 0.0 for r in rest) for i in range(d)])
        model[cv] = (np.divide(s, n, out=np.zeros(d), where=n > 0), [])
        targets[cv] = [i for i in range(d) if n[i] > 0 and any(r[f"g{i}"] for r in rest)]
        limit[cv] = tol * max([r[f"x{i}"] or 0.0 for r in rest for i in range(d)] + [0.0])
    open_cv = {cv: t for cv, t in targets.items() if t}
    last: dict[int, list[float]] = {cv: [] for cv in open_cv}
    for step in range(max_iter):
        if not open_cv:
            break
        solved = _round_sums(df, features, model, open_cv)
        if step:
            for cv in list(open_cv):
                change = last[cv] = [*last[cv][-2:], max([r["delta"] for r in solved if r["cv"] == cv] + [0.0])]
                grows = len(change) == 3 and change[0] < change[1] < change[2]
                if change[-1] < limit[cv] or grows:
                    del open_cv[cv]
        for cv in open_cv:
            start, rounds = model[cv]
            rounds.append((np.zeros((d, d)), start.copy()))
        for r in solved:
            if r["cv"] in open_cv:
                weights, intercepts = model[r["cv"]][1][-1]
                weights[r["t"]], intercepts[r["t"]] = r["coef"], r["intercept"]
    rows = []
    for cv, (start, rounds) in model.items():
        rows += [(cv, 0, f, float(start[i]), None) for i, f in enumerate(features)]
        for number, (weights, intercepts) in enumerate(rounds, 1):
            rows += [
                (cv, number, features[t], float(intercepts[t]), [float(v) for v in weights[t]]) for t in targets[cv]
            ]
    return df.sparkSession.createDataFrame(rows, STATE)


def read_state(state: DataFrame, features: list[str]) -> dict:
    """Parameter table back into matrices: cv x rounds x targets rows, independent of the data size."""
    at = {f: i for i, f in enumerate(features)}
    d = len(features)
    model: dict[int, tuple] = {}
    for r in state.orderBy("cv", "round", "target").collect():
        start, rounds = model.setdefault(r["cv"], (np.zeros(d), []))
        if r["round"] == 0:
            start[at[r["target"]]] = r["intercept"]
            continue
        if len(rounds) < r["round"]:
            rounds.append((np.zeros((d, d)), start.copy()))
        rounds[-1][0][at[r["target"]]] = r["coef"]
        rounds[-1][1][at[r["target"]]] = r["intercept"]
    return model


def apply_iterative(df: DataFrame, state: DataFrame, features: list[str]) -> DataFrame:
    """Fill rows that carry ``cv``; a narrow pass. Observed cells are kept as they are."""
    model = read_state(state, features)
    schema = T.StructType([
        T.StructField(f.name, T.DoubleType() if f.name in features else f.dataType) for f in df.schema.fields
    ])

    def fill(batches):
        for batch in batches:
            values = batch[features].to_numpy(dtype="float64", copy=True)
            cvs = batch["cv"].to_numpy()
            for cv in np.unique(cvs):
                own = cvs == cv
                start, rounds = model[int(cv)]
                values[own] = fill_rows(values[own], start, rounds)[0]
            batch = batch.copy()
            batch[features] = values
            yield batch

    plain = df.select(*[q(c).cast("double").alias(c) if c in features else q(c) for c in df.columns])
    return plain.mapInPandas(fill, schema)
