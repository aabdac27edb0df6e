"""Gaussian naive Bayes from class moments; the fit is one aggregation, the prediction one pass in Arrow batches."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.functions.columns import q, sql_name
from sparkassay.functions.kernels import to_long

SMOOTHING = 1e-9  # share of the largest feature variance added to every variance


def fit(train: DataFrame, features: list[str], class_col: str = "class") -> DataFrame:
    """State ``(cv, class, feature, mean, var, prior)`` of training rows that carry ``cv``."""
    long = to_long(train, ["cv", class_col], features)
    stats = long.groupBy("cv", q(class_col).alias("class"), "feature").agg(
        F.avg("value").alias("mean"), F.var_pop("value").alias("v"), F.count(F.lit(1)).cast("double").alias("n")
    )
    both = Window.partitionBy("cv", "feature")
    every = Window.partitionBy("cv")
    total = F.sum("n").over(both)
    stats = stats.withColumn("__m", F.sum(F.col("n") * F.col("mean")).over(both) / total)
    gap = F.col("mean") - F.col("__m")
    spread = F.sum(F.col("n") * (F.col("v") + gap * gap)).over(both) / total
    stats = stats.withColumn("__all", spread).withColumn("prior", F.col("n") / total)
    return stats.select(
        "cv", "class", "feature", "mean", (F.col("v") + SMOOTHING * F.max("__all").over(every)).alias("var"), "prior"
    )


def _tables(state: DataFrame, features: list[str]) -> dict:
    """Mean, variance and prior per (cv, class): at most model indexes x 2 x features numbers; NaN where absent."""
    place, out = {f: i for i, f in enumerate(features)}, {}
    for r in state.where(F.col("class").isin(0, 1)).collect():
        mean, var, prior = out.setdefault((r["cv"], int(r["class"])), (*np.full((2, len(features)), np.nan), [None]))
        if r["feature"] in place and r["mean"] is not None and r["var"] is not None and r["var"] > 0:
            mean[place[r["feature"]]], var[place[r["feature"]]] = r["mean"], r["var"]
        prior[0] = r["prior"] if prior[0] is None else max(prior[0], r["prior"])
    return out


def predict(state: DataFrame, df: DataFrame, features: list[str], k: int = 100) -> DataFrame:
    """Add ``p``, the probability of class 1. The state, a few numbers per (model index, class, feature)
    of at most ``k`` indexes, is collected when called; rows pass in Arrow batches, feature by feature. A missing
    cell gives no probability."""
    known = _tables(state, features)
    width = len(features)

    def log_joint(x, mean, var, prior):
        out = math.log(prior[0])
        for f in range(width):
            gap = x[:, f] - mean[f]
            out = out - 0.5 * math.log(2.0 * math.pi * var[f]) - 0.5 * gap * gap / var[f]
        return out

    @F.arrow_udf("double")
    def probability(cv: pa.Array, x: pa.Array) -> pa.Array:
        cells = x.flatten()
        values = cells.to_numpy(zero_copy_only=False).reshape(len(x), width)
        absent = cells.is_null().to_numpy(zero_copy_only=False).reshape(len(x), width).any(axis=1)
        p, unknown = np.zeros(len(x)), np.zeros(len(x), bool)
        for index in cv.unique().to_pylist():
            zero, one = known.get((index, 0)), known.get((index, 1))
            if index is None or one is None:  # no row of class 1: 0
                continue
            own = pc.equal(cv, index).fill_null(False).to_numpy(zero_copy_only=False)
            if zero is None:
                p[own] = 1.0
            elif np.isnan(zero[1]).any() or np.isnan(one[1]).any():
                unknown |= own
            else:
                with np.errstate(over="ignore", invalid="ignore"):
                    p[own] = 1.0 / (1.0 + np.exp(log_joint(values[own], *zero) - log_joint(values[own], *one)))
                unknown |= own & absent
        return pa.array(p, mask=unknown)

    vector = "array(" + ", ".join(f"CAST({sql_name(f)} AS DOUBLE)" for f in features) + ")"
    return df.select(*[q(c) for c in df.columns], probability(F.col("cv"), F.expr(vector)).alias("p"))
