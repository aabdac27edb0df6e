"""Imputation and scaling, fitted on training folds only.

State tables are keyed by ``(cv, feature)``: ``cv`` is the model index, fitted on the
rows whose ``fold`` differs from it. Fits aggregate each fold once and combine the
aggregates of the other folds, so the data are never copied k times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.functions.columns import q, sql_name
from sparkassay.functions.kernels import exact_quantiles, fold_versions, small_side, to_long, vector_state
from sparkassay.operators.folds import expand_folds, train_rows
from sparkassay.roles import Roles
from sparkassay.session import cut_lineage


def fit_mode(df: DataFrame, features: list[str], k: int) -> DataFrame:
    """Most frequent training value, the smallest on ties."""
    long = to_long(df, ["fold"], features).where(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value", "fold").agg(F.count(F.lit(1)).alias("n"))
    per_cv = (
        counts.withColumn("cv", F.explode(fold_versions(F.col("fold"), k)))
        .groupBy("cv", "feature", "value")
        .agg(F.sum("n").alias("n"))
    )
    best = F.max_by("value", F.struct(F.col("n"), (-F.col("value")).alias("low")))
    return per_cv.groupBy("cv", "feature").agg(best.alias("fill"))


def fit_median(df: DataFrame, features: list[str], k: int, approx: bool = False) -> DataFrame:
    """Training median; exact by default."""
    long = to_long(df, ["fold"], features)
    if approx:
        known = train_rows(long.where(F.col("value").isNotNull()), k)
        return known.groupBy("cv", "feature").agg(F.percentile_approx("value", F.lit(0.5), F.lit(10000)).alias("fill"))
    return exact_quantiles(long, ["feature"], "value", [0.5], len(features), ("fold", k, "cv"), ["fill"])


def fit_fill(df: DataFrame, kinds: dict[str, list[str]], k: int, approx: bool = False) -> DataFrame:
    """Mode for categorical features, median for quantitative ones."""
    parts = []
    if kinds.get("categorical"):
        parts.append(fit_mode(df, kinds["categorical"], k))
    if kinds.get("quantitative"):
        parts.append(fit_median(df, kinds["quantitative"], k, approx))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _replace(df: DataFrame, joined: DataFrame, new: dict[str, str]) -> DataFrame:
    """The columns of ``df``, those in ``new`` as the SQL given; one call however many features there are."""
    return joined.selectExpr(*[f"{new[c]} AS {sql_name(c)}" if c in new else sql_name(c) for c in df.columns])


def apply_fill(df: DataFrame, fill: DataFrame, features: list[str], k: int = 100) -> DataFrame:
    """Fill missing cells of rows that carry ``cv``. The joined side has one row per model index."""
    joined = df.join(vector_state(fill, features, {"__f": "fill"}, ["cv"], k), "cv", "left")
    new = {f: f"coalesce(CAST({sql_name(f)} AS DOUBLE), __f[{i}])" for i, f in enumerate(features)}
    return _replace(df, joined, new)


def needs_imputation(df: DataFrame, features: list[str]) -> DataFrame:
    """One row: missing cells among the features, and whether there are any."""
    gaps = F.aggregate(F.array(*[q(f).isNull().cast("int") for f in features]), F.lit(0), lambda a, x: a + x)
    return df.agg(F.coalesce(F.sum(gaps), F.lit(0)).alias("missing")).withColumn("needed", F.col("missing") > 0)


def fit_scaler(df: DataFrame, features: list[str], k: int, fill: DataFrame | None = None) -> DataFrame:
    """Training mean and population sd after filling; a zero sd becomes 1.

    With ``fill`` the filled cells enter as (count, value) blocks, so the filled data
    need not exist.
    """
    long = to_long(df, ["fold"], features)
    blocks = long.groupBy("fold", "feature").agg(
        F.count("value").cast("double").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v"),
        F.count_if(F.col("value").isNull()).cast("double").alias("gaps"),
    ).withColumn("cv", F.explode(fold_versions(F.col("fold"), k)))
    own = F.struct(F.col("n"), F.coalesce("m", F.lit(0.0)).alias("m"), F.coalesce("v", F.lit(0.0)).alias("v"))
    if fill is None:
        parts = F.array(own)
    else:
        blocks = blocks.join(small_side(fill, k * len(features)), ["cv", "feature"], "left")
        filled = F.col("fill").isNotNull()
        parts = F.array(own, F.struct(
            F.when(filled, F.col("gaps")).otherwise(0.0).alias("n"),
            F.coalesce("fill", F.lit(0.0)).alias("m"), F.lit(0.0).alias("v"),
        ))
    return _combine(blocks.select("cv", "feature", F.inline(parts)))


def _combine(blocks: DataFrame) -> DataFrame:
    """Mean and sd of (n, m, v) blocks per (cv, feature); at most two blocks per fold."""
    group = Window.partitionBy("cv", "feature")
    centred = blocks.where(F.col("n") > 0).withColumn(
        "mean", F.sum(F.col("n") * F.col("m")).over(group) / F.sum("n").over(group)
    )
    gap = F.col("m") - F.col("mean")
    out = centred.groupBy("cv", "feature", "mean").agg(
        F.sqrt(F.sum(F.col("n") * (F.col("v") + gap * gap)) / F.sum("n")).alias("sd")
    )
    return out.select("cv", "feature", "mean", F.when(F.col("sd") > 0, F.col("sd")).otherwise(1.0).alias("scale"))


def fit_scaler_prepared(train: DataFrame, features: list[str]) -> DataFrame:
    """Scaler of rows that already carry ``cv`` and have been imputed."""
    long = to_long(train, ["cv"], features)
    stats = long.groupBy("cv", "feature").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"))
    return stats.select("cv", "feature", "mean", F.when(F.col("sd") > 0, F.col("sd")).otherwise(1.0).alias("scale"))


def apply_scaler(df: DataFrame, scaler: DataFrame, features: list[str], k: int = 100) -> DataFrame:
    joined = df.join(vector_state(scaler, features, {"__m": "mean", "__s": "scale"}, ["cv"], k), "cv", "left")
    new = {f: f"({sql_name(f)} - __m[{i}]) / __s[{i}]" for i, f in enumerate(features)}
    return _replace(df, joined, new)


def inverse_scale(df: DataFrame, scaler: DataFrame, features: list[str], k: int = 100) -> DataFrame:
    """Scaled values (or cut points) back in original units."""
    joined = df.join(vector_state(scaler, features, {"__m": "mean", "__s": "scale"}, ["cv"], k), "cv", "left")
    new = {f: f"{sql_name(f)} * __s[{i}] + __m[{i}]" for i, f in enumerate(features)}
    return _replace(df, joined, new)


def apply_prep(
    df: DataFrame, fill: DataFrame | None, scaler: DataFrame | None, features: list[str], k: int = 100
) -> DataFrame:
    """Fill and scale in one go."""
    out = df if fill is None else apply_fill(df, fill, features, k)
    return out if scaler is None else apply_scaler(out, scaler, features, k)


def preprocess(
    df: DataFrame, roles: Roles, kinds: dict[str, list[str]], k: int, impute: bool = True, scale: bool = True
) -> DataFrame:
    """All model indexes at once: rows with ``cv`` and ``part``, filled and scaled by the training folds.

    The two state tables are stored when fitted, so using the result does not fit them again.
    """
    features = [f for f in roles.features(df) if f in set(sum(kinds.values(), []))]
    fill = cut_lineage(fit_fill(df, kinds, k), "fill") if impute else None
    scaler = cut_lineage(fit_scaler(df, features, k, fill), "scaler") if scale else None
    return apply_prep(expand_folds(df, k), fill, scaler, features, k)
