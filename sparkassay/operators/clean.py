"""Row and column filters applied before anything else."""

from __future__ import annotations

import warnings
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkassay.functions.columns import q
from sparkassay.roles import Roles
from sparkassay.session import cut_lineage


def drop_missing_class(df: DataFrame, roles: Roles, drop_all_missing: bool = False) -> DataFrame:
    """Keep labelled rows, class as int; optionally also drop rows whose features are all missing."""
    kept = df.where(q(roles.class_col).isNotNull())
    if drop_all_missing:
        kept = kept.where(F.coalesce(*[q(f).cast("string") for f in roles.features(df)]).isNotNull())
    return kept.withColumn(roles.class_col, q(roles.class_col).cast("int"))


def ensure_instance(df: DataFrame, roles: Roles, name: str = "instance") -> tuple[DataFrame, Roles]:
    """A table without an instance label gets a running number; it is stored, so no retry can renumber it."""
    if roles.inst_col and roles.inst_col in df.columns:
        return df, roles
    numbered = cut_lineage(df.withColumn(name, F.monotonically_increasing_id()), "numbered")
    return numbered, replace(roles, inst_col=name)


def drop_features(df: DataFrame, names: list[str]) -> DataFrame:
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"not in the table: {unknown}")
    return df.select(*[q(c) for c in df.columns if c not in set(names)])


def features_only(df: DataFrame, roles: Roles) -> DataFrame:
    return df.select(*[q(f) for f in roles.features(df)])


def feature_names(df: DataFrame, roles: Roles) -> DataFrame:
    """Features in table order with the number of usable values of each."""
    names = roles.features(df)
    counts = df.agg(*[F.count(q(f)).alias(f"c{i}") for i, f in enumerate(names)])
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"), F.col(f"c{i}").alias("n_values"))
        for i, f in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*rows)))


def resolve_match(df: DataFrame, roles: Roles, method: str) -> str:
    """Matched partitioning needs a match column; without one fall back to stratified."""
    if method == "matched" and (not roles.match_col or roles.match_col not in df.columns):
        warnings.warn("no match column: folds are stratified by class instead", stacklevel=2)
        return "stratified"
    return method


def align_to(train_features: list[str], new_df: DataFrame, roles: Roles) -> DataFrame:
    """Order and prune new data like the training table; a missing feature is an error."""
    missing = [f for f in train_features if f not in new_df.columns]
    if missing:
        raise ValueError(f"new data lack training features: {missing}")
    labels = [c for c in roles.present(new_df.columns) if c not in train_features]
    return new_df.select(*[q(c) for c in [*labels, *train_features]])


def significant(df: DataFrame, cutoff: float = 0.05, p: Column | None = None) -> DataFrame:
    """Rows at or below the cutoff (inclusive; the star flag is strict)."""
    return df.where((F.col("p_value") if p is None else p) <= F.lit(cutoff))
