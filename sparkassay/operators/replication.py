"""New data: the training state and models applied to rows they have not seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkassay.operators import clean, evaluate, prep, profile, significance, summarize
from sparkassay.operators.models.fitted import Fitted, many_predictions
from sparkassay.roles import Roles
from sparkassay.session import cut_lineage


def profile_replication(df: DataFrame, roles: Roles, kinds: DataFrame) -> dict[str, DataFrame]:
    """Profile of the new rows; the kinds come from training."""
    rows = clean.drop_missing_class(df, roles)
    features = roles.features(rows)
    return {
        "column_profile": profile.column_profile(rows),
        "describe": profile.describe(rows, features),
        "counts": profile.counts_summary(rows, roles, kinds),
        "class_counts": profile.class_counts(rows, roles),
        "correlation": profile.correlation_matrix(rows, features),
    }


def prepare_replication(
    df: DataFrame, roles: Roles, features: list[str], k: int, fill: DataFrame | None, scaler: DataFrame | None
) -> DataFrame:
    """One version of every row per model index, filled and scaled by that index's state: a narrow explode."""
    rows = clean.align_to(features, clean.drop_missing_class(df, roles), roles)
    versions = rows.withColumn("cv", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return prep.apply_prep(versions, fill, scaler, features, k)


def apply_models(models: dict[tuple[int, str], Fitted], prepared, dataset: str) -> DataFrame:
    """Predictions of every (fold, algorithm): one pass over the rows per fold.

    ``prepared`` is a frame that carries ``cv``, or a function that prepares the rows of one model index, so that no
    row is copied for the other indexes.
    """
    parts = []
    for fold in sorted({f for f, _ in models}):
        own = [m for (f, _), m in sorted(models.items(), key=lambda item: item[0]) if f == fold]
        view = prepared(fold) if callable(prepared) else prepared.where(F.col("cv") == fold)
        parts.append(many_predictions(own, view, dataset, fold))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def summarise_replication(pred: DataFrame, df: DataFrame, roles: Roles, groups: int | None = None) -> dict[str, DataFrame]:
    """Metrics, their summaries and tests, mean curves, and the no-skill line of the new data."""
    perf = cut_lineage(evaluate.evaluate(pred, groups=groups), "performance")
    return {
        "performance": perf,
        "means": summarize.metric_means(perf),
        "stds": summarize.metric_stds(perf),
        "kruskal": significance.kruskal(perf),
        "wilcoxon": significance.gated(significance.wilcoxon_pairs(perf), significance.kruskal(perf)),
        "mann_whitney": significance.gated(significance.mann_whitney_pairs(perf), significance.kruskal(perf)),
        "roc": evaluate.mean_curve(pred, "roc", groups=groups),
        "prc": evaluate.mean_curve(pred, "prc", groups=groups),
        "metric_boxes": profile.boxplot_stats(perf, "value", ["dataset", "algorithm", "metric"]),
        "no_skill": profile.no_skill(clean.drop_missing_class(df, roles), roles),
    }
