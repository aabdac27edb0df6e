"""Ranking and collective selection of features from score tables ``(fold, algorithm, feature, score)``.

These tables have folds x algorithms x features rows, whatever the size of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.functions.kernels import small_side


def rank_scores(scores: DataFrame) -> DataFrame:
    """Rank within fold and algorithm, best first, ties by name."""
    order = Window.partitionBy("fold", "algorithm").orderBy(F.desc("score"), "feature")
    return scores.withColumn("rank", F.row_number().over(order))


def mean_scores(scores: DataFrame, top_n: int | None = None) -> DataFrame:
    """Mean score over folds, ranked per algorithm; only the best top_n if asked for."""
    means = scores.groupBy("algorithm", "feature").agg(F.avg("score").alias("mean_score"))
    order = Window.partitionBy("algorithm").orderBy(F.desc("mean_score"), "feature")
    ranked = means.withColumn("rank", F.row_number().over(order))
    return ranked if top_n is None else ranked.where(F.col("rank") <= top_n)


def informative(scores: DataFrame) -> DataFrame:
    return scores.where(F.col("score") > 0)


def union_informative(scores: DataFrame) -> DataFrame:
    """Features informative to at least one algorithm, per fold."""
    return informative(scores).select("fold", "feature").distinct()


def informative_counts(scores: DataFrame) -> DataFrame:
    """Features kept and lost per fold; works for a single algorithm too."""
    return scores.groupBy("fold").agg(
        F.count_distinct(F.when(F.col("score") > 0, F.col("feature"))).alias("informative"),
        (F.count_distinct("feature") - F.count_distinct(F.when(F.col("score") > 0, F.col("feature")))).alias(
            "uninformative"
        ),
    )


def cap_features(scores: DataFrame, max_features: int | None = None) -> DataFrame:
    """Informative features per fold, taken in turn from each algorithm's ranking; at most max_features if given."""
    ranked = rank_scores(informative(scores)) if "rank" not in scores.columns else informative(scores)
    first = ranked.groupBy("fold", "feature").agg(F.min(F.struct("rank", "algorithm")).alias("turn"))
    order = Window.partitionBy("fold").orderBy("turn.rank", "turn.algorithm")
    picked = first.withColumn("pick", F.row_number().over(order))
    if max_features is not None:
        picked = picked.where(F.col("pick") <= max_features)
    return picked.select("fold", "feature", "pick")


def select_fold_features(long: DataFrame, selected: DataFrame, groups: int | None = None) -> DataFrame:
    """Rows of the features selected for that model index; train and test alike."""
    wanted = small_side(selected.select(F.col("fold").alias("cv"), "feature"), groups)
    return long.join(wanted, ["cv", "feature"], "left_semi")


def select_features(long: DataFrame, scores: DataFrame, max_features: int | None = None, groups: int | None = None) -> DataFrame:
    """Informative, capped, then applied to the long fold table."""
    return select_fold_features(long, cap_features(scores, max_features), groups)


def selected_lists(selected: DataFrame, order: list[str]) -> dict[int, list[str]]:
    """Chosen features of each fold in table order (folds x features rows at most)."""
    chosen: dict[int, set[str]] = {}
    for row in selected.select("fold", "feature").collect():
        chosen.setdefault(row["fold"], set()).add(row["feature"])
    return {f: [name for name in order if name in names] for f, names in chosen.items()}
