"""Feature importances combined over folds and algorithms.

``FI = (dataset, algorithm, fold, feature, score)``: runs x features rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.functions.columns import q
from sparkassay.operators.profile import boxplot_stats

RUN = ["dataset", "algorithm"]


def align_importance(fi: DataFrame, features: list[str]) -> DataFrame:
    """Every feature in every fold; 0 where it was not selected."""
    runs = fi.select("dataset", "algorithm", "fold").distinct()
    full = runs.withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    joined = full.join(fi, ["dataset", "algorithm", "fold", "feature"], "left")
    return joined.select("dataset", "algorithm", "fold", "feature", F.coalesce("score", F.lit(0.0)).alias("score"))


def fi_mean(fi: DataFrame) -> DataFrame:
    """Mean over folds of an aligned table."""
    return fi.groupBy("dataset", "algorithm", "feature").agg(F.avg("score").alias("mean_fi"))


def fi_normalize(means: DataFrame) -> DataFrame:
    """Share of the algorithm's largest mean; nothing at or below 0."""
    top = F.max("mean_fi").over(Window.partitionBy(*RUN))
    norm = F.when(F.col("mean_fi") > 0, F.col("mean_fi") / top).otherwise(F.lit(0.0))
    return means.withColumn("norm", norm)


def fi_nonzero_union(means: DataFrame) -> DataFrame:
    """Features with a positive mean in any algorithm."""
    return means.where(F.col("mean_fi") > 0).select("dataset", "feature").distinct()


def ba_weight(perf: DataFrame) -> DataFrame:
    """Weight of an algorithm: mean balanced accuracy scaled from .5..1 to 0..1."""
    ba = F.avg("value")
    rows = perf.where(F.col("metric") == "Balanced Accuracy")
    return rows.groupBy(*RUN).agg(F.greatest(F.lit(0.0), (ba - 0.5) / 0.5).alias("weight"))


def fi_top(means: DataFrame, perf: DataFrame, n: int | None = None) -> DataFrame:
    """Features by the weighted sum of normalised importances; all of them when n is None."""
    scored = fi_normalize(means).join(ba_weight(perf), RUN).join(fi_nonzero_union(means), ["dataset", "feature"], "left_semi")
    sums = scored.groupBy("dataset", "feature").agg(F.sum(F.col("norm") * F.col("weight")).alias("total"))
    order = Window.partitionBy("dataset").orderBy(F.desc(F.round("total", 12)), "feature")
    ranked = sums.withColumn("rank", F.row_number().over(order))
    return ranked if n is None else ranked.where(F.col("rank") <= n)


def fi_fraction(norms: DataFrame, value: str = "norm") -> DataFrame:
    """Share within the algorithm over the rows given (the top features)."""
    total = F.sum(q(value)).over(Window.partitionBy(*RUN))
    return norms.withColumn("fraction", F.when(total > 0, q(value) / total).otherwise(F.lit(0.0)))


def fi_weighted(norms: DataFrame, perf: DataFrame) -> DataFrame:
    """Normalised values and fractions times the algorithm's weight."""
    joined = fi_fraction(norms).join(ba_weight(perf), RUN)
    return joined.withColumn("weighted", F.col("norm") * F.col("weight")).withColumn(
        "weighted_fraction", F.col("fraction") * F.col("weight")
    )


# Names of the composite views.
MODES = {"Norm": "norm", "Norm_Frac": "fraction", "Norm_Weight": "weighted", "Norm_Frac_Weight": "weighted_fraction"}


def composite_fi(means: DataFrame, perf: DataFrame, mode: str, n: int | None = None) -> DataFrame:
    """Stacked bars: value and base of each algorithm's part per top feature."""
    top = fi_top(means, perf, n).select("dataset", "feature", "rank")
    rows = fi_weighted(fi_normalize(means).join(top, ["dataset", "feature"]), perf)
    below = Window.partitionBy("dataset", "feature").orderBy("algorithm").rowsBetween(Window.unboundedPreceding, -1)
    value = F.col(MODES[mode])
    return rows.select(
        "dataset", "feature", "rank", "algorithm", value.alias("value"), F.coalesce(F.sum(value).over(below), F.lit(0.0)).alias("base")
    )


def fi_rank_table(fi: DataFrame) -> DataFrame:
    """Average-tie rank of mean |importance| per algorithm, and the mean rank over algorithms."""
    size = fi.groupBy("dataset", "algorithm", "feature").agg(F.round(F.avg(F.abs("score")), 12).alias("size"))
    same = F.count(F.lit(1)).over(Window.partitionBy(*RUN, "size"))
    rank = F.rank().over(Window.partitionBy(*RUN).orderBy(F.desc("size"))) + (same - 1) / 2.0
    ranked = size.withColumn("rank", rank)
    mean = F.avg("rank").over(Window.partitionBy("dataset", "feature"))
    return ranked.select("dataset", "algorithm", "feature", "rank", mean.alias("mean_rank"))


def fi_boxplot_data(fi: DataFrame, n: int) -> DataFrame:
    """Box statistics over folds of each algorithm's top n features."""
    means = fi.groupBy(*RUN, "feature").agg(F.round(F.avg("score"), 12).alias("m"))
    order = Window.partitionBy(*RUN).orderBy(F.desc("m"), "feature")
    top = means.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= n)
    rows = fi.join(top.select(*RUN, "feature"), [*RUN, "feature"], "left_semi")
    return boxplot_stats(rows, "score", [*RUN, "feature"])
