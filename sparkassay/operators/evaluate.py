"""Metrics and curves of predictions ``(dataset, algorithm, fold, inst_id, y, p)``.

Everything threshold-free comes from one table: the distinct scores of a run with
running class counts. A row knows the curve point before it and its own, so areas,
average precision and interpolation need no further window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.functions.columns import q, ratio
from sparkassay.functions.kernels import value_totals

RUN = ["dataset", "algorithm", "fold"]

# Metric names of the result tables.
COUNT_METRICS = {
    "Balanced Accuracy": "balanced_accuracy",
    "Accuracy": "accuracy",
    "F1_Score": "f1",
    "Sensitivity (Recall)": "recall",
    "Specificity": "specificity",
    "Precision (PPV)": "precision",
    "TP": "tp",
    "TN": "tn",
    "FP": "fp",
    "FN": "fn",
    "NPV": "npv",
    "LR+": "lr_plus",
    "LR-": "lr_minus",
}
CURVE_METRICS = {"ROC_AUC": "roc_auc", "PRC_AUC": "prc_auc", "PRC_APS": "aps"}
METRICS = {**COUNT_METRICS, **CURVE_METRICS}


def _cells(positive: Column, weight1: Column, weight0: Column) -> list[Column]:
    def total(cond, weight):
        return F.coalesce(F.sum(F.when(cond, weight)), F.lit(0)).cast("long")

    return [
        total(positive, weight1).alias("tp"), total(~positive, weight0).alias("tn"),
        total(positive, weight0).alias("fp"), total(~positive, weight1).alias("fn"),
    ]


def confusion(pred: DataFrame, threshold: float = 0.5, keys: list[str] = RUN) -> DataFrame:
    """tp, tn, fp, fn per run; positive when p is above the threshold."""
    one = F.col("y").cast("long")
    return pred.groupBy(*[q(k) for k in keys]).agg(*_cells(F.col("p") > F.lit(threshold), one, 1 - one))


def with_class_metrics(counts: DataFrame) -> DataFrame:
    """Add the ratio metrics to tp, tn, fp, fn; a zero denominator gives 0."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    recall, precision, sp = ratio(tp, tp + fn), ratio(tp, tp + fp), ratio(tn, tn + fp)
    balanced = (
        F.when(tp + fn == 0, sp).when(tn + fp == 0, recall).otherwise((recall + sp) / 2.0)
    )
    return counts.select(
        *[q(c) for c in counts.columns],
        balanced.alias("balanced_accuracy"),
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        recall.alias("recall"),
        sp.alias("specificity"),
        precision.alias("precision"),
        ratio(tn, tn + fn).alias("npv"),
        F.when(sp == 1, F.lit(0.0)).otherwise(recall / (1 - sp)).alias("lr_plus"),
        F.when(sp == 0, F.lit(0.0)).otherwise((1 - recall) / sp).alias("lr_minus"),
    )


def class_metrics(pred: DataFrame, threshold: float = 0.5, keys: list[str] = RUN) -> DataFrame:
    return with_class_metrics(confusion(pred, threshold, keys))


# --- curves --------------------------------------------------------------------------------


def curve_points(pred: DataFrame, keys: list[str] = RUN, groups: int | None = None) -> DataFrame:
    """One row per distinct score, highest first, with running counts of both classes."""
    sums = {"n1": F.count_if(F.col("y") == 1), "n0": F.count_if(F.col("y") == 0)}
    return value_totals(pred, keys, "p", sums, groups, descending=True)


def _precision_here() -> Column:
    return F.col("cum_n1") / (F.col("cum_n1") + F.col("cum_n0"))


def _precision_before() -> Column:
    before1, before0 = F.col("cum_n1") - F.col("n1"), F.col("cum_n0") - F.col("n0")
    return F.when(before1 + before0 == 0, F.lit(1.0)).otherwise(before1 / (before1 + before0))


def _is_first() -> Column:
    return (F.col("cum_n1") == F.col("n1")) & (F.col("cum_n0") == F.col("n0"))


def _is_last() -> Column:
    return (F.col("cum_n1") == F.col("tot_n1")) & (F.col("cum_n0") == F.col("tot_n0"))


def _with_start(points: DataFrame, keys: list[str], here: list[Column], start: list[Column]) -> DataFrame:
    """Curve rows plus the fixed start point, made from the first row instead of a union."""
    own = F.struct(*here)
    rows = F.when(_is_first(), F.array(F.struct(*start), own)).otherwise(F.array(own))
    return points.select(*[q(k) for k in keys], F.inline(rows))


def roc_curve(pred: DataFrame, keys: list[str] = RUN, groups: int | None = None) -> DataFrame:
    """threshold, fpr, tpr; tied scores are one point; the start (0, 0) has no threshold."""
    here = [
        F.col("p").alias("threshold"),
        F.try_divide("cum_n0", "tot_n0").alias("fpr"),
        F.try_divide("cum_n1", "tot_n1").alias("tpr"),
    ]
    zero = F.lit(0.0)
    start = [F.lit(None).cast("double").alias("threshold"), zero.alias("fpr"), zero.alias("tpr")]
    return _with_start(curve_points(pred, keys, groups), keys, here, start)


def pr_curve(pred: DataFrame, keys: list[str] = RUN, groups: int | None = None) -> DataFrame:
    """threshold, precision, recall; the end (1, 0) has no threshold."""
    here = [
        F.col("p").alias("threshold"), _precision_here().alias("precision"),
        F.try_divide("cum_n1", "tot_n1").alias("recall"),
    ]
    start = [F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")]
    return _with_start(curve_points(pred, keys, groups), keys, here, start)


def _area_columns() -> dict[str, Column]:
    n1, n0, all1, all0 = F.col("n1"), F.col("n0"), F.col("tot_n1"), F.col("tot_n0")
    below = F.col("cum_n1") - n1
    step = F.try_divide(n1, all1)
    return {  # NULL where a class is absent
        "roc_auc": F.sum(F.try_divide(n0, all0) * F.try_divide(below + n1 / 2.0, all1)),
        "prc_auc": F.sum(step * (_precision_here() + _precision_before()) / 2.0),
        "aps": F.sum(step * _precision_here()),
    }


def areas(pred: DataFrame, keys: list[str] = RUN, groups: int | None = None) -> DataFrame:
    """ROC AUC, PR AUC (both trapezoid) and average precision per run."""
    points = curve_points(pred, keys, groups)
    return points.groupBy(*[q(k) for k in keys]).agg(*[c.alias(n) for n, c in _area_columns().items()])


def roc_auc(pred: DataFrame, keys: list[str] = RUN, groups: int | None = None) -> DataFrame:
    return areas(pred, keys, groups).select(*[q(k) for k in keys], "roc_auc")


def pr_auc(pred: DataFrame, keys: list[str] = RUN, groups: int | None = None) -> DataFrame:
    return areas(pred, keys, groups).select(*[q(k) for k in keys], "prc_auc")


def average_precision(pred: DataFrame, keys: list[str] = RUN, groups: int | None = None) -> DataFrame:
    return areas(pred, keys, groups).select(*[q(k) for k in keys], "aps")


def all_metrics(
    pred: DataFrame, threshold: float = 0.5, keys: list[str] = RUN, groups: int | None = None
) -> DataFrame:
    """The 16 metrics, one column each; counts and areas from the same pass."""
    points = curve_points(pred, keys, groups)
    wide = points.groupBy(*[q(k) for k in keys]).agg(
        *_cells(F.col("p") > F.lit(threshold), F.col("n1"), F.col("n0")),
        *[c.alias(n) for n, c in _area_columns().items()],
    )
    return with_class_metrics(wide)


def apply_threshold(
    pred: DataFrame, threshold: float, keys: list[str] = RUN, groups: int | None = None
) -> DataFrame:
    """All metrics with another decision threshold (positive when p is above it)."""
    return all_metrics(pred, threshold, keys, groups)


def evaluate(pred: DataFrame, keys: list[str] = RUN, groups: int | None = None, threshold: float = 0.5) -> DataFrame:
    """Long table ``(run keys, metric, value)`` of all 16 metrics."""
    wide = all_metrics(pred, threshold, keys, groups)
    items = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(col).cast("double").alias("value"))
        for name, col in METRICS.items()
    ])
    return wide.select(*[q(k) for k in keys], F.inline(items))


def score(pred: DataFrame, metric: str, keys: list[str] = RUN, groups: int | None = None) -> DataFrame:
    """One primary metric per run, as ``score``."""
    if metric in ("balanced_accuracy", "accuracy", "f1", "recall", "precision"):
        return class_metrics(pred, keys=keys).select(*[q(k) for k in keys], F.col(metric).alias("score"))
    if metric == "roc_auc":
        return roc_auc(pred, keys, groups).select(*[q(k) for k in keys], F.col(metric).alias("score"))
    raise ValueError(f"unknown primary metric: {metric}")


# --- thresholds ----------------------------------------------------------------------------


def threshold_sweep(pred: DataFrame, keys: list[str] = RUN, steps: int = 100) -> DataFrame:
    """Counts and rates at t = 0, 1/steps ... 1, positive when p >= t.

    A row is counted once, at the highest t it reaches; totals from the top give every t.
    """
    near = F.floor(F.col("p") * steps)
    spot = (
        F.when((near + 1) / F.lit(float(steps)) <= F.col("p"), near + 1)
        .when(near / F.lit(float(steps)) > F.col("p"), near - 1)
        .otherwise(near)
    )
    spot = F.least(F.greatest(spot, F.lit(-1)), F.lit(steps)).cast("int")
    counts = pred.groupBy(*[q(k) for k in keys], spot.alias("i")).agg(
        F.count_if(F.col("y") == 1).alias("n1"), F.count_if(F.col("y") == 0).alias("n0")
    )
    runs = counts.groupBy(*[q(k) for k in keys]).agg(F.sum("n1").alias("all1"), F.sum("n0").alias("all0"))
    grid = runs.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    down = Window.partitionBy(*[q(k) for k in keys]).orderBy(F.desc("i"))
    return (
        grid.join(counts, [*keys, "i"], "left")
        .withColumn("tp", F.sum(F.coalesce("n1", F.lit(0))).over(down))
        .withColumn("fp", F.sum(F.coalesce("n0", F.lit(0))).over(down))
        .select(
            *[q(k) for k in keys], (F.col("i") / F.lit(float(steps))).alias("threshold"),
            "tp", "fp", (F.col("all1") - F.col("tp")).alias("fn"), (F.col("all0") - F.col("fp")).alias("tn"),
            ratio(F.col("fp"), F.col("all0")).alias("fpr"), ratio(F.col("tp"), F.col("all1")).alias("tpr"),
        )
    )


# --- mean curves ---------------------------------------------------------------------------


def interpolated_curve(
    pred: DataFrame, kind: str, keys: list[str] = RUN, n: int = 100, groups: int | None = None
) -> DataFrame:
    """Each run's curve at n evenly spaced x. A segment emits the grid points it covers.

    Grid positions are found in whole numbers, so a point falling exactly on the grid
    is never lost to rounding.
    """
    points = curve_points(pred, keys, groups)
    axis = "n0" if kind == "roc" else "n1"
    here, total = F.col(f"cum_{axis}"), F.col(f"tot_{axis}")
    last = n - 1

    def first_at_or_after(count: Column) -> Column:
        return F.floor(F.try_divide(count * last + total - 1, total)).cast("int")

    if kind == "roc":
        y0, y1 = F.try_divide(F.col("cum_n1") - F.col("n1"), "tot_n1"), F.try_divide("cum_n1", "tot_n1")
        end = F.lit(1.0)
    else:
        y0, y1 = _precision_before(), _precision_here()
        end = _precision_here()
    x0, x1 = F.try_divide(here - F.col(axis), total), F.try_divide(here, total)
    lo, hi = first_at_or_after(here - F.col(axis)), first_at_or_after(here) - 1
    covered = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    covered = F.when(_is_last(), F.concat(covered, F.array(F.lit(last)))).otherwise(covered)
    rows = points.select(
        *[q(k) for k in keys], x0.alias("__x0"), x1.alias("__x1"), y0.alias("__y0"), y1.alias("__y1"),
        end.alias("__end"), F.explode(covered).alias("i"),
    )
    x = F.col("i") / F.lit(float(last))
    slope = F.try_divide(F.col("__y1") - F.col("__y0"), F.col("__x1") - F.col("__x0"))
    y = F.when(F.col("i") == last, F.col("__end")).otherwise(F.col("__y0") + slope * (x - F.col("__x0")))
    if kind == "roc":
        y = F.when(F.col("i") == 0, F.lit(0.0)).otherwise(y)
    return rows.select(*[q(k) for k in keys], "i", x.alias("x"), y.alias("y"))


def mean_curve(
    pred: DataFrame, kind: str, keys: list[str] = RUN, n: int = 100, groups: int | None = None
) -> DataFrame:
    """Mean of the folds' curves with a band of one population sd, clipped to [0, 1]."""
    over = [k for k in keys if k != "fold"]
    curves = interpolated_curve(pred, kind, keys, n, groups)
    out = curves.groupBy(*[q(k) for k in over], "i", "x").agg(
        F.avg("y").alias("mean"), F.stddev_pop("y").alias("sd")
    )
    return out.select(
        *[q(k) for k in over], "x", "mean",
        F.greatest(F.col("mean") - F.col("sd"), F.lit(0.0)).alias("lower"),
        F.least(F.col("mean") + F.col("sd"), F.lit(1.0)).alias("upper"),
    )


def curve_summary(perf: DataFrame) -> DataFrame:
    """Mean ROC AUC, PR AUC and average precision of each algorithm."""
    picked = [F.avg(F.when(F.col("metric") == m, F.col("value"))).alias(c) for m, c in CURVE_METRICS.items()]
    return perf.groupBy("dataset", "algorithm").agg(*picked)


def case_probabilities(pred: DataFrame, labels: DataFrame, algorithms: list[str], inst: str = "inst_id") -> DataFrame:
    """Class, instance label and p of each algorithm per case, matched on the label."""
    wide = pred.groupBy("dataset", "fold", q(inst)).agg(
        *[F.max(F.when(F.col("algorithm") == a, F.col("p"))).alias(f"p_{a}") for a in algorithms]
    )
    return wide.join(labels, inst)
