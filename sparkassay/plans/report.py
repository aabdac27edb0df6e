"""The tables behind the written report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkassay.functions.columns import q
from sparkassay.operators.significance import best_algorithm, compare_best
from sparkassay.operators.summarize import metric_means, runtime_summary

# Metrics named in the report's "best algorithm" box.
BEST_BY = ["ROC_AUC", "Balanced Accuracy", "F1_Score", "PRC_AUC", "PRC_APS"]


def _rounded(df: DataFrame, digits: int) -> DataFrame:
    doubles = {n for n, t in df.dtypes if t == "double"}
    return df.select(*[F.round(q(c), digits).alias(c) if c in doubles else q(c) for c in df.columns])


def report_best(perf: DataFrame) -> DataFrame:
    """Best algorithm by five metrics, three decimals."""
    best = best_algorithm(perf).where(F.col("metric").isin(BEST_BY))
    return best.select("dataset", "metric", "algorithm", F.round("mean", 3).alias("value"))


def report_means(perf: DataFrame) -> DataFrame:
    return _rounded(metric_means(perf), 4)


def report_best_comparison(perf: DataFrame, datasets: list[str], cutoff: float = 0.05) -> DataFrame:
    """Kruskal table of the best algorithms without statistic, flag and sd."""
    table = compare_best(perf, "kruskal", datasets, cutoff)
    keep = [c for c in table.columns if c not in ("statistic", "sig") and not c.startswith("std_")]
    return _rounded(table.select(*keep), 4)


def report_runtimes(run_log: DataFrame) -> DataFrame:
    return _rounded(runtime_summary(run_log), 2)


def report_tables(
    settings: DataFrame, counts: DataFrame, perf: DataFrame, run_log: DataFrame, datasets: list[str], cutoff: float = 0.05
) -> dict[str, DataFrame]:
    out = {
        "settings": settings,
        "counts": counts,
        "best": report_best(perf),
        "means": report_means(perf),
        "runtimes": report_runtimes(run_log),
    }
    if len(datasets) > 1:
        out["best_comparison"] = report_best_comparison(perf, datasets, cutoff)
    return out
