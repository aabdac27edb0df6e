"""Summaries of metrics and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.operators.evaluate import METRICS


def _pivot(df: DataFrame, keys: list[str], agg) -> DataFrame:
    """One column per metric; the metric names are known, so no extra pass finds them."""
    return df.groupBy(*keys).agg(*[
        agg(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in METRICS
    ])


def performance_table(perf: DataFrame, algorithm: str) -> DataFrame:
    """Folds x 16 metrics of one algorithm."""
    return _pivot(perf.where(F.col("algorithm") == algorithm), ["dataset", "fold"], F.max)


def metric_means(perf: DataFrame) -> DataFrame:
    return _pivot(perf, ["dataset", "algorithm"], F.avg)


def metric_stds(perf: DataFrame) -> DataFrame:
    return _pivot(perf, ["dataset", "algorithm"], F.stddev_samp)


def dataset_trajectory(perf: DataFrame) -> DataFrame:
    """Mean of each metric and algorithm per data set: the lines over data sets."""
    return perf.groupBy("dataset", "algorithm", "metric").agg(F.avg("value").alias("mean"))


def best_fold(perf: DataFrame, algorithm: str, metric: str) -> DataFrame:
    """Fold with the largest value, the first on ties."""
    rows = perf.where((F.col("algorithm") == algorithm) & (F.col("metric") == metric))
    order = Window.partitionBy("dataset").orderBy(F.desc("value"), "fold")
    return rows.withColumn("rn", F.row_number().over(order)).where(F.col("rn") == 1).select("dataset", "fold", "value")


def runtime_summary(run_log: DataFrame) -> DataFrame:
    return run_log.groupBy("dataset", "component").agg(F.sum("seconds").alias("seconds"))


def missing_runs(expected: DataFrame, done: DataFrame) -> DataFrame:
    """Planned runs without a log line: the list for a re-run."""
    return expected.join(done, ["dataset", "fold", "component"], "left_anti")
