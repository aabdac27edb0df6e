"""Written tables: folds, stages, fitted state, settings, results, run times."""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkassay.functions.columns import q


def write_folds(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One copy of the data, partitioned by fold so a fold filter prunes files.

    The rebalance hint makes few, even files per fold and splits a fold that is large.
    """
    df.hint("rebalance", q("fold")).write.mode(mode).partitionBy("fold").parquet(path)


def read_folds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_stage(df: DataFrame, path: str, stage: str, overwrite: bool = True) -> str:
    """A prepared version of the fold table; earlier stages stay unless they are overwritten."""
    target = f"{path}/stage={stage}"
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(target)
    return target


def save_state(state: DataFrame, path: str, name: str, overwrite: bool = True) -> str:
    """Fitted parameters (a small table) under a name."""
    target = f"{path}/{name}"
    state.write.mode("overwrite" if overwrite else "errorifexists").parquet(target)
    return target


def load_state(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}")


def settings_table(spark: SparkSession, settings: dict) -> DataFrame:
    """Run parameters as ``(setting, value)`` rows, read by key."""
    rows = [(str(k), "" if v is None else str(v)) for k, v in settings.items()]
    return spark.createDataFrame(rows, "setting string, value string")


def write_result(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def log_runtime(spark: SparkSession, path: str, dataset: str, fold: int | None, component: str, seconds: float) -> None:
    """Append one line to the run log."""
    schema = "dataset string, fold int, component string, seconds double"
    spark.createDataFrame([(dataset, fold, component, float(seconds))], schema).write.mode("append").parquet(path)


@contextmanager
def timed(spark: SparkSession, path: str, dataset: str, component: str, fold: int | None = None):
    start = time.time()
    yield
    log_runtime(spark, path, dataset, fold, component, time.time() - start)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("dataset", F.col("fold"), "component", "seconds")
