"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STATE = "sparkassay_worker_state"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def worker_state(name: str, make: Callable[[], Any]) -> Any:
    """An object that lives as long as the Python worker, so that later tasks of the same worker find it again."""
    holder = sys.modules.setdefault(STATE, ModuleType(STATE))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def small_batches(apply: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that write their result: while they run, about 4 MB of rows go to a Python worker at a time, so that
    wide rows take no more memory than narrow ones. A limit that the session sets itself stays."""

    @functools.wraps(apply)
    def limited(docs: DataFrame, **options: Any) -> DataFrame:
        conf = docs.sparkSession.conf
        if conf.get(BATCH_BYTES, None) is not None:
            return apply(docs, **options)
        conf.set(BATCH_BYTES, str(4 << 20))
        try:
            return apply(docs, **options)
        finally:
            conf.unset(BATCH_BYTES)

    return limited


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_numbers(n: int) -> Column:
    """The array 0, 1, ..., n - 1 of long numbers."""
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
