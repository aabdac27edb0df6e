"""Data sets from files."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkassay.functions.columns import q


def read_dataset(
    spark: SparkSession, path: str, sep: str | None = None, schema: StructType | str | None = None,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """A table with a header: comma for .csv, tab for other text; empty, NA and NaN are missing.

    Give a schema, or a sampling ratio, for large text files; parquet and ORC carry theirs.
    """
    ending = posixpath.splitext(path.rstrip("/"))[1].lower()
    if ending in (".parquet", ".orc"):
        return without_nan(spark.read.format(ending[1:]).load(path))
    reader = spark.read.option("header", True).option("nullValue", "NA")
    reader = reader.option("sep", sep or ("," if ending == ".csv" else "\t"))
    if schema is not None:
        return without_nan(reader.schema(schema).csv(path))
    return without_nan(reader.option("inferSchema", True).option("samplingRatio", sampling_ratio).csv(path))


def without_nan(df: DataFrame) -> DataFrame:
    """NaN becomes missing in every float column."""
    new = {n: F.when(~F.isnan(q(n)), q(n)) for n, kind in df.dtypes if kind in ("double", "float")}
    return df.withColumns(new) if new else df


def read_datasets(spark: SparkSession, folder: str, **options) -> dict[str, DataFrame]:
    """Every .csv/.txt of a folder by base name, files and folders of parts alike; only names are listed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    names = [one.getPath().toString() for one in listed]
    paths = sorted(name for name in names if posixpath.splitext(name)[1].lower() in (".csv", ".txt"))
    if not paths:
        raise ValueError(f"no .csv or .txt data set in {folder}")
    found: dict[str, DataFrame] = {}
    for path in paths:
        name = posixpath.splitext(posixpath.basename(path))[0]
        if name not in found:
            found[name] = read_dataset(spark, path, **options)
    return found


def union_datasets(datasets: dict[str, DataFrame]) -> DataFrame:
    """All data sets in one frame with a ``dataset`` column; absent columns become missing."""
    parts = [df.withColumn("dataset", F.lit(name)) for name, df in datasets.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_name_list(spark: SparkSession, path: str) -> list[str]:
    """Feature names stored as the header row of a CSV file."""
    return [c.strip() for c in spark.read.option("header", True).csv(path).columns]
