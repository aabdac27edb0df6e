"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "sparkassay", **conf) -> SparkSession:
    """A session with adaptive execution on; cluster settings come from ``conf`` or spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="sparkassay-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_written(*tables: DataFrame) -> None:
    """Delete what ``cut_lineage`` wrote of tables that are not read again; files outside the shared folder are an error."""
    for df in tables:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        shared = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
        shared = shared.getFileSystem(conf).makeQualified(shared)
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            fs = path.getFileSystem(conf)
            if fs.makeQualified(path).getParent().toString() != shared.toString():
                raise ValueError(f"{folder} was not written by cut_lineage")
            fs.delete(path, True)
