"""Tables that are written once and read many times, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the cluster names it. Where it is unset, a local master (tests) gets a temporary folder; on a cluster that would be a folder of one machine, so there it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not hasattr(spark, "_tidemark_dir"):
        spark._tidemark_dir = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return spark._tidemark_dir


def _path(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def landed(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """df, written as Parquet and read again: what is used several times is worked out once, and a lost executor costs a read of it. The files go when the application ends, or with dropped()."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    where, fs = _path(spark, path)
    fs.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables, as landed() gave them, that no later plan reads."""
    for df in tables:
        where, fs = _path(df.sparkSession, df._tidemark_path)
        fs.delete(where, True)
