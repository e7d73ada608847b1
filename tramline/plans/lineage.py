"""Cutting the lineage of plans in the folder that driver and executors share (spark.checkpoint.dir).

A cut is a Parquet table there: it survives lost executors, its statistics are those of its files (a checkpointed
plan keeps estimates, and these multiply at every join of a loop until planning itself never ends), and a join deals
it out anew, so that Spark can split a hot key's partition.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where that is unset, a folder of its own on a local master, which is one
    machine; elsewhere an error, as each executor would write to its own disk."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="tramline-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def own_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one."""
    return f"{shared_dir(spark)}/tramline-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, kind: str) -> str:
    return f"{own_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clean(spark: SparkSession) -> None:
    """Removes all that this application wrote to the shared folder; results that read from it must be written before."""
    remove(spark, own_dir(spark))


def cut(df: DataFrame) -> DataFrame:
    """df written once to the shared folder, and read from there."""
    path = fresh_path(df.sparkSession, "cut")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def drop(*cuts: DataFrame) -> None:
    """Removes the tables of cuts that nothing reads any more."""
    for df in cuts:
        remove(df.sparkSession, df._cut_path)
