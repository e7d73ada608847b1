"""Resumable processing: what a cursor file did, by the checkpoint of a stream that ends when it has caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tramline.sources import files


def run_available(spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df, files_at_once: int = 1000) -> int:
    """Applies transform to the Parquet files of source that earlier runs with this checkpoint haven't taken, appends
    the result to target, and returns how many rows it read. Each file is taken once, even if a run breaks off."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source)
    query = transform(rows).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def after(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows beyond the largest key that was done; all if nothing was."""
    last = done.agg(F.max(key)).scalar()
    return rows.filter(last.isNull() | (F.col(key) > last))


def append_new(rows: DataFrame, target: str, key: str) -> None:
    """Adds to the Parquet table at target the rows beyond its largest key; makes the table if there is none."""
    spark = rows.sparkSession
    if files.exists(spark, target):
        rows = after(rows, spark.read.parquet(target), key)
    rows.write.mode("append").parquet(target)
