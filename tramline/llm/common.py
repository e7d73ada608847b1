"""What the operators share: reading tables, cutting lineage, and Arrow plumbing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.plans.lineage import cut, drop, fresh_path, shared_dir

__all__ = ["cut", "drop", "filtered", "fresh_path", "shared_dir", "slices", "table", "texts", "utf8"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(name: str):
    """A text column as its UTF-8 bytes; null as no bytes."""
    return F.coalesce(F.col(name).cast("string").cast("binary"), F.lit(b"")).alias(name)


def slices(batch: pa.RecordBatch, most: int = 8 << 20, column: int = 1) -> list[pa.RecordBatch]:
    """batch in slices of about most bytes of one column, so that what is made of a slice stays small; a longer value
    is a slice of its own."""
    if not batch.num_rows:
        return []
    sizes = pc.binary_length(batch.column(column).cast(pa.large_binary())).fill_null(0).to_numpy()
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // most)) + 1
    bounds = [0, *cuts.tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def texts(column: pa.Array) -> list[bytes]:
    """A text column's values as UTF-8 bytes; null as no bytes."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [x or b"" for x in column.to_pylist()]


def filtered(docs: DataFrame, keep) -> DataFrame:
    """The rows of docs, all columns, for which keep (a maker of functions from texts to flags, called once a task)
    says so; the text crosses to Python once and nothing is joined."""
    at = docs.columns.index("text")

    def run(batches):
        flags = keep()
        for batch in batches:
            for some in slices(batch, column=at):
                yield some.filter(pa.array(flags(texts(some.column(at))), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
