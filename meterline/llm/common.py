"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import scratch_path

# Rows in one Arrow batch: a batch of very long texts (100 KB each) stays near 25 MB.
ARROW_ROWS = 256


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of an Arrow batch, so that long texts fit a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads the table instead of
    recomputing what led to it, and every reader sees the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def free_name(names: Iterable[str], base: str) -> str:
    """``base``, prefixed until no column of ``names`` has it (case-insensitive)."""
    taken = {n.lower() for n in names}
    while base.lower() in taken:
        base = "_" + base
    return base


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
