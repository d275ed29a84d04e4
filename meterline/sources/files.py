"""File sources and sinks: inventory, typed load, load stats, tenant scans, batch writes.

* Inventory lists files through the ``binaryFile`` source with the content
  column pruned: only path, length and modification time are read.
* All pending files of a landing table are read by ONE parallel strict
  read. Only when that read fails are the files examined (footers one by
  one, contents by parallel reads): unreadable ones are reported, files whose column types differ are
  loaded through ``typed_load``, where values that do not cast go to a
  rejects frame instead of failing the load.
* Landing rows are appended under a load id and become visible when the
  log completes that load (``streaming.incremental``).
* Batch writes are idempotent: parquet partitioned by (customer, batch_id)
  with dynamic partition overwrite. A job names the partitions it
  processed, and a marker row stands in each of them, so a partition whose
  rows are all gone is replaced too (``replace_batches``).
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLUMNS = ("customer", "batch_id")
FOOTER_THREADS = 16  # footers asked for at a time, each by a job of one task


# --- I1 -----------------------------------------------------------------
def root_pattern(root: str) -> str:
    """Regex splitting a listed path into (location up to the root, path below it).

    Matches whatever scheme prefix the listing adds (``file:/``, ``s3://``).
    """
    anchor = "/" + re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "", root).strip("/") + "/"
    return r"^(.*?\Q" + anchor + r"\E)(.*)$"


def file_inventory(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """One row per file under ``root``: location, file_name, size, modified.

    ``file_name`` is the path below ``root`` (``<table folder>/.../<file>``);
    ``location`` is the root as listed, so ``location || file_name`` is the file.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
          .option("recursiveFileLookup", "true").load(root)
          .select("path", "length", "modificationTime"))
    rx = root_pattern(root)
    return df.select(
        F.regexp_extract("path", rx, 1).alias("location"),
        F.regexp_extract("path", rx, 2).alias("file_name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    ).dropDuplicates(["location", "file_name"])


def table_of(file_name: Column) -> Column:
    """Landing table of a file: its first path part + ``_raw``."""
    return F.concat(F.lower(F.split(file_name, "/").getItem(0)), F.lit("_raw"))


# --- I4 -----------------------------------------------------------------
def source_file() -> Column:
    """Path of the row's file as listed (the metadata column is URL-encoded; a plus sign is literal in it)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_landing(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None,
                 batch_id: str | None = None) -> DataFrame:
    """One parallel strict read of all given files: any unreadable file fails it.

    ``schema=None``: with the files' own columns.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*paths).withColumn("_source_file", source_file())
    if batch_id is not None:
        df = df.withColumn("batch_id", F.lit(batch_id))
    return df


def bare_path(path: str) -> str:
    """A path without its scheme, however many slashes follow it."""
    return "/" + path.split(":", 1)[-1].lstrip("/")


def examine(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, str | None, str | None]]:
    """(path, error, types) per file, found by Spark's own reader.

    ``error`` is NULL for a readable file; ``types`` names its columns' types,
    taken from its footer. A file is damaged when decoding all its columns
    gives fewer rows than its footer counts. No file's contents become a row,
    so files may have any size.
    """
    def footer(path: str) -> tuple[str, str | None, str | None]:
        try:
            fields = spark.read.parquet(path).schema.fields
            return path, None, ",".join(sorted(f"{f.name.lower()}:{f.dataType.simpleString()}" for f in fields))
        except Exception as e:  # noqa: BLE001  whatever a damaged file raises is its error
            return path, f"{type(e).__name__}: {e}"[:500], None

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        found = list(pool.map(footer, paths))
    by_types: dict[str, list[str]] = {}
    for path, error, types in found:
        if error is None:
            by_types.setdefault(types, []).append(path)
    damage: dict[str, str] = {}
    for some in by_types.values():
        damage |= _damage(spark, some)
    return [(path, error or damage.get(path), None if path in damage else types) for path, error, types in found]


def _damage(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """{path: error} of the files, all with the same types, whose contents can't be decoded whole."""
    try:
        stated = _rows_by_file(spark.read.parquet(*paths), [])
        df = spark.read.option("ignoreCorruptFiles", True).parquet(*paths)
        decoded = _rows_by_file(df, df.columns)
    except Exception as e:  # noqa: BLE001  damage that the reader can't skip: find whose it is
        if len(paths) == 1:
            return {paths[0]: f"{type(e).__name__}: {e}"[:500]}
        half = len(paths) // 2
        return _damage(spark, paths[:half]) | _damage(spark, paths[half:])
    rows = {path: (decoded.get(bare_path(path), 0), stated.get(bare_path(path), 0)) for path in paths}
    return {path: f"{got} of {want} rows can be read" for path, (got, want) in rows.items() if got != want}


def _rows_by_file(df: DataFrame, decode: Sequence[str]) -> dict[str, int]:
    """Rows per file; the columns of ``decode`` are decoded, and with none of them the footers are counted."""
    sizes = [F.length(F.col(f"`{c}`").cast("string")).alias(f"n{k}") for k, c in enumerate(decode)]
    counted = df.select(source_file().alias("path"), *sizes).groupBy("path").agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(f"n{k}") for k in range(len(decode))])
    return {bare_path(r["path"]): r["rows"] for r in counted.collect()}


def typed_load(df: DataFrame, targets: Mapping[str, T.DataType], keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Cast text columns to their target types; split into (accepted, rejects).

    A row is rejected when a non-null value does not cast (``try_cast``
    gives NULL). Rejects keep the raw values and name the failing columns;
    nothing fails the load.
    """
    typed = df.withColumns({f"_t_{c}": F.col(c).try_cast(t) for c, t in targets.items()})
    bad = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & F.col(f"_t_{c}").isNull(), F.lit(c)) for c in targets]))
    typed = typed.withColumn("_bad", bad)
    accepted = (typed.where(F.size("_bad") == 0)
                .select(*keep, *[F.col(f"_t_{c}").alias(c) for c in targets]))
    rejects = (typed.where(F.size("_bad") > 0)
               .select(*keep, *[F.col(c).alias(f"{c}_raw") for c in targets],
                       F.array_join("_bad", ",").alias("error_columns")))
    return accepted, rejects


# --- I7 -----------------------------------------------------------------
def batch_load_stats(accepted: DataFrame, rejects: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows, rejected rows, first and last data time per load unit (file or batch)."""
    a = accepted.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_cnt"), F.min(ts).alias("data_min"),
                                    F.max(ts).alias("data_max"))
    r = rejects.groupBy(*keys).agg(F.count(F.lit(1)).alias("error_cnt"))
    return (a.join(r, list(keys), "full")
            .select(*keys, F.coalesce("row_cnt", F.lit(0)).cast("long").alias("row_cnt"),
                    F.coalesce("error_cnt", F.lit(0)).cast("long").alias("error_cnt"),
                    "data_min", "data_max"))


# --- I9 -----------------------------------------------------------------
def tenant_batch_scan(spark: SparkSession, path: str, customer: str, batch_id: str,
                      columns: Sequence[str] | None = None) -> DataFrame:
    """Read one tenant's batch: both filters prune partitions (PartitionFilters)."""
    df = spark.read.parquet(path).where((F.col("customer") == customer) & (F.col("batch_id") == batch_id))
    return df.select(*columns) if columns else df


# --- I6, I10 ---------------------------------------------------------------
MARKER = "_marker"


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought together by the columns that a table is partitioned by, so files follow bytes, not tasks.

    REBALANCE lets adaptive execution size the parts: small table partitions
    share a task and a large one is split into files of the advisory size,
    however many rows one tenant or batch has.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def write_batch(df: DataFrame, path: str, partition_by: Sequence[str] = PARTITION_COLUMNS) -> None:
    """Idempotent write: the batch's partitions are replaced, others untouched."""
    (clustered(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def replace_batches(df: DataFrame, path: str, processed: DataFrame) -> None:
    """Replace every partition in ``processed`` (customer, batch_id), also those that ``df`` has no row for."""
    markers = processed.select(*PARTITION_COLUMNS).distinct().withColumn(MARKER, F.lit(True))
    write_batch(df.withColumn(MARKER, F.lit(None).cast("boolean")).unionByName(markers, allowMissingColumns=True), path)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """A table written by ``replace_batches``, without its markers."""
    df = spark.read.parquet(path)
    return df.where(F.col(MARKER).isNull()).drop(MARKER) if MARKER in df.columns else df


def append_load(df: DataFrame, path: str) -> None:
    """Append rows under their load id (a partition column next to customer and batch)."""
    by = (*PARTITION_COLUMNS, "load_id")
    clustered(df, by).write.mode("append").partitionBy(*by).parquet(path)
