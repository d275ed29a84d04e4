"""Upkeep of loaded tables: rejects replayed, rows of broken loads removed, rows sent again left out.

* ``replay_rejects``: rows that did not cast are parsed again from their stored
  text under corrected types or repairs and published as a load of its own.
* ``clean_unpublished``: partitions of loads that the log never published.
* ``first_sent``: rows of a batch that no earlier batch has sent, by stored digests.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.schemas import LANDING, REJECTS
from meterline.sources import loadlog as LG
from meterline.sources.files import append_load, clustered, typed_load
from meterline.streaming.incremental import REJECTS_TABLE, append_log, read_log, read_or_empty

REPLAYS_TABLE = "load_replays"
REMOVED = "Removed"
LOADS_PER_CLEANING = 1_000
FILTER_BITS = (16, 26)  # smallest and largest power of two: the filter has 8 MB at most

_REPLAYED = T.StructType([*[f for f in REJECTS.fields if f.name in ("table_name", "file_name", "raw_row")],
                          T.StructField("rejected_by", T.StringType()), T.StructField("load_id", T.StringType())])


def _entry(spark: SparkSession, name: str, source: str) -> DataFrame:
    """An opening log row that stands for an action, not for a landing file."""
    now = spark.range(1).select(F.current_timestamp().alias("t")).first().t
    return LG.log_open(spark.createDataFrame([(name, None)], "file_name string, location string"), source, now)


# --- I4: rejects ------------------------------------------------------------------
def open_rejects(spark: SparkSession, target_root: str, log: DataFrame) -> DataFrame:
    """Rejected rows of published loads that no published replay has landed."""
    published = LG.published_loads(log)
    rejects = read_or_empty(spark, f"{target_root}/{REJECTS_TABLE}", REJECTS).join(published, "load_id", "left_semi")
    replayed = read_or_empty(spark, f"{target_root}/{REPLAYS_TABLE}", _REPLAYED).join(published, "load_id", "left_semi")
    keys = ["table_name", "file_name", "raw_row", "rejected_by"]
    return rejects.withColumnRenamed("load_id", "rejected_by").join(replayed.select(*keys), keys, "left_anti")


def replay_rejects(spark: SparkSession, target_root: str, log_path: str, source: str = "FM", schemas: Mapping = LANDING,
                   repairs: Mapping[str, Mapping[str, Callable[[Column], Column]]] | None = None) -> str | None:
    """Land the rejected rows that now cast; returns the load id, or NULL when there is none.

    ``repairs``: per table and column, what turns its rejected text into one
    that casts. Rows that still don't cast stay rejected, under the load that
    rejected them. Rows, replay marks and the log row carry one load id, and
    nothing of them is visible before the log row: a broken replay is as if it
    had not been, and a second one finds nothing left to land. A row keeps its
    batch and its file.
    """
    log = read_log(spark, log_path)
    left = open_rejects(spark, target_root, log).where(F.col("source_name") == source)
    load_id, landed = uuid.uuid4().hex, 0
    opened = _entry(spark, f"replay/{load_id}", source)
    append_log(opened.withColumn("load_id", F.lit(load_id)), log_path)
    for tbl in sorted(r[0] for r in left.select("table_name").distinct().collect()):  # a landing table each
        if tbl not in schemas:
            continue
        declared = {f.name: f.dataType for f in schemas[tbl].fields if f.name != "batch_id"}
        text = T.StructType([T.StructField(c, T.StringType()) for c in declared])
        rows = left.where(F.col("table_name") == tbl).withColumn("_row", F.from_json("raw_row", text))
        mend = (repairs or {}).get(tbl, {})
        rows = rows.select("file_name", "raw_row", "batch_id", "rejected_by",
                           *[(mend[c](F.col(f"_row.{c}")) if c in mend else F.col(f"_row.{c}")).alias(c) for c in declared])
        keep = {c: f"_{c}" for c in ("file_name", "raw_row", "batch_id", "rejected_by")}
        accepted, _ = typed_load(rows.withColumnsRenamed(keep), declared, keep=tuple(keep.values()))
        accepted = accepted.checkpoint()  # its rows and its marks are one decision
        n = accepted.count()
        if not n:
            continue
        landed += n
        marks = accepted.select(F.lit(tbl).alias("table_name"), *[F.col(v).alias(k) for k, v in keep.items() if k != "batch_id"],
                                F.lit(load_id).alias("load_id")).distinct()
        marks.write.mode("append").partitionBy("load_id").parquet(f"{target_root}/{REPLAYS_TABLE}")
        append_load(accepted.select(*declared, F.col("_file_name").alias("_source_file"), F.col("_batch_id").alias("batch_id"),
                                    F.lit(load_id).alias("load_id")), f"{target_root}/{tbl}")
    closed = LG.log_close(opened, None, None, status=LG.COMPLETED if landed else LG.FAILED)
    append_log(closed.withColumn("load_id", F.lit(load_id)), log_path)
    return load_id if landed else None


# --- I6: broken loads --------------------------------------------------------------
def broken_loads(log: DataFrame, hours: float) -> DataFrame:
    """(load_id): loads without a ``Completed`` row that have ended, or that opened more than ``hours`` ago."""
    per = log.where(F.col("load_id").isNotNull()).groupBy("load_id").agg(
        F.bool_or(F.col("load_status").isin(LG.COMPLETED, REMOVED)).alias("done"),
        F.bool_or(F.col("load_status") == LG.FAILED).alias("ended"), F.max("load_start").alias("opened"))
    old = F.col("opened") < F.current_timestamp() - F.make_dt_interval(secs=F.lit(hours * 3600))
    return per.where(~F.col("done") & (F.col("ended") | old)).select("load_id")


def clean_unpublished(spark: SparkSession, target_root: str, log_path: str, hours: float = 24, source: str = "FM",
                      schemas: Mapping = LANDING) -> list[str]:
    """Remove what broken loads have written; returns their load ids.

    A load that may still run (no closing row, younger than ``hours``) and every
    published one is left alone. Only the partitions named after a broken
    load's id are listed and deleted; a cleaning that breaks off is repeated
    by the next, since the log notes a load as removed only afterwards.
    """
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = fs_path(target_root)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    lost = [r[0] for r in broken_loads(read_log(spark, log_path), hours).orderBy("load_id").limit(LOADS_PER_CLEANING).collect()]
    for load_id in lost:
        places = [f"{t}/customer=*/batch_id=*/load_id={load_id}" for t in schemas]
        for place in (*places, *(f"{t}/load_id={load_id}" for t in (REJECTS_TABLE, REPLAYS_TABLE))):
            for found in fs.globStatus(fs_path(f"{target_root}/{place}")) or ():
                fs.delete(found.getPath(), True)
        closed = LG.log_close(_entry(spark, f"removal/{load_id}", source), None, None, status=REMOVED)
        append_log(closed.withColumn("load_id", F.lit(load_id)), log_path)
    return lost


# --- N6: rows sent again in a later batch --------------------------------------------
def digest(columns: Sequence[str]) -> Column:
    """256 bits of a row's columns; NULL differs from every value."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(f"c{k}") for k, c in enumerate(columns)]))
    return F.unhex(F.sha2(row, 256))


def likely(history: DataFrame, new: DataFrame, rows: int) -> DataFrame:
    """The digests of ``history`` that may be among ``new`` (``rows`` of them), by a bitmap of bounded size.

    It only spares shuffling the history: what it lets through is joined exactly.
    """
    power = min(max((16 * max(rows, 1)).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    at = F.pmod(F.xxhash64("digest"), F.lit(2**power))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    words = new.groupBy(F.floor(at / 64).alias("word")).agg(F.bit_or(bit).alias("bits"))
    return (history.withColumn("word", F.floor(at / 64)).join(F.broadcast(words), "word")
            .where(F.col("bits").bitwiseAND(bit) != 0).select("digest"))


def first_sent(df: DataFrame, digests: str, batch_id: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of a batch that no earlier batch has sent; their digests are stored for later ones.

    Rows are the same if they agree in ``columns`` (all but the batch by
    default). Repeats inside the batch are left to the batch's own rules.
    Batches are compared by id, so a batch that is run again gives the same
    rows, whatever came after it. The small filter of the batch thins the
    stored digests before they are shuffled; the anti join is exact.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c != "batch_id"] if columns is None else columns
    own = df.withColumn("_digest", digest(columns)).checkpoint()
    stored = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("batch_id", T.StringType())])
    history = read_or_empty(spark, digests, stored).where(F.col("batch_id") < batch_id).select("digest")
    new = own.select(F.col("_digest").alias("digest")).distinct()
    again = likely(history, new, own.count()).distinct().withColumnRenamed("digest", "_digest")
    kept = own.join(again, "_digest", "left_anti").checkpoint()
    mine = kept.select(F.col("_digest").alias("digest"), F.lit(batch_id).alias("batch_id")).distinct()
    (clustered(mine, ["batch_id"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(digests))
    return kept.drop("_digest")
