"""Incremental, idempotent loading of landing files (I8).

Two forms:

* ``load_pending_files``: inventory -> pending (minus ``Completed`` in the
  load log) -> ``Started`` rows -> one parallel strict read per landing
  table -> rows appended under a fresh load id -> one append of closing log
  rows with per-file stats. Readers see the rows of a load only when the log
  has a ``Completed`` row of it, and all closing rows of a load are written
  by one append, so a load is published whole or not at all. A file that
  can't be read is logged ``Failed`` with its error, and the others of its
  load go through; later it is tried in a load apart, and after ``MAX_TRIES``
  it is set aside until it changes. Rows with values that don't cast go to the
  rejects table.
* ``stream_load``: the same as a stream of new files, each micro-batch loaded
  through ``foreachBatch`` with the log, the rejects and the stats. A load
  belongs to (query, epoch): an epoch that comes again after a failure is
  skipped if the log has published it, and is loaded anew under another load
  id if not, so what the broken attempt wrote is never seen.
* ``stream_available_now``: rows of one declared schema straight from a file
  stream into a table with ``trigger(availableNow=True)``, without a log; the
  checkpoint is the processed-file log, so a re-run adds nothing and a new
  file adds only itself.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.schemas import LANDING, REJECTS, STORED_LOG
from meterline.session import ensure_checkpoint_dir
from meterline.sources import loadlog as LG
from meterline.sources.files import (
    PARTITION_COLUMNS, append_load, examine, file_inventory, read_landing, root_pattern, table_of, typed_load,
)

REJECTS_TABLE = "load_rejects"
# Files of one load: their paths go through the driver, so a large backlog takes several loads.
FILES_PER_LOAD = 10_000


# Reads of a file that can't be read before it is set aside.
MAX_TRIES = 3


class LoadResult(NamedTuple):
    status: str            # 'skip' or 'proceed'
    batch_id: str
    loads: tuple = ()      # load ids, in order


def event_time_column(schema: T.StructType) -> str:
    """The first timestamp column of a landing table (its event time)."""
    return next(f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table with its declared schema; empty only when it does not exist yet
    (any other read error propagates)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    return read_or_empty(spark, log_path, STORED_LOG)


def append_log(df: DataFrame, log_path: str) -> None:
    df.coalesce(1).write.mode("append").parquet(log_path)


def read_loaded(spark: SparkSession, path: str, schema: T.StructType, log: DataFrame) -> DataFrame:
    """Landing rows of published loads (with their file and load id)."""
    stored = T.StructType([*schema.fields, T.StructField("_source_file", T.StringType()),
                           T.StructField("load_id", T.StringType())])
    return read_or_empty(spark, path, stored).join(LG.published_loads(log), "load_id", "left_semi")


def load_table(spark: SparkSession, tbl: str, paths: list[str], schema: T.StructType, target_root: str,
               batch_id: str, load_id: str, source: str, landing_root: str) -> dict[str, str]:
    """Append the files of one landing table under the load id; returns {path: error} of unreadable ones."""
    target = f"{target_root}/{tbl}"
    stamp = {"batch_id": F.lit(batch_id), "load_id": F.lit(load_id)}
    declared = T.StructType([f for f in schema.fields if f.name != "batch_id"])

    def strict(some):
        append_load(read_landing(spark, some, declared).withColumns(stamp), target)

    try:
        strict(paths)
        return {}
    except Exception:  # noqa: BLE001  some file is damaged or has other types: look at each
        found = examine(spark, paths)  # FILES_PER_LOAD rows at most
    bad = {path: error for path, error, _ in found if error is not None}
    by_types: dict[str, list[str]] = {}
    for path, error, types in found:
        if error is None:
            by_types.setdefault(types, []).append(path)
    for some in by_types.values():  # as many groups as there are different file layouts
        raw = read_landing(spark, some, None)
        have = {c.lower(): c for c in raw.columns}
        text = raw.select(*[(F.col(f"`{have[f.name]}`").cast("string") if f.name in have else F.lit(None).cast("string"))
                            .alias(f.name) for f in declared.fields], "_source_file")
        targets = {f.name: f.dataType for f in declared.fields}
        accepted, rejects = typed_load(text, targets, keep=("_source_file",))
        append_load(accepted.withColumns(stamp), target)
        name = F.regexp_extract("_source_file", root_pattern(landing_root), 2)
        raw_row = F.to_json(F.struct(*[F.col(f"{c}_raw").alias(c) for c in targets]))
        rejects.select(F.lit(source).alias("source_name"), F.lit(tbl).alias("table_name"), name.alias("file_name"),
                       "error_columns", raw_row.alias("raw_row"), *[c.alias(n) for n, c in stamp.items()]) \
            .write.mode("append").partitionBy("load_id").parquet(f"{target_root}/{REJECTS_TABLE}")
    return bad


def load_stats(spark: SparkSession, tables: dict[str, T.StructType], target_root: str, load_id: str,
               landing_root: str) -> DataFrame:
    """Per file: rejected rows, first and last event time, from two columns of what the load has written."""
    name = F.regexp_extract("_source_file", root_pattern(landing_root), 2).alias("file_name")
    parts = []
    for tbl, schema in tables.items():
        stored = T.StructType([*schema.fields, T.StructField("_source_file", T.StringType()),
                               T.StructField("load_id", T.StringType())])
        parts.append(read_or_empty(spark, f"{target_root}/{tbl}", stored).where(F.col("load_id") == load_id)
                     .select(name, F.col(event_time_column(schema)).alias("_ts"), F.lit(0).alias("_bad")))
    rejects = read_or_empty(spark, f"{target_root}/{REJECTS_TABLE}", REJECTS).where(F.col("load_id") == load_id)
    parts.append(rejects.select("file_name", F.lit(None).cast("timestamp_ntz").alias("_ts"), F.lit(1).alias("_bad")))
    return reduce(DataFrame.unionByName, parts).groupBy("file_name").agg(
        F.sum("_bad").cast("long").alias("error_cnt"), F.min("_ts").alias("data_min"), F.max("_ts").alias("data_max"))


def _load(spark: SparkSession, files, landing_root: str, target_root: str, log_path: str, batch_id: str, source: str,
          schemas: dict, load_id: str | None = None) -> str:
    """One load: its files are published together, or none is."""
    load_id = load_id or uuid.uuid4().hex
    rows = spark.createDataFrame([(r.location, r.file_name) for r in files], "location string, file_name string")
    now = spark.range(1).select(F.current_timestamp().alias("t")).first().t  # one start time of the load
    started = LG.log_open(rows, source, now)
    append_log(started.withColumn("load_id", F.lit(load_id)), log_path)
    try:
        bad, known = {}, {}
        for tbl in sorted({r.tbl for r in files}):
            paths = [r.location + r.file_name for r in files if r.tbl == tbl]
            if tbl not in schemas:
                bad |= {p: "no landing table of this name" for p in paths}
                continue
            known[tbl] = schemas[tbl]
            bad |= load_table(spark, tbl, paths, schemas[tbl], target_root, batch_id, load_id, source, landing_root)
        failed = [(r.file_name, str(bad[p])) for r in files if (p := r.location + r.file_name) in bad]
        why = spark.createDataFrame(failed, "file_name string, error string")
        stats = load_stats(spark, known, target_root, load_id, landing_root) if known else None
        closed = LG.log_close(started.join(why, "file_name", "left_anti"), stats, batch_id)
        closed = closed.withColumn("error_cnt", F.coalesce("error_cnt", F.lit(0).cast("long")))
        if failed:
            lost = LG.log_close(started.join(why, "file_name", "left_semi"), None, batch_id, status=LG.FAILED)
            closed = closed.unionByName(lost.join(why, "file_name"), allowMissingColumns=True)
        append_log(closed.withColumn("load_id", F.lit(load_id)), log_path)
    except Exception:
        lost = LG.log_close(started, None, batch_id, status=LG.FAILED)
        append_log(lost.withColumn("load_id", F.lit(load_id)), log_path)
        raise
    return load_id


def load_pending_files(spark: SparkSession, landing_root: str, target_root: str, log_path: str,
                       batch_id: str, source: str = "FM", schemas: dict = LANDING,
                       block_on_in_progress: bool = False, files_per_load: int = FILES_PER_LOAD,
                       max_tries: int = MAX_TRIES) -> LoadResult:
    """Load every pending landing file into its ``<table>`` folder.

    Files that could not be read before are loaded after the others and apart
    from them, so they don't cost these the strict read. One that failed
    ``max_tries`` times is left alone until its modification time is later than
    its last try (``set_aside`` lists such files); a larger ``max_tries`` takes
    it up again.

    ``block_on_in_progress``: return 'skip' while any file's latest log row
    is still ``Started`` (the optional in-progress guard). The pending list
    is fixed once, so files that arrive during the run wait for the next.
    """
    log = read_log(spark, log_path)
    if block_on_in_progress and not LG.in_progress_files(log, source).isEmpty():
        return LoadResult("skip", batch_id)
    ensure_checkpoint_dir(spark)
    pending = LG.with_tries(LG.pending_files(file_inventory(spark, landing_root, "*.parquet"), log, source), log, source)
    pending = pending.where(F.col("tries") < max_tries).select(
        "location", "file_name", table_of(F.col("file_name")).alias("tbl"), "tries").checkpoint(eager=True)
    loads: list[str] = []
    for some in (pending.where("tries = 0"), pending.where("tries > 0")):
        done = 0
        while files := some.orderBy("location", "file_name").offset(done).limit(files_per_load).collect():
            loads.append(_load(spark, files, landing_root, target_root, log_path, batch_id, source, schemas))
            done += len(files)
    return LoadResult("proceed" if loads else "skip", batch_id, tuple(loads))


def set_aside(spark: SparkSession, landing_root: str, log_path: str, source: str = "FM",
              max_tries: int = MAX_TRIES) -> DataFrame:
    """(location, file_name, tries) of the files that ``load_pending_files`` leaves alone."""
    log = read_log(spark, log_path)
    pending = LG.pending_files(file_inventory(spark, landing_root, "*.parquet"), log, source)
    return LG.with_tries(pending, log, source).where(F.col("tries") >= max_tries).select("location", "file_name", "tries")


def unpublished_rows(spark: SparkSession, target_root: str, log_path: str, schemas: dict = LANDING) -> dict[str, int]:
    """Rows per landing table that belong to loads which were never published."""
    published = LG.published_loads(read_log(spark, log_path))
    out = {}
    for tbl, schema in schemas.items():
        stored = T.StructType([*schema.fields, T.StructField("load_id", T.StringType())])
        lost = read_or_empty(spark, f"{target_root}/{tbl}", stored).join(published, "load_id", "left_anti")
        if n := lost.count():
            out[tbl] = n
    return out


# The columns of a listed file.
FILE = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                     T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def stream_load(spark: SparkSession, landing_root: str, target_root: str, log_path: str, batch_id: str, checkpoint: str,
                source: str = "FM", schemas: dict = LANDING, files_per_load: int = FILES_PER_LOAD) -> LoadResult:
    """Load the files that came since the checkpoint, ``files_per_load`` an epoch, then stop.

    Only paths travel: the stream reads a file's name and never its content,
    and the epoch's files are loaded as ``load_pending_files`` does it. Files
    that the log holds as ``Completed`` already (by whichever form) are left
    out. A file that can't be read is logged ``Failed``, the others of its
    epoch go through; since a stream offers a file once, ``Failed`` files are
    loaded by ``load_pending_files`` when they have been mended.
    """
    loads: list[str] = []

    def load(files: DataFrame, epoch: int) -> None:
        query = files.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        mine = f"{query}-{epoch}-"
        log = read_log(spark, log_path)
        if not LG.published_loads(log).where(F.col("load_id").startswith(mine)).isEmpty():
            return  # this epoch was published before the checkpoint could note it
        rx = root_pattern(landing_root)
        listed = spark.createDataFrame([(r.path,) for r in files.select("path").distinct().collect()], "path string").select(
            F.regexp_extract("path", rx, 1).alias("location"), F.regexp_extract("path", rx, 2).alias("file_name"))
        new = LG.pending_files(listed, log, source).select("location", "file_name", table_of(F.col("file_name")).alias("tbl"))
        if rows := new.orderBy("location", "file_name").collect():  # files_per_load at most
            loads.append(_load(spark, rows, landing_root, target_root, log_path, batch_id, source, schemas,
                               mine + uuid.uuid4().hex[:8]))

    q = (spark.readStream.schema(FILE).format("binaryFile").option("pathGlobFilter", "*.parquet")
         .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_load).load(landing_root)
         .select("path").writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return LoadResult("proceed" if loads else "skip", batch_id, tuple(loads))


def stream_available_now(spark: SparkSession, source_dir: str, schema: T.StructType, target: str,
                         checkpoint: str, partition_by=PARTITION_COLUMNS) -> None:
    """Process all files not yet in the checkpoint, then stop."""
    q = (spark.readStream.schema(schema).parquet(source_dir)
         .writeStream.format("parquet").option("path", target)
         .option("checkpointLocation", checkpoint).partitionBy(*partition_by)
         .trigger(availableNow=True).start())
    q.awaitTermination()
