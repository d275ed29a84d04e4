"""The file load log as an append-only table of status events.

Parquet has no UPDATE, so each status change (Started, Completed, Failed)
is a new row, and the state of a file is its latest row. Pending files are
the inventory minus files with a ``Completed`` row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.schemas import LOAD_LOG

STARTED, COMPLETED, FAILED = "Started", "Completed", "Failed"
LOG_COLUMNS = [f.name for f in LOAD_LOG.fields]
_TYPES = {f.name: f.dataType for f in LOAD_LOG.fields}


def _typed(values: dict) -> list:
    return [(values[c] if c in values else F.lit(None)).cast(_TYPES[c]).alias(c) for c in LOG_COLUMNS]


# --- I2 -----------------------------------------------------------------
def pending_files(inventory: DataFrame, log: DataFrame, source: str) -> DataFrame:
    """Inventory rows whose file has no ``Completed`` entry for this source."""
    done = (log.where((F.col("source_name") == source) & (F.col("load_status") == COMPLETED))
            .select("file_name").distinct())
    return inventory.join(done, "file_name", "left_anti")


def in_progress_files(log: DataFrame, source: str) -> DataFrame:
    """Files whose latest log row is ``Started`` (a load still running or died).

    The optional guard: a run can refuse to start while any exist.
    """
    state = log_state(log.where(F.col("source_name") == source), at=None)
    return state.where(F.col("load_status") == STARTED).select("file_name")


def published_loads(log: DataFrame) -> DataFrame:
    """Load ids with a ``Completed`` row: readers see the rows of these loads only."""
    return log.where((F.col("load_status") == COMPLETED) & F.col("load_id").isNotNull()).select("load_id").distinct()


def failed_tries(log: DataFrame, source: str) -> DataFrame:
    """(file_name, tries, last_tried) of files that could not be read.

    A load that broke for another reason says nothing about its files: only
    ``Failed`` rows that carry an ``error`` count.
    """
    return (log.where((F.col("source_name") == source) & (F.col("load_status") == FAILED) & F.col("error").isNotNull())
            .groupBy("file_name").agg(F.count(F.lit(1)).alias("tries"), F.max("load_start").alias("last_tried")))


def with_tries(pending: DataFrame, log: DataFrame, source: str) -> DataFrame:
    """``pending`` (with ``modified``) and each file's ``tries`` since it was last changed."""
    since = F.coalesce(F.col("modified") <= F.col("last_tried"), F.lit(False))
    return (pending.join(failed_tries(log, source), "file_name", "left")
            .withColumn("tries", F.when(since, F.col("tries")).otherwise(F.lit(0))).drop("last_tried"))


def pending_status(pending: DataFrame) -> str:
    """'skip' when nothing is pending, else 'proceed' (one bounded probe)."""
    return "skip" if pending.isEmpty() else "proceed"


# --- I3 -----------------------------------------------------------------
def log_open(pending: DataFrame, source: str, started_at=None) -> DataFrame:
    """One ``Started`` row per pending file (built from the pending set, no driver loop)."""
    ts = F.current_timestamp() if started_at is None else F.lit(started_at)
    return pending.select(*_typed({
        "source_name": F.lit(source), "file_name": F.col("file_name"), "location": F.col("location"),
        "load_start": ts, "load_status": F.lit(STARTED)}))


# --- I5 -----------------------------------------------------------------
def log_close(started: DataFrame, stats: DataFrame | None, batch_id: str, status: str = COMPLETED,
              ended_at=None) -> DataFrame:
    """Closing rows: status, batch id, end time, minute-boundary duration, load stats."""
    end = F.current_timestamp() if ended_at is None else F.lit(ended_at)
    df = started
    if stats is not None:
        df = df.drop("error_cnt", "data_min", "data_max").join(stats, "file_name", "left")
    else:
        df = df.drop("data_min", "data_max").withColumns(
            {"data_min": F.lit(None), "data_max": F.lit(None)})
    df = df.withColumn("load_end", end)
    return df.select(*_typed({
        "source_name": F.col("source_name"), "file_name": F.col("file_name"),
        "location": F.col("location"), "load_start": F.col("load_start"),
        "load_status": F.lit(status), "load_end": F.col("load_end"),
        "duration_min": minutes_between(F.col("load_start"), F.col("load_end")),
        "error_cnt": F.col("error_cnt"), "batch_id": F.lit(batch_id),
        "data_min": F.col("data_min"), "data_max": F.col("data_max")}))


def minutes_between(start, end):
    """Minute boundaries crossed (so 10:00:59 -> 10:01:00 is 1)."""
    return (F.floor(F.unix_seconds(end.cast("timestamp")) / 60)
            - F.floor(F.unix_seconds(start.cast("timestamp")) / 60))


def log_state(log: DataFrame, keys=("source_name", "file_name"), at: str | None = "load_start",
              tie: str | None = None) -> DataFrame:
    """Latest row per file (an aggregate: max of a struct led by the time).

    ``at=None``: by the time of the entry itself, which is the end of a
    closing row and the start of an opening one; at equal times a closing
    row is later than the ``Started`` row it closes.
    """
    if at is None:
        end = F.col("load_end") if "load_end" in log.columns else F.lit(None).cast("timestamp")
        order = [F.coalesce(end, F.col("load_start")).alias("_o0"), (F.col("load_status") != STARTED).alias("_o1")]
    else:
        order = [F.col(at).alias("_o0")] + ([F.col(tie).alias("_o1")] if tie else [])
    other = [c for c in log.columns if c not in keys]
    latest = F.max(F.struct(*order, *[F.col(c) for c in other])).alias("_l")
    return (log.groupBy(*keys).agg(latest, F.count(F.lit(1)).alias("n_entries"))
            .select(*keys, *[F.col("_l")[c].alias(c) for c in other], "n_entries"))
