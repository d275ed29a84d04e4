"""End-to-end batch jobs over a warehouse folder of parquet tables.

  ingest      landing files -> <table>_raw            (load log kept)
  raw_model   *_raw -> event_log (canonical event log)
  sessionize  event_log -> sessionized
  segregate   sessionized -> violations + quarantine (offending rows)
  curate      sessionized - invalid sessions -> curated

Every table is partitioned by (customer, batch_id). A job replaces the
partitions it processed, also those it has no row for any more: re-running a
batch replaces it, never duplicates it and leaves no stale rows. A job may be limited to
one tenant and batch (partition pruning on read) or run over all of them
in one Spark job. Each stage reads the previous stage's table, which also
cuts the lineage between stages.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators import continued as K
from meterline.operators import curate as C
from meterline.operators import events as N
from meterline.operators import quality as Q
from meterline.operators import sessions as Z
from meterline.operators.ordered import plan_chunks
from meterline.params import ENTITY, SessionParams
from meterline.schemas import CANONICAL_COLUMNS, LANDING
from meterline.sources.files import PARTITION_COLUMNS, read_batches, replace_batches, write_batch
from meterline.sources.loadlog import published_loads
from meterline.streaming.incremental import LoadResult, load_pending_files, read_log, read_or_empty

RAW, SESSIONIZED, VIOLATIONS, QUARANTINE, CURATED = (
    "event_log", "sessionized", "violations", "quarantine", "curated")
LOAD_LOG = "load_log"
CONTINUED, CLOSINGS, CARRY = "continued", "session_closings", "session_carry"


@dataclass(frozen=True)
class Warehouse:
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, spark: SparkSession, table: str, customer: str | None = None,
             batch_id: str | None = None) -> DataFrame:
        return only(read_batches(spark, self.path(table)), customer, batch_id)

    def read_landing(self, spark: SparkSession, table: str, schema, customer=None, batch_id=None):
        """The published rows of a landing table, with source-row ids; no files yet reads as an empty frame."""
        log = read_log(spark, self.path(LOAD_LOG))
        stored = T.StructType([*schema.fields, T.StructField("load_id", T.StringType())])
        df = with_source_row_id(read_or_empty(spark, self.path(table), stored))
        df = df.join(published_loads(log), "load_id", "left_semi").drop("load_id")
        return only(df, customer, batch_id)

    def write(self, df: DataFrame, table: str, processed: DataFrame, **metrics) -> dict:
        """Replace the ``processed`` (customer, batch_id) partitions; ``metrics`` (name -> aggregate)
        are observed during the write."""
        obs = None
        if metrics:
            obs = Observation(table)
            df = df.observe(obs, *[agg.alias(name) for name, agg in metrics.items()])
        replace_batches(df, self.path(table), processed)
        return dict(obs.get) if obs is not None else {}


def only(df: DataFrame, customer: str | None, batch_id: str | None) -> DataFrame:
    """One tenant's or batch's rows (partition filters)."""
    if customer is not None:
        df = df.where(F.col("customer") == customer)
    if batch_id is not None:
        df = df.where(F.col("batch_id") == batch_id)
    return df


def processed_batches(df: DataFrame, customer: str | None, batch_id: str | None) -> DataFrame:
    """The partitions that a job over ``df`` answers for; one that is named counts even if it has no row."""
    seen = df.select(*PARTITION_COLUMNS).distinct()
    if customer is not None and batch_id is not None:
        seen = seen.unionByName(df.sparkSession.createDataFrame([(customer, batch_id)], "customer string, batch_id string"))
    return seen


def rows_count():
    return F.count(F.lit(1))


def with_event_id(df: DataFrame) -> DataFrame:
    """A deterministic id, the final tie-breaker of every event order.

    From the source row (file path + row index, plus the type, since a
    player-session row yields a start and an end) when known, so copies of
    one event loaded twice stay distinct and a hot group of them can be
    split; else from the row's content (rows of the deduplicated secondary
    branch, which are unique).
    """
    content = F.xxhash64(*[F.col(c) for c in CANONICAL_COLUMNS])
    if N.ROW_ID not in df.columns:
        return df.withColumn("event_id", content)
    src = F.xxhash64(F.col(N.ROW_ID), F.col("rectype"))
    return df.withColumn("event_id", F.when(F.col(N.ROW_ID).isNotNull(), src).otherwise(content)) \
             .drop(N.ROW_ID)


def with_source_row_id(df: DataFrame) -> DataFrame:
    """Tag each landing row with a stable id of its file and position (an empty frame has no file)."""
    try:
        return df.withColumn(N.ROW_ID, F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")))
    except AnalysisException as e:
        if e.getCondition() != "UNRESOLVED_COLUMN.WITH_SUGGESTION":
            raise
        return df.withColumn(N.ROW_ID, F.lit(None).cast("long"))


def ingest(spark: SparkSession, landing_root: str, wh: Warehouse, batch_id: str,
           source: str = "FM") -> LoadResult:
    """Load pending landing files into ``<table>_raw``; returns status ('skip' or 'proceed'), batch id and load ids."""
    return load_pending_files(spark, landing_root, wh.root, wh.path(LOAD_LOG), batch_id, source)


def raw_model(spark: SparkSession, wh: Warehouse, customer: str | None = None,
              batch_id: str | None = None) -> DataFrame:
    landing = {t: wh.read_landing(spark, t, s, customer, batch_id) for t, s in LANDING.items()}
    seen = reduce(DataFrame.unionByName, [df.select(*PARTITION_COLUMNS) for df in landing.values()])
    df = with_event_id(N.raw_event_log(landing))
    return wh.write(df, RAW, processed_batches(seen, customer, batch_id), rows=rows_count())


def sessionize(spark: SparkSession, wh: Warehouse, customer: str | None = None,
               batch_id: str | None = None, params: SessionParams = SessionParams()):
    """Returns (chunk plan, metrics: rows, sessions, rows without a session)."""
    raw = wh.read(spark, RAW, customer, batch_id)
    cm = plan_chunks(raw, ENTITY, "tran_ts")
    m = wh.write(Z.sessionize(raw, params, chunk_micros=cm), SESSIONIZED,
                 processed_batches(raw, customer, batch_id), rows=rows_count(),
                 sessions=F.count("unique_session_id"),
                 unsessioned=F.count_if(F.col("session_id").isNull()))
    return cm, m


def segregate(spark: SparkSession, wh: Warehouse, customer: str | None = None,
              batch_id: str | None = None, rules=Q.DEFAULT_RULES, chunk_micros="auto") -> dict:
    sess = wh.read(spark, SESSIONIZED, customer, batch_id)
    if chunk_micros == "auto":
        chunk_micros = plan_chunks(sess, ENTITY, "tran_ts")
    rule_input = Q.checked_frame(sess, chunk_micros=chunk_micros, fill_theme=False)
    viol = Q.violations(rule_input, rules, chunk_micros=chunk_micros) \
        .withColumn("loaded_at", F.current_timestamp())
    done = processed_batches(sess, customer, batch_id)
    m = {"violations": wh.write(viol, VIOLATIONS, done, rows=rows_count())["rows"]}
    q = wh.write(Q.negative_amount_rows(Q.checked_frame(sess, chunk_micros=chunk_micros)), QUARANTINE, done,
                 rows=rows_count())
    m["quarantined_rows"] = q["rows"]
    return m


def curate(spark: SparkSession, wh: Warehouse, customer: str | None = None,
           batch_id: str | None = None, chunk_micros="auto") -> dict:
    sess = wh.read(spark, SESSIONIZED, customer, batch_id)
    viol = wh.read(spark, VIOLATIONS, customer, batch_id)
    if chunk_micros == "auto":
        chunk_micros = plan_chunks(sess, ENTITY, "tran_ts")
    return wh.write(C.curated_sessions(sess, viol, chunk_micros=chunk_micros), CURATED,
                    processed_batches(sess, customer, batch_id), rows=rows_count(),
                    sessions=F.count("unique_session_id"))


def run_batch(spark: SparkSession, wh: Warehouse, customer: str | None = None,
              batch_id: str | None = None, params: SessionParams = SessionParams()) -> dict:
    """raw model -> sessionize -> segregate -> curate for one tenant/batch (or all).

    Returns the metrics observed while writing each stage.
    """
    out = {"raw_model": raw_model(spark, wh, customer, batch_id)}
    cm, out["sessionize"] = sessionize(spark, wh, customer, batch_id, params)
    out["segregate"] = segregate(spark, wh, customer, batch_id, chunk_micros=cm)
    out["curate"] = curate(spark, wh, customer, batch_id, chunk_micros=cm)
    return out


def carry_before(spark: SparkSession, wh: Warehouse, batch_id: str) -> DataFrame:
    """The carry that the last batch before ``batch_id`` (by name) left; empty before the first."""
    stored = read_or_empty(spark, wh.path(CARRY), T.StructType([*K.CARRY.fields, T.StructField("after", T.StringType())]))
    before = stored.where(F.col("after") < batch_id).agg(F.max("after")).first()[0]
    return stored.where(F.col("after") == before).drop("after") if before is not None else K.no_carry(spark)


def continue_batch(spark: SparkSession, wh: Warehouse, batch_id: str, params: SessionParams = SessionParams()) -> dict:
    """Sessions and balances of one batch (all tenants) as a continuation of the batches before it.

    Batches are continued in the order of their names. Each leaves its own
    version of the carry, so a rerun starts from the carry that it started
    from before and replaces rows, closings and carry. A rerun changes what
    later batches start from: ``stale`` names those, to be rerun in order.
    """
    def through(rows: DataFrame) -> DataFrame:
        metrics.update(wh.write(rows, CONTINUED, processed_batches(raw, None, None), rows=rows_count(),
                                starts=F.count("session_start"), late=F.count_if("late")))
        return wh.read(spark, CONTINUED, batch_id=batch_id)

    metrics: dict = {}
    raw = wh.read(spark, RAW, batch_id=batch_id)
    carry = carry_before(spark, wh, batch_id)
    got = K.continue_sessions(raw, carry, params, through=through)
    write_batch(got.closings.withColumn("decided_by", F.lit(batch_id)), wh.path(CLOSINGS), ("decided_by",))
    write_batch(got.carry.withColumn("after", F.lit(batch_id)), wh.path(CARRY), ("after",))
    later = spark.read.parquet(wh.path(CARRY)).where(F.col("after") > batch_id).select("after").distinct().orderBy("after")
    return metrics | {"stale": [r.after for r in later.collect()]}


def continued_log(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """All continued rows with what later batches decided about them."""
    return K.with_closings(wh.read(spark, CONTINUED), spark.read.parquet(wh.path(CLOSINGS)).drop("decided_by"))
