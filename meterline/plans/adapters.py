"""Driver tables -> the pipeline's tables, in Spark and in DuckDB SQL.

The test parquet tables are not telemetry, so these fixed mappings turn
them into telemetry-shaped tables. Each has a Spark form (used by the
queries) and an SQL form (used by the independent oracle); both read whole
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.exprs import MONEY
from meterline.params import SessionParams

# Thresholds for the driver data: the pipeline's 180 s / 50000 are
# degenerate on it (events per user lie hours apart, values are < 500).
DRIVER_SESSION = SessionParams(gap_seconds=6 * 3600, credit_floor=2.0)
BATCH = "b0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- events -> canonical event log -----------------------------------------
# Fixed mapping: signup->t, purchase->w, click->o, error->v,
# view->pss (even event_id) or pse (odd event_id).
def canonical_events(events: DataFrame) -> DataFrame:
    e = events
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    rectype = (F.when(et == "signup", "t").when(et == "purchase", "w").when(et == "click", "o")
               .when(et == "error", "v")
               .when(et == "view", F.when(eid % 2 == 0, "pss").otherwise("pse")))
    bracket = et == "view"
    themed = eid % 7 == 0
    meter = F.col("value").cast(MONEY)
    return e.select(
        rectype.alias("rectype"),
        uid.cast("string").alias("egm_id"),
        F.when(themed, F.concat(F.lit("th"), (eid % 11).cast("string"))).alias("theme_id"),
        F.when(themed, F.concat(F.lit("theme "), (eid % 11).cast("string"))).alias("theme_name"),
        F.concat(F.lit("d"), (uid % 4).cast("string")).alias("device_id"),
        F.concat(F.lit("m"), (eid % 3).cast("string")).alias("denom_id"),
        F.col("ts").alias("tran_ts"),
        F.when(~bracket, eid).cast("long").alias("seq"),
        meter.alias("credit_meter"),
        (meter - F.lit(1)).cast(MONEY).alias("tran_amt"),
        (eid % 101 - 50).cast(MONEY).alias("payout"),
        F.concat(F.lit("p"), (uid % 50).cast("string")).alias("player_id"),
        F.concat(F.lit("c"), (uid % 3).cast("string")).alias("customer"),
        F.when(et == "click", F.concat(F.lit("pt"), (eid % 5).cast("string"))).alias("paytable"),
        F.when(eid % 5 == 0, F.concat(F.lit("A"), (uid % 9).cast("string"))).alias("area_id"),
        F.concat(et, F.lit("-"), uid.cast("string")).alias("location"),
        F.lit("USD").alias("currency_id"),
        F.lit(BATCH).alias("batch_id"),
        eid.alias("event_id"),
    )


CANON_SQL = """
canon AS (
  SELECT
    CASE event_type WHEN 'signup' THEN 't' WHEN 'purchase' THEN 'w' WHEN 'click' THEN 'o'
      WHEN 'error' THEN 'v'
      WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'pss' ELSE 'pse' END END AS rectype,
    CAST(user_id AS VARCHAR) AS egm_id,
    CASE WHEN event_id % 7 = 0 THEN 'th' || CAST(event_id % 11 AS VARCHAR) END AS theme_id,
    CASE WHEN event_id % 7 = 0 THEN 'theme ' || CAST(event_id % 11 AS VARCHAR) END AS theme_name,
    'd' || CAST(user_id % 4 AS VARCHAR) AS device_id,
    'm' || CAST(event_id % 3 AS VARCHAR) AS denom_id,
    ts AS tran_ts,
    CASE WHEN event_type <> 'view' THEN event_id END AS seq,
    CAST(value AS DECIMAL(18,2)) AS credit_meter,
    CAST(CAST(value AS DECIMAL(18,2)) - 1 AS DECIMAL(18,2)) AS tran_amt,
    CAST(event_id % 101 - 50 AS DECIMAL(18,2)) AS payout,
    'p' || CAST(user_id % 50 AS VARCHAR) AS player_id,
    'c' || CAST(user_id % 3 AS VARCHAR) AS customer,
    CASE WHEN event_type = 'click' THEN 'pt' || CAST(event_id % 5 AS VARCHAR) END AS paytable,
    CASE WHEN event_id % 5 = 0 THEN 'A' || CAST(user_id % 9 AS VARCHAR) END AS area_id,
    event_type || '-' || CAST(user_id AS VARCHAR) AS location,
    'USD' AS currency_id,
    'b0' AS batch_id,
    event_id
  FROM events
)"""
