"""Named, bucketed tables and SQL over them (I9, I10).

A table is declared once by name over its folder: partitioned by tenant and
batch, and inside a partition cut into buckets by the machine and sorted by
its event order. Reading it, Spark knows that rows of one machine lie in one
bucket, so windows and aggregates per machine need no exchange, as often as
the table is read; the write paid for it once.

A batch is replaced by a dynamic partition overwrite into the table. Its rows
are dealt by the bucket hash first, so a partition has at most one file per
bucket, whatever the number of tasks. A session that hasn't declared the
table yet declares it again over the same folder; partitions are then found
on disk.

The machine's bucket is one task's work. Where a machine is hot, the ordered
scans cut the whole frame by ranges (``operators.ordered``), bucketed or not.

Cases: an empty frame replaces nothing; a declared table without files reads
as empty; NULL machines share a bucket; names must be identifiers.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meterline.params import ISLAND_GAP_SECONDS, ISLAND_PRIORITY, ISLAND_PRIORITY_DEFAULT
from meterline.sources.files import PARTITION_COLUMNS

BUCKET_KEYS = ("egm_id",)
SORT_KEYS = ("egm_id", "tran_ts")
BUCKETS = 64


def _identifier(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"not a table name: {name!r}")
    return name


def declare(spark: SparkSession, name: str, schema: T.StructType, path: str, buckets: int = BUCKETS,
            bucket_by: Sequence[str] = BUCKET_KEYS, sort_by: Sequence[str] = SORT_KEYS,
            partition_by: Sequence[str] = PARTITION_COLUMNS) -> str:
    """Register the table over ``path`` if this session doesn't know it, with the partitions found there."""
    if not spark.catalog.tableExists(_identifier(name)):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        quoted = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(partition_by)}) "
                  f"CLUSTERED BY ({', '.join(bucket_by)}) SORTED BY ({', '.join(sort_by)}) INTO {int(buckets)} BUCKETS "
                  f"LOCATION '{quoted}'")
        spark.createDataFrame([], schema).write.mode("append").partitionBy(*partition_by).parquet(path)  # the folder exists
        spark.catalog.recoverPartitions(name)
    return name


def replace_partitions(df: DataFrame, name: str, buckets: int = BUCKETS, bucket_by: Sequence[str] = BUCKET_KEYS) -> None:
    """Replace the table's partitions that ``df`` has rows of; other partitions stay."""
    spark = df.sparkSession
    columns = spark.table(_identifier(name)).columns
    (df.select(*columns).repartition(buckets, *bucket_by)  # the bucket's hash, so each task writes its own buckets
     .write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True))


# G1-G4 in SQL: the running counts and row numbers per machine, with the caller's tenant, batch and gap as parameters.
ISLANDS = f"""
WITH ranked AS (
  SELECT *, CAST(CASE rectype {' '.join(f"WHEN '{k}' THEN {v}" for k, v in ISLAND_PRIORITY.items())}
                 ELSE {ISLAND_PRIORITY_DEFAULT} END AS INT) AS rectype_order
  FROM IDENTIFIER(:events)
  WHERE (:customer IS NULL OR customer = :customer) AND (:batch IS NULL OR batch_id = :batch)),
placed AS (
  SELECT *, CASE WHEN rectype = 'v' THEN 'cashout' ELSE 'other rectype' END AS calc_col,
         lead(tran_ts) OVER w AS next_ts, row_number() OVER w AS place
  FROM ranked
  WINDOW w AS (PARTITION BY customer, batch_id, egm_id
               ORDER BY tran_ts ASC NULLS FIRST, seq ASC NULLS LAST, rectype_order, event_id)),
numbered AS (
  SELECT *, count(CASE WHEN rectype = 'v' THEN 1 END) OVER p AS outs
  FROM placed WINDOW p AS (PARTITION BY customer, batch_id, egm_id ORDER BY place
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, rectype, egm_id, tran_ts, seq, credit_meter, tran_amt, customer, batch_id, rectype_order, calc_col,
       CASE WHEN rectype = 'v' THEN place - outs ELSE outs END AS grp,
       CASE WHEN rectype = 'v' THEN outs ELSE outs + 1 END AS final_num,
       CASE WHEN unix_seconds(CAST(next_ts AS TIMESTAMP)) - unix_seconds(CAST(tran_ts AS TIMESTAMP)) > :gap
            THEN 'session_end' ELSE 'continue' END AS time_gap
FROM numbered
"""


def islands_sql(spark: SparkSession, events: str, customer: str | None = None, batch_id: str | None = None,
                gap_seconds: int = ISLAND_GAP_SECONDS) -> DataFrame:
    """Gaps and islands of a named event table by parametrised SQL; NULL parameters take all tenants or batches."""
    return spark.sql(ISLANDS, args={"events": _identifier(events), "gap": gap_seconds, "customer": customer, "batch": batch_id})
