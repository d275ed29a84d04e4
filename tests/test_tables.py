"""Clustered writes and named, bucketed tables."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from meterline.operators import curate as C
from meterline.operators import sessions as Z
from meterline.operators.islands import islands
from meterline.plans.adapters import DRIVER_SESSION, canonical_events, table
from meterline.sources import catalog
from meterline.sources.files import append_load, write_batch
from tests.conftest import SF_SMALL


def parquet_files(path):
    return [f"{d}/{n}" for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")]


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def events(spark):
    return canonical_events(table(spark, SF_SMALL, "events")).withColumn("batch_id", F.date_format("tran_ts", "yyyyMMdd")).cache()


def test_files_follow_partitions_not_tasks(spark, events, tmp_path):
    parts = events.select("customer", "batch_id").distinct().count()
    spread = events.repartition(32)  # every task holds every tenant and day
    write_batch(spread, f"{tmp_path}/a")
    assert len(parquet_files(f"{tmp_path}/a")) == parts
    append_load(spread.withColumn("load_id", F.lit("l1")), f"{tmp_path}/b")
    assert len(parquet_files(f"{tmp_path}/b")) == parts
    assert spark.read.parquet(f"{tmp_path}/a").count() == events.count()


def test_a_large_partition_is_several_files(spark, tmp_path):
    rows = spark.range(400_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x"), F.lit("c").alias("customer"),
                                       F.when(F.col("id") < 100, "small").otherwise("large").alias("batch_id"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
    try:
        write_batch(rows.repartition(20), str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    large, small = (len(parquet_files(f"{tmp_path}/customer=c/batch_id={b}")) for b in ("large", "small"))
    assert small == 1 and 3 <= large <= 20
    assert spark.read.parquet(str(tmp_path)).count() == 400_000


@pytest.fixture
def named(spark, tmp_path):
    def make(df, buckets=4):
        name = f"t_{uuid.uuid4().hex[:8]}"
        catalog.declare(spark, name, df.schema, f"{tmp_path}/{name}", buckets=buckets)
        catalog.replace_partitions(df, name, buckets=buckets)
        return name, f"{tmp_path}/{name}"
    return make


def test_machine_windows_over_a_bucketed_table_need_no_exchange(spark, events, named):
    name, path = named(Z.sessionize(events, DRIVER_SESSION, chunk_micros=None))
    sess = spark.table(name)
    parts = events.select("customer", "batch_id").distinct().count()
    assert len(parquet_files(path)) <= parts * 4
    plan = final_plan(C.running_balance(sess, chunk_micros=None))
    assert "Window" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    day = events.first()["batch_id"]
    pruned = final_plan(C.running_balance(sess.where(F.col("batch_id") == day), chunk_micros=None))
    assert "Exchange" not in pruned and "PartitionFilters: [isnotnull(batch_id" in pruned


def test_batches_are_replaced_and_found_again(spark, events, named):
    name, path = named(events)
    days = sorted(r.batch_id for r in events.select("batch_id").distinct().collect())
    first = events.where(F.col("batch_id") == days[0])
    catalog.replace_partitions(first.withColumn("seq", F.lit(-1).cast("long")), name, buckets=4)
    assert spark.table(name).count() == events.count() and spark.table(name).where("seq = -1").count() == first.count()
    catalog.replace_partitions(first.limit(0), name, buckets=4)
    assert spark.table(name).count() == events.count()
    other = f"{name}_again"  # as a new session would: declared over the same folder
    catalog.declare(spark, other, events.schema, path, buckets=4)
    assert spark.table(other).count() == events.count()
    assert catalog.declare(spark, other, events.schema, path, buckets=4) == other
    with pytest.raises(ValueError):
        catalog.declare(spark, "no name; drop", events.schema, path)


def test_islands_by_sql(spark, events, named):
    name, _ = named(events)
    want = islands(events, chunk_micros=None)
    got = catalog.islands_sql(spark, name)
    columns = ["event_id", "calc_col", "grp", "final_num", "rectype_order", "time_gap"]
    as_set = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    assert as_set(got) == as_set(want)
    some = catalog.islands_sql(spark, name, customer="c1", batch_id="20240103", gap_seconds=10)
    assert 0 < some.count() == events.where("customer = 'c1' and batch_id = '20240103'").count()
