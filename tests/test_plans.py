"""Plan checks: shuffles, pruning and pushdown are what the design claims."""

import pytest
from pyspark.sql import functions as F

from meterline.operators import sessions as Z
from meterline.operators.events import canonical_projection, raw_event_log
from meterline.plans.adapters import DRIVER_SESSION, canonical_events, table
from meterline.plans.landing import landing_tables
from meterline.sources.files import tenant_batch_scan, write_batch
from tests.conftest import SF, SF_SMALL


def plan(df):
    df.count()  # materialize so AQE shows the final plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_partition_window(spark):
    df = Z.sessionize(canonical_events(table(spark, SF_SMALL, "events")), DRIVER_SESSION, chunk_micros=3600 * 10**6)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in p
    assert "Window" in p


def test_tag_filter_removes_other_branches(spark):
    from meterline.operators.events import cash_events
    landing = landing_tables(spark, SF_SMALL)
    # literal-tagged branches: the filter alone leaves one branch of three
    one = cash_events(landing).where(F.col("rectype") == "v")
    assert "Union" not in one._jdf.queryExecution().optimizedPlan().toString()
    # paired branches are windowed; the explicit type choice skips them
    df = raw_event_log(landing, types=["n"])
    assert "Window" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == canonical_projection(landing, "n").count()
    full = raw_event_log(landing).where(F.col("rectype") == "n")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, df.collect()))


def test_tenant_scan_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "canon")
    ev = canonical_events(table(spark, SF_SMALL, "events")).withColumn("batch_id", F.date_format("tran_ts", "yyyyMMdd"))
    write_batch(ev, path)
    df = tenant_batch_scan(spark, path, "c1", "20240102", ["event_id", "tran_ts"])
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(customer" in p
    assert "ReadSchema: struct<tran_ts:timestamp_ntz,event_id:bigint>" in p
    assert df.count() == ev.where("customer = 'c1' AND batch_id = '20240102'").count()


def test_rule_scan_prunes_columns(spark):
    """A rule reading only amounts and types never reads the text columns of events."""
    from meterline.operators import quality as Q
    s = Z.sessionize(canonical_events(table(spark, SF_SMALL, "events")), DRIVER_SESSION, chunk_micros=None)
    p = Q.negative_amount_sessions(Q.checked_frame(s, chunk_micros=None))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "props" not in p


def final_plan(df) -> str:
    """The plan that ran, after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("key,shuffles,scans", [
    ("sessionized", 1, 1), ("session_fill", 1, 1), ("wager_events", 4, 4), ("violations", 7, 4), ("event_islands", 1, 1)])
def test_executed_shuffles_and_scans(spark, key, shuffles, scans):
    import __spark_entry__ as E
    plan = final_plan(E.queries()[key](spark, SF))
    ran = sum(" Exchange " in f" {line.lstrip(' +-:*()0123456789')}" for line in plan.splitlines())
    assert ran <= shuffles, plan
    assert plan.count("FileScan") + plan.count("Scan ExistingRDD") <= scans, plan
