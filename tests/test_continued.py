"""Sessions and balances over batch borders: a log cut into batches gives what the uncut log gives."""

from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.operators import continued as K
from meterline.plans import pipeline as P
from meterline.plans.adapters import DRIVER_SESSION, canonical_events, table
from tests.conftest import SF_SMALL

FACTS = ["event_id", "customer", "egm_id", "session_id", "session_start", "session_number", "session_state", "next_delta",
         "prev_delta", "next_gap", "prev_gap", "theme_id", "theme_name", "prev_theme_id", "balance"]


def facts(df):
    return sorted(map(tuple, df.select(*FACTS).collect()), key=str)


@pytest.fixture(scope="module")
def log(spark):
    df = canonical_events(table(spark, SF_SMALL, "events"))
    # fewer machines with longer logs, and one without a name
    return df.withColumn("egm_id", F.expr("nullif(cast(event_id % 6 as string), '5')")).withColumn("customer", F.lit("c")).cache()


def uncut(spark, log):
    return K.continue_sessions(log, K.no_carry(spark), DRIVER_SESSION).rows


def in_batches(spark, log, batch, **how):
    """All rows with their closings, batch after batch."""
    cut = log.withColumn("batch_id", batch).cache()
    carry, rows, closings = K.no_carry(spark), [], []
    for b in [r.batch_id for r in cut.select("batch_id").distinct().orderBy("batch_id").collect()]:
        got = K.continue_sessions(cut.where(F.col("batch_id") == b), carry, DRIVER_SESSION, through=lambda df: df.checkpoint(), **how)
        carry = got.carry.checkpoint()
        rows.append(got.rows)
        closings.append(got.closings.checkpoint())
    union = lambda dfs: reduce(DataFrame.unionByName, dfs)
    return K.with_closings(union(rows), union(closings)), carry


def test_without_a_carry_it_is_the_plain_sessionizer(spark, log):
    from meterline.operators.sessions import sessionize
    one = sessionize(log, DRIVER_SESSION, chunk_micros=None).select("event_id", "session_id", "next_delta", "session_state")
    got = uncut(spark, log).select("event_id", "session_id", "next_delta", "session_state")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, one.collect()), key=str)


@pytest.mark.parametrize("days", [5, 12])
def test_batches_of_days(spark, log, days):
    day = F.floor(F.unix_seconds(F.col("tran_ts").cast("timestamp")) / 86400)
    got, carry = in_batches(spark, log, F.format_string("d%05d", F.floor(day / days)))
    want = uncut(spark, log)
    assert facts(got) == facts(want)
    assert carry.count() == 6 and got.where("late").count() == 0
    assert want.select("session_id").distinct().count() > 20  # there are sessions to continue
    spread = got.where("session_id is not null").groupBy("egm_id", "session_id").agg(F.countDistinct("batch_id").alias("n"))
    assert spread.where("n > 1").count() > 0  # and some lie in several batches


def test_hot_machines_are_cut_into_ranges(spark, log):
    got, _ = in_batches(spark, log, F.when(F.col("tran_ts") < F.lit("2024-01-14"), "b1").otherwise("b2"), target_rows=20)
    assert facts(got) == facts(uncut(spark, log))


def test_a_machine_that_pauses_keeps_its_carry(spark, log):
    """No event of machine 1 in the middle batch; its open session goes on in the third."""
    mid = (F.col("tran_ts") >= "2024-01-10") & (F.col("tran_ts") < "2024-01-20")
    some = log.where(~(mid & (F.col("egm_id") == "1")))
    batch = F.when(F.col("tran_ts") < "2024-01-10", "b1").when(mid, "b2").otherwise("b3")
    got, _ = in_batches(spark, some, batch)
    assert facts(got) == facts(uncut(spark, some))


def test_an_empty_batch_and_late_rows(spark, log):
    first = K.continue_sessions(log.where("tran_ts >= '2024-01-15'"), K.no_carry(spark), DRIVER_SESSION)
    carry = first.carry.checkpoint()
    empty = K.continue_sessions(log.limit(0), carry, DRIVER_SESSION)
    assert empty.rows.count() == empty.closings.count() == 0
    assert sorted(map(str, empty.carry.collect())) == sorted(map(str, carry.collect()))
    late = K.continue_sessions(log.where("tran_ts < '2024-01-02'"), carry, DRIVER_SESSION)
    assert late.rows.count() and late.rows.where("not late").count() == 0


def test_the_batch_job_reruns(spark, log, tmp_path):
    wh = P.Warehouse(str(tmp_path))
    raw = log.withColumn("batch_id", F.when(F.col("tran_ts") < "2024-01-09", "b1").when(F.col("tran_ts") < "2024-01-18", "b2")
                         .otherwise("b3"))
    wh.write(raw, P.RAW, raw)
    want = facts(uncut(spark, log))
    for b in ("b1", "b2", "b3"):
        got = P.continue_batch(spark, wh, b, DRIVER_SESSION)
        assert got["stale"] == [] and got["rows"] == raw.where(F.col("batch_id") == b).count()
    assert facts(P.continued_log(spark, wh)) == want
    assert P.continue_batch(spark, wh, "b2", DRIVER_SESSION)["stale"] == ["b3"]
    assert facts(P.continued_log(spark, wh)) == want


def test_the_carry_comes_in_the_scans_own_shuffle(spark, log):
    """The events were dealt once more to be joined with the carry, and the written rows were aggregated twice."""
    first = K.continue_sessions(log.where("tran_ts < '2024-01-15'"), K.no_carry(spark), DRIVER_SESSION)
    carry = first.carry.checkpoint()
    got = K.continue_sessions(log.where("tran_ts >= '2024-01-15'"), carry, DRIVER_SESSION, through=lambda df: df.checkpoint())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = K._rows(log.where("tran_ts >= '2024-01-15'"), carry, DRIVER_SESSION, K.MOVEMENT, None, 10**6)
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # the batch and the carry
    assert "Aggregate" not in got.closings._jdf.queryExecution().executedPlan().toString()
    keep = "tran_ts >= '2024-01-15'"
    late = [c for c in FACTS if c not in ("session_state", "next_delta", "next_gap")]
    assert (sorted(map(tuple, got.rows.select(*late).collect()), key=str)
            == sorted(map(tuple, uncut(spark, log).where(keep).select(*late).collect()), key=str))
