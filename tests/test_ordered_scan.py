"""The chunked ordered scan equals a plain per-key window for every chunk size."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterline.operators.ordered import (
    FillForward, Lag, Lead, RowNumber, RunningSum, first_in_group, ordered_scan, sort_cols,
)
from meterline.plans.adapters import table
from tests.conftest import SF

ORDER = (("ts", False), ("seq", True), ("event_id", False))
OPS = [Lag("value", "lag1"), Lag("value", "lag2", 2), Lag("value", "lag3", 3),
       Lead("value", "lead1"), Lead("value", "lead2", 2),
       RunningSum("value", "csum"), FillForward("tag", "ffill"),
       FillForward("tag", "ffill_strict", strict=True), RowNumber("rn")]


@pytest.fixture(scope="module")
def ev(spark):
    e = table(spark, SF, "events")
    return e.select(
        "event_id", "ts", "user_id",
        F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("event_id")).alias("seq"),
        F.col("value").cast("decimal(18,2)").alias("value"),
        F.when(F.col("event_id") % 9 == 0, F.col("event_type")).alias("tag"),
        (F.col("user_id") % 2 == 0).alias("k2"),
    ).cache()


def plain(ev):
    w = Window.partitionBy("user_id", "k2").orderBy(*sort_cols(ORDER))
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev = w.rowsBetween(Window.unboundedPreceding, -1)
    return ev.select(
        "*", F.lag("value").over(w).alias("lag1"), F.lag("value", 2).over(w).alias("lag2"),
        F.lag("value", 3).over(w).alias("lag3"), F.lead("value").over(w).alias("lead1"),
        F.lead("value", 2).over(w).alias("lead2"), F.sum("value").over(run).alias("csum"),
        F.last("tag", True).over(run).alias("ffill"), F.last("tag", True).over(prev).alias("ffill_strict"),
        F.row_number().over(w).cast("long").alias("rn"))


@pytest.mark.parametrize("chunk", [None, 86400 * 10**6, 3600 * 10**6, 10**6])
def test_scan_equals_plain_window(spark, ev, chunk):
    got = ordered_scan(ev, ["user_id", "k2"], ORDER, "ts", OPS, chunk_micros=chunk)
    cols = ["event_id", "lag1", "lag2", "lag3", "lead1", "lead2", "csum", "ffill", "ffill_strict", "rn"]
    a = sorted(tuple(r) for r in got.select(*cols).collect())
    b = sorted(tuple(r) for r in plain(ev).select(*cols).collect())
    assert a == b


COLS = ["event_id", "lag1", "lag2", "lag3", "lead1", "lead2", "csum", "ffill", "ffill_strict", "rn"]


def test_chunk_plans_for_hot_keys(spark, ev):
    from meterline.operators.ordered import plan_chunks
    # every key below the target: one chunk per key
    assert plan_chunks(ev, ["user_id"], "ts", 10**6) is None
    ref = sorted(tuple(r) for r in plain(ev).select(*COLS).collect())
    # every key is hot: ranges over the whole order, whatever their number
    for target in (20, 1000):
        spec = plan_chunks(ev, ["k2"], "ts", target)
        assert spec.ranges >= ev.count() / target
        got = ordered_scan(ev, ["user_id", "k2"], ORDER, "ts", OPS, chunk_micros=spec)
        assert sorted(tuple(r) for r in got.select(*COLS).collect()) == ref


def test_first_and_last_in_group(spark, ev):
    f = first_in_group(ev, ["user_id"], ORDER, ["event_id"])
    w = Window.partitionBy("user_id").orderBy(*sort_cols(ORDER))
    ref = ev.withColumn("r", F.row_number().over(w)).where("r = 1").select("user_id", "event_id")
    assert sorted(map(tuple, f.collect())) == sorted(map(tuple, ref.collect()))
    l = first_in_group(ev, ["user_id"], ORDER, ["event_id"], last=True)
    ref2 = (ev.withColumn("r", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("user_id")))
            .where("r = n").select("user_id", "event_id"))
    assert sorted(map(tuple, l.collect())) == sorted(map(tuple, ref2.collect()))


def test_small_ranges_share_tasks(spark):
    """A target of 20 rows makes thousands of chunks, but tasks follow the rows (one task a range took hours on 6 million rows)."""
    from meterline.operators.ordered import CHUNK, GROUP, LEAST_TASKS, plan_chunks, with_chunks
    i = F.col("id")
    df = spark.range(30_000).select(
        i.alias("event_id"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, cast(id * 7919 % 5000 as int))").alias("ts"),
        (i % 7).alias("user_id"), F.when(i % 3 != 0, i).alias("seq"), F.when(i % 11 != 0, i % 101).cast("decimal(18,2)").alias("value"),
        F.when(i % 97 == 0, i.cast("string")).alias("tag"), F.when(i % 5 != 0, i % 2 == 0).alias("k2")).cache()
    spec = plan_chunks(df, ["user_id", "k2"], "ts", 20)
    chunked = with_chunks(df, ["user_id", "k2"], "ts", spec, ORDER)
    assert chunked.rdd.getNumPartitions() <= LEAST_TASKS
    sizes = chunked.groupBy(GROUP, CHUNK).count().agg(F.max("count").alias("most"), F.count("count").alias("n")).first()
    assert sizes.most <= 20 and 30_000 / 20 <= sizes.n <= spec.ranges
    got = ordered_scan(df, ["user_id", "k2"], ORDER, "ts", OPS, chunk_micros=spec)
    assert sorted(map(tuple, got.select(*COLS).collect())) == sorted(map(tuple, plain(df).select(*COLS).collect()))


def few_rows(spark):
    i = F.col("event_id")
    ev = spark.range(2_000).select(
        F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, id * 37 % 800)").alias("ts"),
        (F.col("id") % 5).alias("user_id"), F.element_at(F.array(*map(F.lit, ("signup", "purchase", "click", "error", "view"))),
                                                        (F.col("id") * 31 % 5 + 1).cast("int")).alias("event_type"),
        (F.col("id") % 41).cast("double").alias("value"))
    from meterline.plans.adapters import canonical_events
    return canonical_events(ev).withColumn("theme_id", F.when(i % 7 == 0, F.col("theme_id"))).cache()


def test_sessions_over_small_ranges_share_tasks(spark):
    from meterline.operators import sessions as Z
    from meterline.operators.ordered import LEAST_TASKS, plan_chunks, with_chunks
    from meterline.params import ENTITY
    from meterline.plans.adapters import DRIVER_SESSION
    log = few_rows(spark)
    spec = plan_chunks(log, ENTITY, "tran_ts", 20)
    assert with_chunks(Z.event_priority(log), ENTITY, "tran_ts", spec, Z.ORDER).rdd.getNumPartitions() <= LEAST_TASKS < spec.ranges
    got, want = (Z.sessionize(log, DRIVER_SESSION, chunk_micros=c) for c in (spec, None))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_balances_over_small_ranges_share_tasks(spark):
    from meterline.operators import curate as C
    from meterline.operators import sessions as Z
    from meterline.operators.ordered import LEAST_TASKS, plan_chunks, with_chunks
    from meterline.params import ENTITY, SESSION_KEY
    from meterline.plans.adapters import DRIVER_SESSION
    log = few_rows(spark)
    spec = plan_chunks(log, ENTITY, "tran_ts", 20)
    rows = Z.sessionize(log, DRIVER_SESSION, chunk_micros=None).cache()
    assert with_chunks(rows, SESSION_KEY, "tran_ts", spec, C.ORDER).rdd.getNumPartitions() <= LEAST_TASKS < spec.ranges
    got, want = (C.running_balance(rows, chunk_micros=c).select("event_id", "credit_meter") for c in (spec, None))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
