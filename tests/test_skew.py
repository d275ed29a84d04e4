"""A machine holding a third of all events is cut into even chunks, whatever its times, with the same result."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterline.operators import sessions as Z
from meterline.operators.ordered import (
    CHUNK, GROUP, FillForward, Lag, Lead, RowNumber, RunningSum, ordered_scan, plan_chunks, sort_cols, with_chunks,
)
from meterline.params import ENTITY, SESSION_KEY
from meterline.plans.adapters import DRIVER_SESSION, canonical_events, table
from tests.conftest import SF

TARGET = 200


def hot_times():
    instant = F.lit("2024-01-05 12:00:00").cast("timestamp_ntz")
    within = F.pmod(F.col("event_id") * 7919, F.lit(1_000_000)) / 1e6
    return {"even": F.col("ts"), "burst": instant + F.make_dt_interval(secs=within), "instant": instant}


def hot_events(spark, times):
    """Every third event moves to machine 0, at the given times."""
    hot = F.col("event_id") % 3 == 0
    ev = table(spark, SF, "events")
    return ev.withColumns({"user_id": F.when(hot, F.lit(0)).otherwise(F.col("user_id")),
                           "event_type": F.when(hot & F.lit(times == "instant"), F.lit("purchase")).otherwise(F.col("event_type")),
                           "ts": F.when(hot, hot_times()[times]).otherwise(F.col("ts"))})


def chunk_sizes(df, spec, keys, ts, order):
    return (with_chunks(df, keys, ts, spec, order).groupBy(GROUP, CHUNK).count()
            .agg(F.max("count").alias("mx"), F.countDistinct(CHUNK).alias("ranges")).first())


@pytest.mark.parametrize("times", ["even", "burst", "instant"])
def test_hot_machine_is_split(spark, times):
    hot = Z.event_priority(canonical_events(hot_events(spark, times))).cache()
    n = hot.count()
    spec = plan_chunks(hot, ENTITY, "tran_ts", target_rows=TARGET)
    sizes = chunk_sizes(hot, spec, ENTITY, "tran_ts", Z.ORDER)
    assert sizes.mx <= 2 * TARGET < n // 3
    assert sizes.ranges <= 2 * n // TARGET             # never one chunk per row
    cols = ["event_id", "session_id", "session_number", "next_delta", "prev_delta", "session_state"]
    b = Z.sessionize(hot, DRIVER_SESSION, chunk_micros=None)
    assert (sorted(map(tuple, Z.sessionize(hot, DRIVER_SESSION, chunk_micros=spec).select(*cols).collect()))
            == sorted(map(tuple, b.select(*cols).collect())))
    # the generic scan over sessions with the same plan
    ops = [Lag("tran_amt", "l1"), Lag("tran_amt", "l2", 2), Lead("tran_amt", "n1"), RunningSum("tran_amt", "cs"),
           FillForward("theme_id", "ff")]
    c2 = ["event_id", "l1", "l2", "n1", "cs", "ff"]
    x, y = (ordered_scan(b, SESSION_KEY, Z.ORDER, "tran_ts", ops, chunk_micros=c).select(*c2) for c in (spec, None))
    assert sorted(map(tuple, x.collect())) == sorted(map(tuple, y.collect()))


def test_hot_instant_with_a_text_tie_breaker(spark):
    """One machine, one instant, ordered by a text column: cut as evenly, same as the plain window."""
    order = (("ts", False), ("code", True))
    df = hot_events(spark, "instant").select("user_id", "ts", "value", F.concat(F.lit("c"), F.col("event_id")).alias("code")).cache()
    spec = plan_chunks(df, ["user_id"], "ts", TARGET)
    sizes = chunk_sizes(df, spec, ["user_id"], "ts", order)
    assert sizes.mx <= 2 * TARGET
    w = Window.partitionBy("user_id").orderBy(*sort_cols(order))
    want = df.select("code", F.lag("value", 2).over(w).alias("l"), F.row_number().over(w).cast("long").alias("rn"))
    got = ordered_scan(df, ["user_id"], order, "ts", [Lag("value", "l", 2), RowNumber("rn")], chunk_micros=spec)
    assert sorted(map(tuple, got.select("code", "l", "rn").collect())) == sorted(map(tuple, want.collect()))


def test_one_event_sent_again_with_other_meters_gives_one_result(spark):
    """Ties on time and type: the result doesn't depend on how the input is partitioned."""
    from meterline.operators import events as N
    from meterline.plans.landing import landing_tables
    raw = landing_tables(spark, SF)
    start, end = raw["primarygamestarted_raw"], raw["gameended_raw"]
    again = start.filter(F.col("gameplaylogsequence") % 50 == 0).withColumn(
        "g2s_wageredcashableamt", (F.col("g2s_wageredcashableamt") + 1).cast("decimal(18,2)"))
    start = start.unionByName(again)
    seen = []
    for parts in (1, 3, 7):
        got = N.wager_events(start.repartition(parts), end.repartition(parts))
        seen.append(sorted(map(str, got.collect())))
    assert seen[0] == seen[1] == seen[2]
