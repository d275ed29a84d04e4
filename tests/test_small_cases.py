"""Hand-made cases for the boundary rules of sessions, quality rules and curation."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators import curate as C
from meterline.operators import quality as Q
from meterline.operators import sessions as Z
from meterline.schemas import CANONICAL

T0 = datetime(2024, 1, 1, 12, 0, 0)
HIGH = 60000  # meter above the default credit floor (50000): not a cash-out
CHUNKS = [None, 10**6]  # one chunk per machine; 1-second chunks


def events(spark, rows):
    """rows: (egm, rectype, seconds, seq, meter, amount, payout, theme, location, area)."""
    data = []
    for i, r in enumerate(rows):
        r = tuple(r) + (None,) * (10 - len(r))
        egm, typ, sec, seq, meter, amt, pay, theme, loc, area = r
        dec = lambda v: None if v is None else Decimal(str(v)).quantize(Decimal("0.01"))
        data.append((typ, egm, theme, theme and f"name {theme}", "d1", "m1", T0 + timedelta(seconds=sec),
                     seq, dec(meter), dec(amt), dec(pay), "p1", "c0", None, area, loc, "USD", "b0", i))
    schema = T.StructType(CANONICAL.fields + [T.StructField("event_id", T.LongType())])
    return spark.createDataFrame(data, schema)


def by_id(df, *cols):
    return {r["event_id"]: tuple(r[c] for c in cols) for r in df.select("event_id", *cols).collect()}


@pytest.mark.parametrize("chunk", CHUNKS)
def test_gap_is_strictly_greater(spark, chunk):
    df = events(spark, [
        ("A", "w", 0, 1, HIGH), ("A", "v", 10, 2, 0), ("A", "w", 191, 3, HIGH),    # 181 s pause
        ("B", "w", 0, 1, HIGH), ("B", "v", 10, 2, 0), ("B", "w", 190, 3, HIGH),    # exactly 180 s
    ])
    s = by_id(Z.sessionize(df, chunk_micros=chunk), "session_start", "session_number", "session_id")
    assert s[2] == ("session start", 1, "A_20240101120311_1")
    assert s[5] == (None, None, None)
    assert s[0][2] is None and s[1][2] is None  # before the first start: NULL session


@pytest.mark.parametrize("chunk", CHUNKS)
def test_no_cash_out_means_no_session(spark, chunk):
    df = events(spark, [("A", "w", i * 1000, i, HIGH) for i in range(5)])
    out = Z.sessionize(df, chunk_micros=chunk)
    assert out.where(F.col("session_id").isNotNull()).count() == 0
    assert out.count() == 5


@pytest.mark.parametrize("chunk", CHUNKS)
def test_null_sequence_sorts_last(spark, chunk):
    # same second: seq 1, NULL (the cash-out), 2; then a 200 s pause
    df = events(spark, [("A", "w", 0, 1, HIGH), ("A", "v", 0, None, 0), ("A", "w", 0, 2, HIGH),
                        ("A", "t", 200, 3, HIGH)])
    s = by_id(Z.sessionize(df, chunk_micros=chunk), "session_start", "next_delta", "prev_delta")
    assert s[3] == ("session start", None, 200)   # the NULL-seq cash-out is last in its second
    assert s[1][1] == 200


@pytest.mark.parametrize("chunk", CHUNKS)
def test_second_boundaries(spark, chunk):
    df = events(spark, [("A", "w", 0.9, 1, HIGH), ("A", "w", 1.1, 2, HIGH)])
    s = by_id(Z.sessionize(df, chunk_micros=chunk), "prev_delta", "next_delta")
    assert s[0] == (None, 1) and s[1] == (1, None)


def sessions_frame(spark, rows):
    """Hand-made sessionized rows: (session, rectype, seconds, seq, amount, payout, meter)."""
    base = []
    for sid, typ, sec, seq, amt, pay, *meter in rows:
        base.append(("A", typ, sec, seq, meter[0] if meter else HIGH, amt, pay))
    df = events(spark, base)
    sid_of = {i: r[0] for i, r in enumerate(rows)}
    m = F.create_map(*[x for k, v in sid_of.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn("session_id", m[F.col("event_id")]).withColumn(
        "sort_priority", F.lit(1))


@pytest.mark.parametrize("chunk", CHUNKS)
def test_bracket_rules(spark, chunk):
    df = sessions_frame(spark, [
        ("s1", "t", 0, 1, 1, 0), ("s1", "pss", 10, None, None, None), ("s1", "pse", 20, None, None, None),
        ("s2", "t", 100, 2, 1, 0), ("s2", "pss", 110, None, None, None), ("s2", "w", 120, 3, 1, 0),
        ("s2", "pse", 130, None, None, None),
        ("s3", "t", 200, 4, 1, 0), ("s3", "pss", 210, None, None, None),
    ])
    checked = Q.checked_frame(df, chunk_micros=chunk)
    empty = {r.session_id for r in Q.empty_bracket(checked, chunk).collect()}
    incomplete = {r.session_id for r in Q.bracket_incomplete(checked).collect()}
    assert empty == {"s1"} and incomplete == {"s3"}
    assert {r.session_id for r in Q.bracket_rule(checked, chunk).collect()} == {"s1", "s3"}


@pytest.mark.parametrize("chunk", CHUNKS)
def test_intensity_rule(spark, chunk):
    df = sessions_frame(spark, [
        ("s1", "w", 0.1, 1, 2, 0), ("s1", "w", 0.5, 2, 3, 0),      # two wagers in one second
        ("s2", "w", 10, 3, 2, 0),                                  # one wager only
        ("s3", "w", 20, 4, 2, 0), ("s3", "w", 25, 5, 3, 0),        # 5 s apart
    ])
    got = {r.session_id for r in Q.zero_intensity(Q.checked_frame(df, chunk), chunk).collect()}
    assert got == {"s1"}


def test_amount_rules_and_clamp(spark):
    df = sessions_frame(spark, [
        ("s1", "w", 0, 1, -1, -1), ("s2", "w", 10, 2, 0, 0), ("s3", "w", 20, 3, None, None),
    ])
    checked = Q.checked_frame(df, chunk_micros=None)
    assert {r.session_id for r in Q.negative_amount_sessions(checked).collect()} == {"s1"}
    # amount 0 counts as a wager; NULL does not; -1 does not
    assert {r.session_id for r in Q.min_wager_sessions(checked).collect()} == {"s1", "s3"}
    pay = by_id(checked, "payout")
    assert pay == {0: (Decimal("0.00"),), 1: (Decimal("0.00"),), 2: (None,)}


@pytest.mark.parametrize("chunk", CHUNKS)
def test_theme_fill_coalescing_versus_strict(spark, chunk):
    rows = [("A", "w", i, i, HIGH, 1, 0, th) for i, th in enumerate(["a", None, None, "b"])]
    df = events(spark, rows).withColumn("session_id", F.lit("s1")).withColumn("sort_priority", F.lit(1))
    back = by_id(Q.theme_backfill(df, chunk_micros=chunk), "theme_id")
    strict = by_id(C.strict_prev_fill(df, chunk_micros=chunk), "theme_id")
    assert [back[i][0] for i in range(4)] == ["a", "a", "a", "b"]
    assert [strict[i][0] for i in range(4)] == [None, "a", "a", "a"]


@pytest.mark.parametrize("chunk", CHUNKS)
def test_running_balance(spark, chunk):
    rows = [("A", "t", 0, 1, HIGH, 10, 0), ("A", "w", 1, 2, HIGH, 2, None), ("A", "x", 2, 3, HIGH, 1, 3),
            ("A", "v", 3, 4, HIGH, 5, 0), ("A", "n", 4, 5, HIGH, 7, 0)]
    df = events(spark, rows).withColumn("session_id", F.lit("s1")).withColumn("sort_priority", F.lit(1))
    bal = by_id(C.running_balance(df, chunk_micros=chunk), "credit_meter")
    assert [bal[i][0] for i in range(5)] == [Decimal(x) for x in ("10.00", "10.00", "12.00", "7.00", "7.00")]


def test_area_fill(spark):
    rows = [("A", "w", i, i, HIGH, 1, 0, None, loc, None) for i, loc in enumerate(["ab", "abcd", "abcdef"])]
    rows.append(("A", "w", 9, 9, HIGH, 1, 0, None, "zzzzzz", "K1"))
    got = by_id(C.area_fill(events(spark, rows)), "area_id")
    assert [got[i][0] for i in range(4)] == ["ab", "abcd", "abcd", "K1"]


def test_first_event_rule(spark):
    df = sessions_frame(spark, [
        ("s1", "t", 0, 1, 1, 0), ("s1", "w", 10, 2, 1, 0),
        ("s2", "w", 100, 3, 1, 0), ("s2", "t", 110, 4, 1, 0),
    ])
    got = {r.session_id for r in Q.first_event_rule(Q.checked_frame(df, chunk_micros=None)).collect()}
    assert got == {"s2"}


def landing_rows(spark, n=400):
    """Landing rows of seven machines, every third one loaded twice, some without a machine or meter."""
    from meterline.schemas import LANDING
    i = F.col("id")
    base = spark.range(n).unionByName(spark.range(0, n, 3))
    text = {"egmid": F.when(i % 13 != 0, (i % 7).cast("string")), "customer": F.concat(F.lit("c"), i % 2)}

    def frame(name):
        cols = []
        for f in LANDING[name].fields:
            kind = f.dataType.simpleString()
            c = (text[f.name] if f.name in text else F.lit("b0") if f.name == "batch_id" else
                 F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id % 50 as int))") if kind.startswith("timestamp") else
                 F.when(i % 11 != 0, i % 17))
            cols.append(c.cast(f.dataType).alias(f.name))
        return base.select(*cols)
    return frame


def hash_exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_copies_leave_the_secondary_branch_in_the_scans_own_shuffle(spark):
    from meterline.operators import events as N
    frame = landing_rows(spark)
    start, end = frame("secondarygamestarted_raw"), frame("secondarygameended_raw")
    got = N.secondary_deltas(start, end)
    assert hash_exchanges(got) == 1  # one distinct and one window each had their own
    once = N.secondary_deltas(start.distinct(), end.distinct(), chunk_micros=1)  # the path of hot machines
    assert 0 < got.count() < start.count() + end.count()
    assert sorted(map(str, got.collect())) == sorted(map(str, once.collect()))


def test_wagers_are_dealt_by_machine_once(spark):
    from meterline.operators import events as N
    frame = landing_rows(spark)
    start, end = frame("primarygamestarted_raw"), frame("gameended_raw")
    got = N.wager_events(start, end)
    assert hash_exchanges(got) == 1  # the pairs' and the meters' windows had one each
    cut = N.wager_events(start, end, chunk_micros=3_600_000_000)
    assert got.count() == start.count() + end.count()
    assert sorted(map(str, got.collect())) == sorted(map(str, cut.collect()))
