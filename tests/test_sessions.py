"""Sessionization (Z1-Z11) against the SQL oracle, across chunk sizes."""

import pytest
from pyspark.sql import functions as F

from meterline.operators import sessions as Z
from meterline.plans.adapters import DRIVER_SESSION, canonical_events, table
from meterline.plans.oracle import ORACLE
from tests.conftest import SF, assert_same


@pytest.fixture(scope="module")
def canon(spark):
    return canonical_events(table(spark, SF, "events")).cache()


# None: one chunk per machine; small widths force many chunk boundaries
# (1 minute: nearly every event is alone in its chunk).
@pytest.mark.parametrize("chunk", [None, 6 * 3600 * 10**6, 3600 * 10**6, 60 * 10**6])
def test_sessionize_matches_oracle(spark, duck, canon, chunk):
    df = Z.sessionize(canon, DRIVER_SESSION, chunk_micros=chunk)
    assert_same(df, duck(), ORACLE["sessionized"])


@pytest.mark.parametrize("chunk", [None, 3600 * 10**6])
def test_stepwise_matches_oracle(spark, duck, canon, chunk):
    df = Z.sessionize_stepwise(canon, DRIVER_SESSION, chunk_micros=chunk)
    assert_same(df, duck(), ORACLE["sessionized"])


def test_properties(spark, canon):
    df = Z.sessionize(canon, DRIVER_SESSION, chunk_micros=3600 * 10**6)
    assert df.count() == canon.count()
    # session numbers per machine are 1..n
    nums = (df.where(F.col("session_number").isNotNull())
            .groupBy("customer", "batch_id", "egm_id")
            .agg(F.count("*").alias("n"), F.min("session_number").alias("lo"),
                 F.max("session_number").alias("hi"),
                 F.countDistinct("session_number").alias("d")))
    assert nums.where((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n"))).count() == 0
    # repartitioning the input changes nothing
    a = sorted(tuple(r) for r in df.select("event_id", "session_id").collect())
    b = sorted(tuple(r) for r in Z.sessionize(canon.repartition(3), DRIVER_SESSION,
                                               chunk_micros=None).select("event_id", "session_id").collect())
    assert a == b


def test_fused_plan_has_one_shuffle(spark, canon):
    df = Z.sessionize(canon, DRIVER_SESSION, chunk_micros=None)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # no key is hot: one exchange of the rows, no carries, one scan
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("FileScan") == 1


def test_sessionize_with_every_machine_hot(spark, duck, canon):
    from meterline.operators.ordered import plan_chunks
    from meterline.params import ENTITY
    spec = plan_chunks(canon, ENTITY, "tran_ts", target_rows=10)
    assert spec.ranges > 100
    assert_same(Z.sessionize(canon, DRIVER_SESSION, chunk_micros=spec), duck(), ORACLE["sessionized"])
