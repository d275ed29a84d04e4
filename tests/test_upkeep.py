"""Replayed rejects, cleaning of broken loads, rows sent again."""

import pytest
from pyspark.sql import functions as F

from meterline.plans.landing import landing_tables
from meterline.plans.oracle import ORACLE
from meterline.plans.registry import QUERIES
from meterline.schemas import LANDING
from meterline.streaming import incremental as I
from meterline.streaming import upkeep as U
from tests.conftest import SF_SMALL, assert_same

NOTES = "notestacked_raw"


@pytest.mark.parametrize("name", ["replayed_rejects", "events_sent_again"])
def test_keys_against_sql(spark, duck, name):
    assert_same(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE[name])


@pytest.fixture
def place(spark, tmp_path):
    notes = landing_tables(spark, SF_SMALL)[NOTES].drop("batch_id").limit(30).coalesce(1)
    text = F.when(F.monotonically_increasing_id() % 10 == 0, "n/a").otherwise(F.col("noteacceptorlogsequence").cast("string"))
    notes.withColumn("noteacceptorlogsequence", text).write.parquet(f"{tmp_path}/landing/notestacked/one")
    target, log = f"{tmp_path}/wh", f"{tmp_path}/wh/load_log"
    I.load_pending_files(spark, f"{tmp_path}/landing", target, log, "b1")
    return target, log


def rows(spark, target, log):
    return I.read_loaded(spark, f"{target}/{NOTES}", LANDING[NOTES], I.read_log(spark, log))


MEND = {NOTES: {"noteacceptorlogsequence": lambda c: F.nullif(c, F.lit("n/a"))}}


def test_rejects_land_once_and_only_when_they_cast(spark, place):
    assert rows(spark, *place).count() == 27
    assert U.replay_rejects(spark, *place) is None and rows(spark, *place).count() == 27
    assert U.replay_rejects(spark, *place, repairs=MEND)
    assert U.replay_rejects(spark, *place, repairs=MEND) is None
    assert rows(spark, *place).count() == 30
    assert U.open_rejects(spark, place[0], I.read_log(spark, place[1])).count() == 0


def test_a_broken_replay_is_unseen_and_then_cleaned(spark, place, monkeypatch):
    monkeypatch.setattr(U.LG, "log_close", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        U.replay_rejects(spark, *place, repairs=MEND)
    monkeypatch.undo()
    assert rows(spark, *place).count() == 27 and I.unpublished_rows(spark, *place) == {NOTES: 3}
    assert U.clean_unpublished(spark, *place) == []  # it may still run
    assert I.unpublished_rows(spark, *place) == {NOTES: 3}
    assert len(U.clean_unpublished(spark, *place, hours=0)) == 1
    assert I.unpublished_rows(spark, *place) == {} and U.clean_unpublished(spark, *place, hours=0) == []
    assert U.replay_rejects(spark, *place, repairs=MEND) and rows(spark, *place).count() == 30


def test_rows_sent_again(spark, tmp_path):
    mk = lambda r, b: spark.createDataFrame(r, "a long, b string").withColumn("batch_id", F.lit(b))
    d = f"{tmp_path}/digests"
    send = lambda r, b: sorted(((x.a, x.b) for x in U.first_sent(mk(r, b), d, b).collect()), key=str)
    assert send([(1, "x"), (1, "x"), (None, None), (2, None)], "b1") == [(1, "x"), (1, "x"), (2, None), (None, None)]
    again = [(1, "x"), (None, None), (2, ""), (None, "x"), (3, "z")]
    assert send(again, "b2") == [(2, ""), (3, "z"), (None, "x")]
    assert send(again, "b2") == [(2, ""), (3, "z"), (None, "x")]  # a batch that is run again
    assert send([(3, "z"), (2, None), (4, "y")], "b3") == [(4, "y")]
    assert send([], "b4") == []
