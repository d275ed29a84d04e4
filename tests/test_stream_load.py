"""The stream form of the loader: a log, rejects, and each file once, whatever breaks."""

import os

import pytest
from pyspark.sql import functions as F

from meterline.plans.landing import landing_tables
from meterline.schemas import LANDING
from meterline.sources.loadlog import log_state
from meterline.streaming import incremental as I
from tests.conftest import SF_SMALL


class Place:
    def __init__(self, spark, root, notes):
        self.spark, self.landing, self.target, self.ck, self.notes = spark, f"{root}/landing", f"{root}/wh", f"{root}/ck", notes
        self.log = f"{root}/wh/load_log"

    def land(self, name, df=None, n=30):
        (self.notes.limit(n) if df is None else df).coalesce(1).write.parquet(f"{self.landing}/notestacked/{name}")

    def load(self, **how):
        return I.stream_load(self.spark, self.landing, self.target, self.log, "b1", self.ck, **how)

    def rows(self):
        return I.read_loaded(self.spark, f"{self.target}/notestacked_raw", LANDING["notestacked_raw"], I.read_log(self.spark, self.log))

    def states(self):
        return {r.file_name.split("/")[1]: (r.load_status, r.error_cnt)
                for r in log_state(I.read_log(self.spark, self.log), at=None).collect()}


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path, landing_tables(spark, SF_SMALL)["notestacked_raw"].drop("batch_id").cache())


def test_new_files_are_loaded_once(place):
    place.land("one", n=20)
    place.land("two words+plus", n=10)
    got = place.load()
    assert got.status == "proceed" and place.rows().count() == 30
    assert place.load().status == "skip"
    place.land("three", n=5)
    assert len(place.load().loads) == 1 and place.rows().count() == 35
    assert set(place.states().values()) == {("Completed", 0)}


def test_bad_files_and_values_fail_alone(place):
    place.land("good", n=20)
    place.land("text", place.notes.limit(30).withColumn("noteacceptorlogsequence", F.when(
        F.monotonically_increasing_id() % 10 == 0, "n/a").otherwise(F.col("noteacceptorlogsequence").cast("string"))))
    with open(f"{place.landing}/notestacked/broken.parquet", "wb") as f:
        f.write(b"not a parquet file")
    place.load()
    got = place.states()
    assert got["good"] == ("Completed", 0) and got["text"] == ("Completed", 3) and got["broken.parquet"][0] == "Failed"
    assert place.rows().count() == 47 and place.spark.read.parquet(f"{place.target}/{I.REJECTS_TABLE}").count() == 3


@pytest.mark.parametrize("published", [False, True])
def test_a_killed_epoch_is_loaded_exactly_once(place, monkeypatch, published):
    """Killed between its writes and its log rows, or between its log rows and the stream's commit."""
    place.land("one", n=20)
    place.load()
    place.land("two", n=10)
    real = I._load

    def dies(*args):
        if published:
            real(*args)
        else:
            monkeypatch.setattr(I, "load_stats", lambda *a: 1 / 0)
            real(*args)
        raise RuntimeError("killed")

    stats = I.load_stats
    monkeypatch.setattr(I, "_load", dies)
    with pytest.raises(Exception):
        place.load()
    monkeypatch.setattr(I, "_load", real)
    monkeypatch.setattr(I, "load_stats", stats)
    assert place.rows().count() == (30 if published else 20)
    assert place.load().status == ("skip" if published else "proceed")
    assert place.rows().count() == 30 and place.states()["two"][0] == "Completed"
    lost = I.unpublished_rows(place.spark, place.target, place.log)
    assert lost == ({} if published else {"notestacked_raw": 10})
    assert place.load().status == "skip"


def test_a_backlog_takes_several_epochs(place):
    for k in range(5):
        place.land(f"f{k}", n=4)
    assert len(place.load(files_per_load=2).loads) == 3 and place.rows().count() == 20


def test_both_forms_share_the_log(place):
    place.land("one", n=20)
    place.load()
    assert I.load_pending_files(place.spark, place.landing, place.target, place.log, "b1").status == "skip"
    place.land("two", n=10)
    I.load_pending_files(place.spark, place.landing, place.target, place.log, "b1")
    assert place.load().status == "skip" and place.rows().count() == 30
    assert not [n for n in os.listdir(f"{place.landing}/notestacked") if n.startswith("_spark")]
