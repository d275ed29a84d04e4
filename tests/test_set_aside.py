"""Files that can't be read: retried apart, set aside, taken up again when they change."""

import os

import pytest
from pyspark.sql import functions as F

from meterline.plans.landing import landing_tables
from meterline.schemas import LANDING
from meterline.streaming import incremental as I
from tests.conftest import SF_SMALL

NOTES = "notestacked_raw"


@pytest.fixture
def place(spark, tmp_path):
    notes = landing_tables(spark, SF_SMALL)[NOTES].drop("batch_id").limit(20).coalesce(1).cache()
    os.makedirs(f"{tmp_path}/landing/notestacked")
    with open(f"{tmp_path}/landing/notestacked/broken.parquet", "wb") as f:
        f.write(b"not a parquet file")
    return notes, f"{tmp_path}/landing", f"{tmp_path}/wh", f"{tmp_path}/wh/load_log"


def test_a_damaged_file_is_tried_apart_then_set_aside_until_it_changes(spark, place, monkeypatch):
    notes, landing, target, log = place
    examined, examine = [], I.examine
    monkeypatch.setattr(I, "examine", lambda s, paths: examined.append(sorted(p.rsplit("/", 1)[1] for p in paths))
                        or examine(s, paths))
    count = lambda: I.read_loaded(spark, f"{target}/{NOTES}", LANDING[NOTES], I.read_log(spark, log)).count()
    for k in range(3):
        notes.write.parquet(f"{landing}/notestacked/good{k}")
        assert I.load_pending_files(spark, landing, target, log, "b1").status == "proceed"
        assert count() == 20 * (k + 1)
    # the first load meets it beside a good file; later loads read the good files strictly
    assert len(examined) == 3 and len(examined[0]) == 2 and examined[1:] == [["broken.parquet"]] * 2
    assert I.load_pending_files(spark, landing, target, log, "b1").status == "skip" and len(examined) == 3
    assert [(r.file_name, r.tries) for r in I.set_aside(spark, landing, log).collect()] == [("notestacked/broken.parquet", 3)]
    assert I.read_log(spark, log).where("error is not null and load_status = 'Failed'").count() == 3

    part = next(f for f in os.listdir(f"{landing}/notestacked/good0") if f.endswith(".parquet"))
    with open(f"{landing}/notestacked/good0/{part}", "rb") as f, open(f"{landing}/notestacked/broken.parquet", "wb") as g:
        g.write(f.read())
    later = max(r.load_start for r in I.read_log(spark, log).select("load_start").collect()).timestamp() + 60
    os.utime(f"{landing}/notestacked/broken.parquet", (later, later))
    assert I.load_pending_files(spark, landing, target, log, "b1").status == "proceed" and count() == 80
    assert I.set_aside(spark, landing, log).count() == 0


def test_a_load_that_breaks_by_itself_uses_up_no_try(spark, place, monkeypatch):
    notes, landing, target, log = place
    notes.write.parquet(f"{landing}/notestacked/good")
    monkeypatch.setattr(I, "load_stats", lambda *a: 1 / 0)
    for _ in range(2):
        with pytest.raises(ZeroDivisionError):
            I.load_pending_files(spark, landing, target, log, "b1", max_tries=1)
    assert I.read_log(spark, log).where(F.col("load_status") == "Failed").count() == 4
    assert I.set_aside(spark, landing, log, max_tries=1).count() == 0
    monkeypatch.undo()
    assert I.load_pending_files(spark, landing, target, log, "b1", max_tries=1).status == "proceed"
    assert I.read_loaded(spark, f"{target}/{NOTES}", LANDING[NOTES], I.read_log(spark, log)).count() == 20
    assert I.set_aside(spark, landing, log, max_tries=1).count() == 1
