"""End to end: landing files -> ingest -> raw model -> sessions -> rules -> curated."""

import os

import pytest
from pyspark.sql import functions as F

from meterline.operators import events as N
from meterline.plans import pipeline as P
from meterline.plans.landing import landing_tables
from meterline.schemas import LANDING
from meterline.sources.loadlog import in_progress_files, log_state
from meterline.streaming.incremental import REJECTS_TABLE, read_log
from tests.conftest import SF_SMALL


def write_landing(spark, root, tables, part="part-0"):
    for name, df in tables.items():
        folder = name[: -len("_raw")]
        df.drop("batch_id").coalesce(1).write.mode("overwrite").parquet(f"{root}/{folder}/{part}")


@pytest.fixture(scope="module")
def setup(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("wh")
    landing_root, wh = str(base / "landing"), P.Warehouse(str(base / "warehouse"))
    tables = landing_tables(spark, SF_SMALL)
    write_landing(spark, landing_root, tables)
    return spark, landing_root, wh, tables


def counts(spark, wh):
    return {t: wh.read(spark, t).count()
            for t in (P.RAW, P.SESSIONIZED, P.VIOLATIONS, P.QUARANTINE, P.CURATED)}


def test_ingest_then_pipeline(setup):
    spark, landing_root, wh, tables = setup
    got = P.ingest(spark, landing_root, wh, "b1")
    assert (got.status, got.batch_id, len(got.loads)) == ("proceed", "b1", 1)
    assert P.ingest(spark, landing_root, wh, "b1").status == "skip"          # nothing pending
    log = read_log(spark, wh.path(P.LOAD_LOG))
    assert in_progress_files(log, "FM").count() == 0
    state = log_state(log, at=None)
    assert state.where(F.col("load_status") != "Completed").count() == 0
    loaded = spark.read.parquet(wh.path("primarygamestarted_raw"))
    assert loaded.count() == tables["primarygamestarted_raw"].count()
    assert loaded.select("batch_id").distinct().collect()[0][0] == "b1"

    metrics = P.run_batch(spark, wh)
    first = counts(spark, wh)
    # metrics observed while writing equal the written tables
    assert metrics["raw_model"]["rows"] == first[P.RAW]
    assert metrics["sessionize"]["rows"] == first[P.SESSIONIZED]
    assert metrics["segregate"]["violations"] == first[P.VIOLATIONS]
    assert metrics["curate"]["rows"] == first[P.CURATED]
    landing = {t: wh.read_landing(spark, t, tables[t].schema).drop(N.ROW_ID) for t in tables}
    assert first[P.RAW] == N.raw_event_log(landing).count()
    assert first[P.SESSIONIZED] == first[P.RAW]
    # re-running the batch (here through the command line) replaces, never duplicates
    from meterline.cli import main
    main(["run", "--warehouse", wh.root, "--batch", "b1"])
    assert counts(spark, wh) == first
    sess = wh.read(spark, P.CURATED).where(F.col("session_id").isNotNull()) \
        .select("customer", "batch_id", "egm_id", "session_id").distinct()
    bad = wh.read(spark, P.VIOLATIONS)
    assert bad.where(F.col("session_id").isNull()).count() == 0
    assert sess.join(bad, ["customer", "batch_id", "egm_id", "session_id"]).count() == 0


def rows(spark, wh, table="notestacked_raw"):
    return wh.read_landing(spark, table, LANDING[table])


def statuses(spark, wh):
    return {r.file_name.split("/", 1)[1].split("/")[0]: (r.load_status, r.error_cnt)
            for r in log_state(read_log(spark, wh.path(P.LOAD_LOG)), at=None).collect()}


@pytest.fixture
def small(spark, tmp_path):
    """An empty warehouse and a function that lands some of the note rows as one file."""
    tables = landing_tables(spark, SF_SMALL)
    notes = tables["notestacked_raw"].drop("batch_id").cache()

    def land(name, df=None, folder="notestacked", n=50):
        (notes.limit(n) if df is None else df).coalesce(1).write.parquet(f"{tmp_path}/landing/{folder}/{name}")

    return str(tmp_path / "landing"), P.Warehouse(str(tmp_path / "wh")), land, notes


def test_a_second_load_of_a_batch_adds_its_rows(spark, small):
    landing_root, wh, land, _ = small
    land("one", n=40)
    P.ingest(spark, landing_root, wh, "b1")
    land("two words+plus", n=30)
    assert P.ingest(spark, landing_root, wh, "b1").status == "proceed"
    assert rows(spark, wh).count() == 70
    assert P.ingest(spark, landing_root, wh, "b1").status == "skip"
    stats = log_state(read_log(spark, wh.path(P.LOAD_LOG)), at=None)
    assert stats.where("data_min is null or error_cnt <> 0").count() == 0  # also for the name with a blank and a plus
    assert read_log(spark, wh.path(P.LOAD_LOG)).count() == 4


def test_unreadable_and_unknown_files_fail_alone(spark, small):
    landing_root, wh, land, notes = small
    land("good", n=40)
    land("other", folder="neverheardof", n=5)
    with open(f"{landing_root}/notestacked/broken.parquet", "wb") as f:
        f.write(b"not a parquet file")
    assert P.ingest(spark, landing_root, wh, "b2").status == "proceed"
    assert rows(spark, wh).count() == 40
    got = statuses(spark, wh)
    assert got["good"] == ("Completed", 0) and got["broken.parquet"][0] == "Failed" and got["other"][0] == "Failed"
    os.remove(f"{landing_root}/notestacked/broken.parquet")
    land("broken.parquet", n=7)  # the file comes again, whole
    P.ingest(spark, landing_root, wh, "b2")
    assert rows(spark, wh).count() == 47 and statuses(spark, wh)["broken.parquet"] == ("Completed", 0)


def test_rows_that_do_not_cast_are_kept_apart(spark, small):
    landing_root, wh, land, notes = small
    land("good", n=10)
    odd = notes.limit(30).withColumn("noteacceptorlogsequence", F.when(
        F.monotonically_increasing_id() % 10 == 0, "n/a").otherwise(F.col("noteacceptorlogsequence").cast("string")))
    land("text", odd.cache())
    P.ingest(spark, landing_root, wh, "b3")
    rejects = spark.read.parquet(f"{wh.root}/{REJECTS_TABLE}")
    bad = odd.where("noteacceptorlogsequence = 'n/a'").count()
    assert bad and rejects.count() == bad and rows(spark, wh).count() == 40 - bad
    assert {r.error_columns for r in rejects.collect()} == {"noteacceptorlogsequence"}
    assert statuses(spark, wh) == {"good": ("Completed", 0), "text": ("Completed", bad)}


def test_files_too_large_for_a_row_are_examined(spark, small):
    """No file's contents become a row: with a limit on such rows (as Spark has one at 2 GB) each file is still judged."""
    landing_root, wh, land, notes = small
    land("good", n=40)
    land("text", notes.limit(30).withColumn("noteacceptorlogsequence", F.col("noteacceptorlogsequence").cast("string")))
    land("damaged", n=50)
    with open(f"{landing_root}/notestacked/footless.parquet", "wb") as f:
        f.write(b"not a parquet file")
    folder = f"{landing_root}/notestacked/damaged"
    name = next(n for n in os.listdir(folder) if n.endswith(".parquet"))
    with open(f"{folder}/{name}", "r+b") as f:  # the pages are lost, the footer is whole
        f.seek(4)
        f.write(b"\xff" * 400)
    for crc in (n for n in os.listdir(folder) if n.endswith(".crc")):
        os.remove(f"{folder}/{crc}")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "16")
    try:
        assert P.ingest(spark, landing_root, wh, "b1").status == "proceed"
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert rows(spark, wh).count() == 70
    got = statuses(spark, wh)
    assert got["good"] == ("Completed", 0) and got["text"] == ("Completed", 0)
    assert got["damaged"][0] == "Failed" and got["footless.parquet"][0] == "Failed"


def test_a_failed_load_publishes_nothing(spark, small, monkeypatch):
    from meterline.streaming import incremental as I
    landing_root, wh, land, notes = small
    land("one", n=20)
    land("two", landing_tables(spark, SF_SMALL)["voucherissued_raw"].drop("batch_id").limit(10), folder="voucherissued")
    real = I.load_table

    def breaks(spark, tbl, *rest):
        if tbl == "voucherissued_raw":
            raise RuntimeError("the second table can't be written")
        return real(spark, tbl, *rest)

    monkeypatch.setattr(I, "load_table", breaks)
    with pytest.raises(RuntimeError):
        P.ingest(spark, landing_root, wh, "b1")
    assert rows(spark, wh).count() == 0
    monkeypatch.setattr(I, "load_table", real)
    P.ingest(spark, landing_root, wh, "b2")
    assert rows(spark, wh).count() == 20 and rows(spark, wh, "voucherissued_raw").count() == 10


def test_a_backlog_takes_several_loads(spark, small):
    from meterline.streaming.incremental import load_pending_files
    landing_root, wh, land, _ = small
    for k in range(5):
        land(f"f{k}", n=4)
    got = load_pending_files(spark, landing_root, wh.root, wh.path(P.LOAD_LOG), "b1", files_per_load=2)
    assert len(got.loads) == 3 and rows(spark, wh).count() == 20


def test_a_rerun_leaves_no_stale_rows(setup, tmp_path):
    """Violations, quarantine and curated rows of a batch go when its corrected data have none."""
    spark, landing_root, wh, tables = setup
    if not os.path.exists(wh.path(P.SESSIONIZED)):
        P.ingest(spark, landing_root, wh, "b1")
        P.run_batch(spark, wh)
    mine = P.Warehouse(str(tmp_path / "wh"))
    sess = wh.read(spark, P.SESSIONIZED)
    none = sess.limit(0)
    done = sess.select("customer", "batch_id").distinct()
    mine.write(sess, P.SESSIONIZED, done)
    P.segregate(spark, mine)
    P.curate(spark, mine)
    assert all(n > 0 for n in (mine.read(spark, t).count() for t in (P.VIOLATIONS, P.QUARANTINE, P.CURATED)))
    # corrected: no wager is negative, no session breaks a rule, as there is no session left
    mine.write(none, P.SESSIONIZED, done)
    for c, b in [(r.customer, r.batch_id) for r in done.collect()]:
        P.segregate(spark, mine, c, b)
        P.curate(spark, mine, c, b)
    assert [mine.read(spark, t).count() for t in (P.VIOLATIONS, P.QUARANTINE, P.CURATED)] == [0, 0, 0]


def test_copies_get_distinct_ids(setup):
    """The same landing event loaded from two files: two rows, two ids."""
    spark, landing_root, wh, tables = setup
    raw = wh.read(spark, P.RAW)
    assert raw.select("event_id").distinct().count() == raw.count()
