"""Load log, guard and the availableNow file stream."""

from datetime import datetime

from pyspark.sql import functions as F

from meterline.sources import loadlog as LG
from meterline.streaming.incremental import stream_available_now
from meterline.plans.adapters import table
from tests.conftest import SF_SMALL


def test_log_state_and_guard(spark):
    rows = [("FM", "a/1.parquet", datetime(2024, 1, 1, 10, 0, 0), "Started"),
            ("FM", "a/1.parquet", datetime(2024, 1, 1, 10, 0, 59), "Completed"),
            ("FM", "a/2.parquet", datetime(2024, 1, 1, 10, 1, 0), "Started"),
            ("XX", "a/3.parquet", datetime(2024, 1, 1, 10, 1, 0), "Started")]
    log = spark.createDataFrame(rows, "source_name string, file_name string, load_start timestamp, load_status string")
    state = {r.file_name: r.load_status for r in LG.log_state(log).collect()}
    assert state == {"a/1.parquet": "Completed", "a/2.parquet": "Started", "a/3.parquet": "Started"}
    assert [r.file_name for r in LG.in_progress_files(log, "FM").collect()] == ["a/2.parquet"]
    inv = spark.createDataFrame([("loc/", "a/1.parquet"), ("loc/", "a/2.parquet"), ("loc/", "a/4.parquet")],
                                "location string, file_name string")
    assert sorted(r.file_name for r in LG.pending_files(inv, log, "FM").collect()) == ["a/2.parquet", "a/4.parquet"]
    # minute boundaries: 10:00:59 -> 10:01:00 is one minute
    m = spark.range(1).select(LG.minutes_between(F.lit(datetime(2024, 1, 1, 10, 0, 59)),
                                                 F.lit(datetime(2024, 1, 1, 10, 1, 0))).alias("m")).first().m
    assert m == 1


def test_stream_adds_only_new_files(spark, tmp_path):
    src, sink, ck = (str(tmp_path / n) for n in ("src", "sink", "ck"))
    ev = table(spark, SF_SMALL, "events").withColumns({"customer": F.lit("c0"), "batch_id": F.lit("b0")})
    first, second = ev.where("event_id % 2 = 0"), ev.where("event_id % 2 = 1")
    first.write.mode("overwrite").parquet(f"{src}")
    stream_available_now(spark, src, ev.schema, sink, ck)
    stream_available_now(spark, src, ev.schema, sink, ck)          # re-run: nothing new
    assert spark.read.schema(ev.schema).parquet(sink).count() == first.count()
    second.write.mode("append").parquet(f"{src}")                  # new files arrive
    stream_available_now(spark, src, ev.schema, sink, ck)
    got = spark.read.schema(ev.schema).parquet(sink)
    assert got.count() == ev.count()
    assert got.select("event_id").distinct().count() == ev.count()
