import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.queries import live
from tidemark.session import scratch_dir
from tidemark.sources import inputs as I
from tidemark.streaming.sessions import KeyedSink, read_stream, session_aggregate

SCHEMA = "event_id long, viewer_id string, event_ts timestamp, event_type string, watch_seconds double, produced_epoch_ms long"
T = dt.datetime(2024, 1, 1, 12)


def drop(spark, folder, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_drain_late_rows_and_lost_checkpoint(spark):
    src, root = scratch_dir(spark, "src"), scratch_dir(spark, "sink")
    drop(spark, src, [(1, "a", T, "skip", 30.0, 5), (2, "b", T, "complete", None, 6)])
    schema = spark.read.parquet(src).schema
    sink, ck = KeyedSink(spark, root, ["viewer_id"]), scratch_dir(spark, "ck")
    run = lambda where: sink.drain(session_aggregate(read_stream(spark, src, schema)), where)
    run(ck)
    assert rows(sink.current(), "viewer_id", "session_seconds", "session_skips", "session_events") == [("a", 30.0, 1, 1), ("b", 0.0, 0, 1)]
    drop(spark, src, [(3, "a", T - dt.timedelta(days=9), "complete", 12.0, 4)])     # far behind the watermark
    run(ck)
    run(ck)                                                                          # nothing new
    want = [("a", 42.0, 1, 2), ("b", 0.0, 0, 1)]
    assert rows(sink.current(), "viewer_id", "session_seconds", "session_skips", "session_events") == want
    run(scratch_dir(spark, "ck"))                                                    # checkpoint lost: full replay
    assert rows(sink.current(), "viewer_id", "session_seconds", "session_skips", "session_events") == want
    assert sink.freshness().first()["n"] >= 2


def test_append_mode_is_rejected(spark):
    src = scratch_dir(spark, "src")
    drop(spark, src, [(1, "a", T, "skip", 30.0, 5)])
    agg = session_aggregate(read_stream(spark, src, spark.read.parquet(src).schema))
    with pytest.raises(Exception, match="(?i)append"):
        agg.writeStream.outputMode("append").format("noop").option("checkpointLocation", scratch_dir(spark, "ck")).start()


def test_a_lost_batch_is_done_again_from_the_same_checkpoint(spark, sf):
    sink, progress = live.resumed(spark, sf)
    # The first batch was committed and is not read again; the lost one keeps its number.
    assert [p["batchId"] for p in progress if p["numInputRows"]] == [1, 2]
    assert any("rocksdb" in k.lower() for p in progress for o in p["stateOperators"] for k in o["customMetrics"])
    assert sorted(r.batch for r in sink.rows().select("batch").distinct().collect()) == [0, 1, 2]
    ev = I.events(spark, sf)
    assert sink.current().agg(F.sum("session_events")).first()[0] == ev.count()
    # A batch that is written once more changes nothing.
    was = rows(sink.current())
    last = spark.read.parquet(f"{sink.root}/rows").where("batch = 2").drop("generation", "batch")
    again = spark.createDataFrame(last.collect(), last.schema)
    again.write.mode("overwrite").parquet(f"{sink.root}/rows/generation=0/batch=2")
    assert rows(sink.current()) == was


def test_a_compaction_broken_off_between_its_renames_is_finished(spark, tmp_path):
    root = str(tmp_path / "sink")
    sink = KeyedSink(spark, root, ["k"])
    for batch, data in ((0, [(1, 10), (2, 20)]), (1, [(2, 21)])):
        spark.createDataFrame(data, "k long, v long").write.parquet(f"{root}/rows/generation=0/batch={batch}")
    sink.compact()
    want = [(1, 10), (2, 21)]
    assert rows(sink.current(), "k", "v") == want and sink.rows().count() == 2
    Path(root, "rows").rename(Path(root, "compacted"))
    assert rows(sink.current(), "k", "v") == want
    assert not Path(root, "compacted").exists() and not Path(root, "replaced").exists()
