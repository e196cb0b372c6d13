"""Streaming queries, drained to completion over the event table."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ..operators.windows import trailing
from ..plans import features as P
from ..session import scratch_dir
from ..sources import inputs as I
from ..sources.tables import BucketedTable
from ..streaming.sessions import KeyedSink, read_stream, recompute_after_live, session_aggregate
from .base_sql import with_
from .registry import query

BATCH = """SELECT viewer_id, sum(watch_seconds)::DOUBLE AS session_seconds, count(*) FILTER (event_type='skip') AS session_skips, count(*) AS session_events,
  max(CAST(floor(epoch(event_ts)) AS BIGINT)) AS last_event_epoch_s, max(produced_epoch_ms) AS src_event_epoch_ms FROM ev GROUP BY 1"""


def event_stream(spark, d):
    schema = I.table(spark, d, "events").schema
    return I.shape_events(read_stream(spark, d, schema, "events.parquet"))


def drained(spark, d):
    sink = KeyedSink(spark, scratch_dir(spark, "sessions"), ["viewer_id"])
    return sink, scratch_dir(spark, "checkpoint")


@query(with_("ev") + BATCH)
def stream_session_drained(spark, d):
    sink, ck = drained(spark, d)
    sink.drain(session_aggregate(event_stream(spark, d)), ck)
    return sink.current()


@query(with_("ev") + BATCH)
def stream_session_replayed(spark, d):
    """A lost checkpoint means a full replay; the keyed table ends up the same."""
    sink, ck = drained(spark, d)
    sink.drain(session_aggregate(event_stream(spark, d)), ck)
    sink.drain(session_aggregate(event_stream(spark, d)), scratch_dir(spark, "checkpoint"))
    return sink.current()


def resumed(spark, d):
    """The log in six files, two to a batch; the run fails in its second batch and is started again."""
    ev = I.table(spark, d, "events")
    folder = scratch_dir(spark, "event-files")
    ev.repartitionByRange(6, "ts").write.parquet(folder)
    sink, ck = drained(spark, d)
    stream = lambda: session_aggregate(I.shape_events(read_stream(spark, folder, ev.schema, files_per_batch=2)))
    try:
        sink.drain(stream(), ck, lose_batch=1)
        raise AssertionError("the second batch should have failed")
    except StreamingQueryException:
        pass
    return sink, sink.drain(stream(), ck)


@query(with_("ev") + BATCH)
def stream_session_resumed(spark, d):
    """Several micro-batches, one of them lost after its rows were written and done again after a restart
    from the same checkpoint: the keyed table is as if nothing had happened."""
    return resumed(spark, d)[0].current()


@query(with_("ev") + "SELECT count(DISTINCT viewer_id) AS keys_seen, count(DISTINCT viewer_id) AS rows_after_compaction, true AS lags_ordered FROM ev")
def stream_freshness(spark, d):
    """Event-to-visible delays of a drained stream: every key was seen, no delay is negative."""
    sink, ck = drained(spark, d)
    sink.drain(session_aggregate(event_stream(spark, d)), ck)
    f = sink.freshness()
    keys = F.lit(sink.current().count())
    sink.compact()
    rows = sink.rows().agg(F.count(F.lit(1))).scalar()
    return f.select(keys.alias("keys_seen"), rows.alias("rows_after_compaction"),
                    ((F.col("p50_ms") >= 0) & (F.col("p50_ms") <= F.col("p95_ms"))).alias("lags_ordered"))


@query(with_("ev", "ti", "clock", "rb") + """SELECT *, (SELECT as_of FROM clock) AS ts FROM rb WHERE viewer_id IN
  (SELECT viewer_id FROM ev, clock WHERE event_ts > as_of - INTERVAL 6 HOUR)""")
def recompute_after_live_events(spark, d):
    ev = I.events(spark, d)
    now = P.data_clock(ev)
    live = trailing(ev, "event_ts", now, "6 HOURS")
    history = ev.where(F.col("event_ts") <= now - F.expr("INTERVAL 6 HOURS"))
    return recompute_after_live(history, live, I.titles(spark, d), now)


@query(with_("ev", "ti", "clock", "rb", "rbts") + """SELECT viewer_id, count(*) AS snapshots, max(ts) AS newest FROM (
  SELECT viewer_id, ts FROM rbts UNION ALL SELECT viewer_id, (SELECT as_of FROM clock) FROM rb WHERE viewer_id IN (SELECT viewer_id FROM ev, clock WHERE event_ts > as_of - INTERVAL 6 HOUR)) GROUP BY 1""")
def live_snapshot_upsert(spark, d):
    t = BucketedTable(spark, scratch_dir(spark, "recent"), ["viewer_id", "ts"], ["viewer_id"], 16)
    t.upsert(P.recent_behavior_ts(I.events(spark, d), I.titles(spark, d)))
    t.upsert(recompute_after_live_events(spark, d).select(t.read().columns))
    return t.read().groupBy("viewer_id").agg(F.count(F.lit(1)).alias("snapshots"), F.max("ts").alias("newest"))
