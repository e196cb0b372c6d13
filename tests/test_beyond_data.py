"""Cases that the given tables do not show, on hand-built frames."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark import session
from tidemark.operators import declared as D
from tidemark.operators.retrieval import top_k_dot
from tidemark.plans import models as M, monitor as O, training as T
from tidemark.sources import changes as C
from tidemark.streaming.sessions import KeyedSink

DAY = 86400


def test_variance_of_large_values_with_a_small_spread(spark):
    base = dt.datetime(2024, 1, 1)
    values = [1e9 + x for x in (0.0, 1.0, 2.0, 3.0, 5.0, 8.0)]
    ev = spark.createDataFrame([(1, i, base + dt.timedelta(hours=10 * i), v) for i, v in enumerate(values)],
                               "k int, id int, ts timestamp, v double")
    spec = [D.FeatureSpec("s", "VarSamp", "v", ("k",), 7 * DAY, DAY), D.FeatureSpec("p", "StddevPop", "v", ("k",), 7 * DAY, DAY)]
    t = D.windowed_features(ev, spec, "ts", "id")[(("k",), 7 * DAY, DAY)]
    full = t.orderBy(F.desc(F.col("ts") <= base + dt.timedelta(days=7)), F.desc("ts")).first()
    assert full["s"] == pytest.approx(np.var(values, ddof=1), rel=1e-6)
    assert full["p"] == pytest.approx(np.std(values), rel=1e-6)


def test_a_gap_in_batch_numbers_hides_no_decrease(spark):
    b = spark.createDataFrame([(1, 10), (2, 20), (5, 15), (12_345, 14), (20_000, 30)], "batch long, t long")
    assert O.batch_order(b, "batch", "t").first()[:2] == (5, 2)


def test_spike_recovery_reads_successes_only(spark):
    t0 = dt.datetime(2024, 1, 1)
    load = [(t0 + dt.timedelta(seconds=s), 100.0 if s else 500.0, 200) for s in range(4)]
    load += [(t0 + dt.timedelta(seconds=s, milliseconds=1), 9000.0, 429) for s in range(4)]
    base = [(t0, 90.0, 200), (t0, 1.0, 500)]
    f = lambda r: spark.createDataFrame(r, "started timestamp, ms double, status int")
    got = O.spike_recovery(f(load), f(base), "started", "ms", F.col("status") == 200).first()
    assert got["first_step_p95_ms"] == 500.0 and got["baseline_p95_ms"] == 90.0 and got["recovered_at_step"] == 1


def test_retrieval_by_text_ids(spark):
    q = spark.createDataFrame([("u1", [1.0, 0.0]), ("u2", [0.0, 1.0])], "u string, vector array<double>")
    i = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], "i string, vector array<double>")
    assert rows(top_k_dot(q, i, 1, "u", "i"), "u", "i") == [("u1", "a"), ("u2", "b")]


def test_unseen_categories_share_the_last_index(spark):
    fit = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    df = spark.createDataFrame([("a",), ("b",), ("new",), (None,)], "c string")
    got = T.encode(df.select("c"), {"c": "i"}, fit)
    assert {r.c: r.i for r in got.collect()} == {"a": 0, "b": 1, "new": 2, None: 2}


def test_many_changed_viewers_stay_incremental(spark):
    ch = spark.range(150_000).select(F.lit("t").alias("table_name"), F.col("id").alias("viewer_id"))
    s = F.lit("s")
    assert tuple(C.rescoring_decision(ch, s, s).first()) == ("incremental", "changed viewers only", 150_000)


def test_importance_deals_over_the_whole_frame(spark):
    df = spark.range(400).select((F.col("id") % 10).cast("double").alias("x"), F.rand(3).alias("noise"),
                                 F.lit("tv").alias("device"), ((F.col("id") % 10) > 6).cast("int").alias("y"))
    model = M.ranker(["x", "noise"], ["device"], "y", iterations=3, depth=2).fit(df)
    got = {r.feature: r.importance for r in M.permutation_importance(model, df, ["x", "noise", "device"], "y").collect()}
    assert got["x"] > 0.3 and abs(got["noise"]) < 0.1 and abs(got["device"]) < 1e-9


def test_a_sink_is_compacted_to_one_row_per_key(spark, tmp_path):
    root = f"file://{tmp_path}/sink"
    put = lambda d, g, b: spark.createDataFrame(d, "k int, v int").write.parquet(f"{root}/rows/generation={g}/batch={b}")
    put([(1, 1), (2, 2)], 0, 0)
    put([(2, 20), (3, 3)], 0, 1)
    sink = KeyedSink(spark, root, ["k"])
    before = rows(sink.current(), "k", "v")
    sink.compact()
    assert sink.rows().count() == 3 and rows(sink.current(), "k", "v") == before == [(1, 1), (2, 20), (3, 3)]
    put([(1, 10)], 0, 2)
    assert rows(sink.current(), "k", "v") == [(1, 10), (2, 20), (3, 3)]


def test_intermediates_are_released(spark):
    path = session.scratch_dir(spark, "gone")
    spark.range(3).write.parquet(path)
    kept = list(session._made)
    session._made[:] = [path]
    assert session.release(spark) == 1
    session._made[:] = [p for p in kept if p != path]
    with pytest.raises(Exception):
        spark.read.parquet(path)


def test_rolling_totals_as_by_brute_force(spark):
    rng = np.random.default_rng(5)
    base = dt.datetime(2024, 1, 1)
    data = [(int(k), i, base + dt.timedelta(minutes=int(m)), None if m % 17 == 0 else int(v)) for i, (k, m, v) in
            enumerate(zip(rng.integers(0, 3, 300), rng.integers(0, 4000, 300), rng.integers(0, 50, 300)))]
    data += [(9, 1000, base, 5), (9, 1001, base + dt.timedelta(hours=3), 7), (9, 1002, base + dt.timedelta(days=40), 1)]
    ev = spark.createDataFrame(data, "k int, id int, ts timestamp, v bigint")
    got = {r.id: r for r in D.rolling_totals(ev, ["k"], "v", "ts", "id", 3 * 3600).collect()}
    for k, i, t, _ in data:
        mine = [v for k2, _, t2, v in data if k2 == k and t - dt.timedelta(hours=3) < t2 <= t and v is not None]
        assert (got[i].rolling_sum or 0, got[i].rolling_count) == (sum(mine), len(mine))


def test_a_dictionary_of_a_million_values_is_dense_and_in_order(spark):
    n = 1_000_000
    df = spark.range(n).select(F.concat(F.lit("k"), F.lpad((F.col("id") * 7919 % n).cast("string"), 7, "0")).alias("c"))
    d = T.dictionary(df.union(df.limit(1000)).union(spark.createDataFrame([(None,)], "c string")), "c")
    off = d.where(F.col("position") != F.substring("value", 2, 7).cast("long"))
    assert d.count() == n and off.count() == 0
    out = T.encode(df.limit(5).union(spark.createDataFrame([("new",), (None,)], "c string")), {"c": "i"}, df)
    assert sorted(r.i for r in out.where("c is null or c = 'new'").collect()) == [n, n] and out.count() == 7
    assert {r.i for r in T.encode(df.limit(3), {"c": "i"}, df.limit(0)).collect()} == {0}
