"""A log dealt into counted parts: the same rows, fewer shuffles, memory of a task that does not grow with it."""

import datetime as dt
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidemark.plans import canary as C, models as M, ranking as K
from tidemark.queries import models as Q
from tidemark.queries.training import rail_label_frame
from tidemark.sources import inputs as I

SESSION = {"session_policy_position": 4, "ranks_from_responses": 4, "spearman_overlap": 4}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def dealt(spark, monkeypatch):
    monkeypatch.setattr(I, "TASK_ROWS", 500)


@pytest.mark.parametrize("name", sorted(SESSION))
def test_what_is_ranked_in_a_session_is_not_shuffled_again(spark, sf, dealt, name):
    text = plan(E.queries()[name](spark, sf))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == SESSION[name]
    assert "BroadcastExchange" not in text


@pytest.mark.parametrize("name", ["session_ordinal", "ndcg_mrr", "canary_gate", "candidates_top_n", "reattached_label_side"])
def test_a_dealt_log_has_the_same_result(spark, sf, monkeypatch, name):
    one = rows(E.queries()[name](spark, sf))
    monkeypatch.setattr(I, "TASK_ROWS", 500)
    assert I.log_parts(spark, sf) > 8 and rows(E.queries()[name](spark, sf)) == one


def test_labels_are_not_dealt_by_their_few_positions(spark, sf):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        assert "SortMergeJoin [rail_position" not in plan(rail_label_frame(spark, sf))
    finally:
        spark.conf.set(threshold, old)


def test_catalogue_of_a_dealt_log_is_not_broadcast(spark, sf, dealt):
    assert "BroadcastExchange" not in plan(I.entitlements(spark, sf))


def test_sessions_of_one_busy_viewer_in_order(spark):
    base = dt.datetime(2024, 1, 1, 23, 50)
    data = [(1, i, base + dt.timedelta(seconds=(i * 37) % 1500 // 2)) for i in range(400)] + [(2, 9, base)]
    for parts in (0, 3):
        got = {(r.viewer_id, r.session_id): r.session_seq for r in
               K.session_ordinals(spark.createDataFrame(data, "viewer_id int, session_id int, rendered_ts timestamp"), parts).collect()}
        assert len(got) == 401
        for v, s, t in data:
            assert got[v, s] == sum(1 for w, x, u in data if w == v and u.date() == t.date() and (u, x) < (t, s))


def test_arms_in_one_row_rank_as_apart(spark):
    s = spark.createDataFrame([(1, "a", 3.0, None), (1, "b", 3.0, 2.0), (1, "c", None, 9.0), (2, "a", 1.0, 1.0)],
                              "r int, i string, x double, y double")
    apart = lambda c: C.response_ranks(s.select("r", "i", F.lit(None).cast("int").alias("given_rank"), F.col(c).alias("score")), "r", "i")
    want = apart("x").withColumnRenamed("rank", "a").join(apart("y").withColumnRenamed("rank", "b"), ["r", "i"])
    got = C.paired_ranks(s, "r", "i", F.col("x"), F.col("y"))
    assert rows(got, "r", "i", "a", "b") == rows(want, "r", "i", "a", "b")
    one = C.agreement(got, "r", "a", "b", least=2).first()
    assert one.pairs == 1 and one.spearman_mean == -1.0


def test_importance_carries_no_row_for_each_feature(spark, monkeypatch):
    df = spark.range(300).select((F.col("id") % 10).cast("double").alias("x"), F.lit(1.0).alias("same"), F.lit("tv").alias("device"),
                                 ((F.col("id") % 10) > 6).cast("int").alias("y"))
    model = M.ranker(["x", "same"], ["device"], "y", iterations=3, depth=2).fit(df)
    scored = []
    real = M.score_batch
    monkeypatch.setattr(M, "score_batch", lambda m, f, *a: scored.append(f) or real(m, f, *a))
    got = {r.feature: r.importance for r in M.permutation_importance(model, df, ["x", "same", "device"], "y").collect()}
    assert set(got) == {"x", "same", "device"} and got["same"] == 0 == got["device"] and got["x"] > 0.3
    # The rows once, and then only those whose value became another one.
    assert [f.count() for f in scored][0] == 300 and sum(f.count() for f in scored) <= 600


def test_title_rows_are_split_before_the_lookups(spark, sf, monkeypatch):
    given = []
    real = Q.T.quantile_split
    monkeypatch.setattr(Q.T, "quantile_split", lambda df, *a: given.append(df) or real(df, *a))
    monkeypatch.setattr(Q, "stored", lambda spark, d, name, build: build())
    f = Q.title_frame(spark, sf)
    assert len(given) == 1 and "Join" not in plan(given[0])
    late = real(f.drop("split"), "label_ts")
    assert rows(f, "event_id", "split") == rows(late, "event_id", "split")
