import math
import re

import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import metrics as M, orderstats
from tidemark.operators.orderstats import floor_rank, interpolated, nearest_rank, order_statistics, value_ranks
from tidemark.operators.retrieval import top_k_dot
from tidemark.plans import canary as C


def test_percentile_definitions(spark):
    df = spark.createDataFrame([("one", 5.0)] + [("two", x) for x in (1.0, 9.0)] + [("four", x) for x in (1.0, 2.0, 3.0, 4.0)],
                               "g string, v double")
    near = rows(order_statistics(df, ["g"], "v", {"p": nearest_rank(0.5)}), "g", "p")
    assert near == [("four", 2.0), ("one", 5.0), ("two", 1.0)]
    low = rows(order_statistics(df, ["g"], "v", {"p": floor_rank(0.5)}), "g", "p")
    assert low == [("four", 3.0), ("one", 5.0), ("two", 9.0)]
    mid = rows(interpolated(df, ["g"], "v", {"p": 0.5}), "g", "p")
    assert mid == [("four", 2.5), ("one", 5.0), ("two", 5.0)]


def test_ranks_with_a_value_holding_a_third_of_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 31 % 977).alias("v"))
    vals = np.array([r["v"] for r in df.collect()])
    for r in value_ranks(df, [], "v", ranges=8).collect():
        assert r["n_less"] == int((vals < r["v"]).sum()) and r["n"] == int((vals == r["v"]).sum())


def test_a_large_group_is_cut_once_and_not_ordered_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(orderstats, "GROUP_ROWS", 1000)
    df = spark.range(6000).select(F.when(F.col("id") < 5000, "big").when(F.col("id") < 5900, "small").alias("g"),
                                  (F.col("id") * 31 % 977).alias("v"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ranks = value_ranks(df, ["g"], "v", ranges=8, extra={"odd": F.sum(F.col("v") % 2)}, size="all")
        got = {(r["g"], r["v"]): (r["n"], r["n_less"], r["odd_less"], r["all"]) for r in ranks.collect()}
        plan = ranks._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for g in ("big", "small"):
        vals = np.array([r["v"] for r in df.where(F.col("g") == g).collect()])
        assert {v for h, v in got if h == g} == set(vals.tolist())
        for v in set(vals.tolist()):
            assert got[g, v] == ((vals == v).sum(), (vals < v).sum(), (vals[vals < v] % 2).sum(), len(vals))
    assert len({g for g, _ in got}) == 2
    # No join deals the values by their group alone, and both branches read one sketch.
    assert not re.search(r"SortMergeJoin(\(skew=true\))? \[g#\d+\]", plan)
    assert re.search(r"ReusedExchange \[.*_cuts#\d+.*\], BroadcastExchange|ReusedExchange \[.*_cuts", plan)


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.1, 0), (0.5, 1), (0.5, 0), (0.9, 1)], "s double, y int")
    assert M.auc(df, "s", "y").first()["auc"] == 0.875
    assert M.auc(df.where("y = 1"), "s", "y").first()["auc"] is None


def test_ndcg_and_mrr(spark):
    df = spark.createDataFrame([("a", "x", 0.9, 0), ("a", "y", 0.9, 1), ("a", "z", 0.1, 1), ("b", "x", 1.0, 0)],
                               "g string, i string, s double, r int")
    n = dict(rows(M.ndcg(df, ["g"], "s", "r", "i", 2), "g", "ndcg"))
    assert abs(n["a"] - (1 / math.log2(3)) / (1 + 1 / math.log2(3))) < 1e-12 and n["b"] is None
    assert rows(M.mrr(df, ["g"], "s", "r", "i"), "g", "mrr") == [("a", 0.5), ("b", 0.0)]


def test_one_ordering_gives_the_same_report(spark):
    df = spark.range(400).select((F.col("id") % 40).alias("g"), F.col("id").alias("i"),
                                 (F.xxhash64("id") % 5).alias("s"), (F.xxhash64("id", F.lit(1)) % 3 == 0).cast("int").alias("r"))
    got = {r.g: (r.ndcg3, r.ndcg5, r.mrr) for r in M.ranking_report(df, ["g"], "s", "r", "i", (3, 5)).collect()}
    for k, at in ((3, 0), (5, 1)):
        for g, v in rows(M.ndcg(df, ["g"], "s", "r", "i", k), "g", F.coalesce("ndcg", F.lit(-1.0)).alias("v")):
            assert abs((got[g][at] if got[g][at] is not None else -1.0) - v) < 1e-12
    for g, v in rows(M.mrr(df, ["g"], "s", "r", "i"), "g", "mrr"):
        assert abs(got[g][2] - v) < 1e-12


def test_gate_fails_on_undefined_correlation(spark):
    pairs = spark.createDataFrame([(1, "x", 1, 1)], "q int, i string, a int, b int")
    assert math.isnan(M.spearman_of_ranks(pairs, ["q"], "a", "b").first()["spearman"])
    s = spark.createDataFrame([(i, arm, 100.0, "ok") for i in range(4) for arm in ("old", "new")],
                              "request_id int, arm string, ms double, status string")
    g = C.gate(C.summarise(s), C.agreement(pairs, "q", "a", "b"), "old", "new")
    got = {r["check"]: (r["passed"], r["decision"]) for r in g.collect()}
    assert got["rank_agreement"] == (False, "ROLLBACK") and got["p95_latency"][0]


def test_gate_uses_successful_calls_only(spark):
    s = spark.createDataFrame([(1, "a", 5.0, "ok"), (2, "a", 999.0, "boom")], "request_id int, arm string, ms double, status string")
    r = C.summarise(s).first()
    assert r["p95_ms"] == 5.0 and r["errors"] == 1 and r["first_error"] == "boom"


def test_blocked_retrieval_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(40, 4)), rng.normal(size=(90, 4))
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "qid long, vector array<double>")
    it = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "iid long, vector array<double>")
    got = rows(top_k_dot(q.withColumnRenamed("qid", "q"), it.withColumnRenamed("iid", "i"), 7, "q", "i", rows_per_block=11),
               "q", "rank", "i")
    best = np.argsort(-(x @ y.T), axis=1, kind="stable")[:, :7]
    assert got == [(a, r + 1, int(best[a, r])) for a in range(40) for r in range(7)]


def test_top_k_dot_orders_ties_over_the_last_place(spark):
    """Equal scores on both sides of the last place: the smaller ids stay, and only kept scores are ordered whole."""
    import inspect
    items = spark.createDataFrame([(n, [float(n % 3)]) for n in range(40)], "i long, vector array<double>")
    asks = spark.createDataFrame([(1, [1.0]), (2, [-1.0])], "q long, vector array<double>")
    got = rows(top_k_dot(asks, items, 16, "q", "i", rows_per_block=17), "q", "rank", "i")
    order = lambda sign: sorted(range(40), key=lambda n: (-sign * (n % 3), n))[:16]
    assert got == [(q, r + 1, n) for q, sign in ((1, 1), (2, -1)) for r, n in enumerate(order(sign))]
    assert "argsort" not in inspect.getsource(top_k_dot)
