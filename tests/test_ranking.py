import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tidemark.plans import features as P, monitor as O, ranking as K
from tidemark.sources import inputs as I

NOW = dt.datetime(2024, 1, 20)


def small(spark):
    ev = spark.createDataFrame(
        [(1, 1, 10, NOW, "complete", 60), (2, 2, 10, NOW - dt.timedelta(days=7), "complete", 60),
         (3, 3, 11, NOW - dt.timedelta(days=6), "impression", 0)],
        "event_id long, viewer_id long, title_id long, event_ts timestamp, event_type string, watch_seconds long")
    ti = spark.createDataFrame([(10, True), (11, False)], "title_id long, is_simulcast boolean")
    vi = spark.createDataFrame([(1,), (2,), (3,)], "viewer_id long")
    return ev, ti, vi


def test_gates(spark):
    ev, ti, vi = small(spark)
    pairs = K.eligible_rails(ev, ti, vi, I.rails(spark), F.lit(NOW))
    has = lambda v: {r["rail_id"] for r in pairs.where(F.col("viewer_id") == v).collect()}
    assert {"r_continue", "r_because", "r_new_eps"} <= has(1)
    assert "r_continue" not in has(2) and "r_because" in has(2)      # idle for exactly seven days
    assert not {"r_continue", "r_because", "r_new_eps"} & has(3) and "r_action" in has(3)


def test_no_list_is_everyone_and_empty_list_is_no_one(spark):
    ev, ti, vi = small(spark)
    none = vi.where("false")
    assert K.eligible_rails(ev, ti, vi, I.rails(spark), F.lit(NOW), only=none).count() == 0
    assert K.eligible_rails(ev, ti, vi, I.rails(spark), F.lit(NOW)).select("viewer_id").distinct().count() == 3


def test_single_viewer_path_agrees_with_the_population(spark, sf):
    ev, ti, vi, rails = I.events(spark, sf), I.titles(spark, sf), I.viewers(spark, sf), I.rails(spark)
    now = P.data_clock(ev)
    everyone = K.eligible_rails(ev, ti, vi, rails, now)
    for v in (0, 7, 149):
        one = [r["rail_id"] for r in K.eligible_rails_for(ev, ti, rails, v, now).collect()]
        assert sorted(one) == [r[0] for r in rows(everyone.where(F.col("viewer_id") == v), "rail_id")]


def test_interval_join_edges(spark):
    d = lambda n: dt.datetime(2024, 1, n)
    u = spark.createDataFrame([("s", d(1).date(), d(1), 1.0), ("s", d(5).date(), d(5), 10.0), ("s", d(9).date(), d(9), 100.0)],
                              "sku_name string, usage_date date, usage_end_time timestamp, usage_quantity double")
    p = spark.createDataFrame([("s", 2.0, d(1), d(5)), ("s", 3.0, d(5), None)],
                              "sku_name string, price double, price_start_time timestamp, price_end_time timestamp")
    assert [r[1] for r in rows(O.priced_usage(u, p), "usage_date", "list_cost")] == [2.0, 30.0, 300.0]
