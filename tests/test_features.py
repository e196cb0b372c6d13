import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.asof import asof_join
from tidemark.operators.windows import day_end, trailing
from tidemark.plans import features as P
from tidemark.sources import inputs as I

D = dt.datetime


def events(spark, data):
    return spark.createDataFrame(data, "event_id long, viewer_id long, title_id long, event_ts timestamp, "
                                       "event_type string, watch_seconds long")


def titles(spark):
    return spark.createDataFrame([(1, "drama"), (2, "action")], "title_id long, primary_genre string")


def test_trailing_is_open_below_and_closed_above(spark):
    at = D(2024, 1, 5, 12)
    ev = events(spark, [(1, 1, 1, at - dt.timedelta(hours=24), "complete", 60), (2, 1, 1, at, "complete", 60)])
    assert rows(trailing(ev, "event_ts", F.lit(at), "24 HOURS"), "event_id") == [(2,)]


def test_midnight_belongs_to_the_day_that_ended(spark):
    df = spark.createDataFrame([(D(2024, 1, 2),), (D(2024, 1, 2, 0, 0, 1),)], "t timestamp")
    assert rows(df.select(day_end(F.col("t")))) == [(D(2024, 1, 2),), (D(2024, 1, 3),)]


def test_recent_snapshot_sees_only_its_own_day(spark):
    ev = events(spark, [(1, 1, 1, D(2024, 1, 1, 10), "complete", 600), (2, 1, 2, D(2024, 1, 3, 10), "skip", 60)])
    got = rows(P.recent_behavior_ts(ev, titles(spark)), "ts", "minutes_watched_24h", "last_primary_genre")
    assert got == [(D(2024, 1, 2), 10.0, "drama"), (D(2024, 1, 3), 0.0, "none"), (D(2024, 1, 4), 1.0, "action")]


def test_circular_hour_and_stamp(spark):
    ev = events(spark, [(1, 1, 1, D(2024, 1, 1, 23), "complete", 600), (2, 1, 1, D(2024, 1, 1, 1), "complete", 600),
                        (3, 2, 1, D(2024, 1, 1, 5), "impression", 0)])
    r = P.viewer_features_ts(ev, titles(spark)).collect()
    assert len(r) == 1 and r[0]["viewer_id"] == 1
    assert r[0]["typical_watch_hour"] == 0.0 and 0.9 < r[0]["hour_concentration"] < 1
    assert r[0]["ts"] == D(2024, 1, 2)
    assert P.viewer_features_ts(ev, titles(spark), stamp="start").first()["ts"] == D(2024, 1, 1)


def test_propensity_clips(spark):
    imp = spark.createDataFrame([(1, True), (1, True), (2, False)], "rail_position long, was_viewport boolean")
    got = rows(P.position_propensity(imp))
    assert got == [(1, 2, 1.0, 1.0), (2, 1, 0.02, 10.0)]


def test_change_points_read_like_the_dense_grid(spark, sf):
    imp = I.impressions(spark, sf)
    lab = imp.select("session_id", "viewer_id", "rail_id", "rail_position", F.col("rendered_ts").alias("label_ts"))
    read = lambda dense: asof_join(lab, P.viewer_rail_features_ts(imp, dense), ["viewer_id", "rail_id"],
                                   label_ts="label_ts", one_per_bucket=True)
    a, b = read(True).persist(), read(False).persist()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_daily_title_snapshots_equal_the_single_instant_build(spark, sf):
    ev, ti = I.events(spark, sf), I.titles(spark, sf)
    at = D(2024, 1, 12)
    one = P.title_features(ti, ev, F.lit(at))
    day = P.title_features_ts(ti, ev).where(F.col("ts") == F.lit(at)).drop("ts")
    assert one.select(day.columns).exceptAll(day).count() == 0


def test_the_catalogue_is_not_sent_through_the_driver(spark, sf):
    """A million titles are a few MB as a file and a few hundred as rows, so they meet the log by shuffle."""
    ev, ti = I.events(spark, sf), I.titles(spark, sf)
    clock = P.data_clock(ev)
    for df, sent in ((P.viewer_features_ts(ev, ti), 0), (P.recent_behavior_ts(ev, ti), 0), (P.recent_behavior(ev, ti, clock), 0),
                     (P.genre_affinity_through(ev, ti, clock), 0), (P.title_features_ts(ti, ev), 1)):
        joins = [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Join [" in x]
        assert sum("BroadcastHashJoin" in x for x in joins) == sent and sum("SortMergeJoin" in x for x in joins) == 1


def test_rail_members_go_to_the_stored_titles(spark, sf):
    """The members of sixteen rails are few; the titles' snapshots must not be what is sent to every task."""
    from tidemark.session import materialize
    ev, ti, imp, rails = I.events(spark, sf), I.titles(spark, sf), I.impressions(spark, sf), I.rails(spark)
    stored = materialize(P.title_features_ts(ti, ev), "title-features")
    members = P.rail_title_map(ti, rails, P.data_clock(ev))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = P.rail_features_ts(imp, rails, members, stored)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    joins = [x for x in plan.split("\n") if "Join [title_id" in x]
    assert joins and all("BroadcastHashJoin" in x and "BuildRight" in x for x in joins)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dense_days_are_dealt_out_behind_the_windows(spark, sf):
    """Only days on which a window changes are shuffled and ordered; the grid comes last."""
    plan = _plan(P.viewer_rail_features_ts(I.impressions(spark, sf))).split("(1) Scan")[0]
    assert "Generate explode(sequence(" in plan and plan.index("Generate explode(sequence(") < plan.index("Window")
    below = plan[plan.rindex("Window"):]
    assert below.index("Generate") < below.index("Exchange hashpartitioning(viewer_id")


def test_rolling_days_with_gaps_unknown_keys_and_idle_entities(spark):
    from datetime import date, timedelta
    from tidemark.operators.windows import rolling_days
    day = lambda n: date(2024, 1, 1) + timedelta(n)
    facts = [("a", -1, 5), ("a", 2, 7), ("a", 9, 1), ("b", 0, 2), ("x", 3, 100)]
    present = [0, 1, 2, 5, 9, 10]
    df = spark.createDataFrame([(k, day(n), v) for k, n, v in facts], "k string, day date, v bigint")
    days = F.array(*[F.lit(day(n)) for n in present])
    own = spark.createDataFrame([("a",), ("b",), ("idle",)], "k string")
    specs = [("s3", "v", "sum", 3), ("all", "v", "max", None)]
    want = lambda keys: sorted((k, day(d), sum(v for g, n, v in facts if g == k and d - 3 < n <= d),
                                max([v for g, n, v in facts if g == k and n <= d], default=None))
                               for k in keys for d in present)
    got = lambda e: sorted(tuple(r) for r in rolling_days(df, ["k"], "day", specs, days, entities=e).select("k", "day", "s3", "all").collect())
    key = lambda rows: sorted(map(str, rows))
    assert key(got(own)) == key(want(["a", "b", "idle"])) and key(got(None)) == key(want(["a", "b", "x"]))


def test_impressions_meet_the_catalogue_by_shuffle(spark, sf):
    """A million titles must not be collected by the driver to be sent to every task."""
    plan = _plan(I.impressions(spark, sf))
    assert "l_partkey" in plan and not [x for x in plan.split("\n") if "BroadcastHashJoin" in x and "l_partkey" in x]


def test_snapshots_of_few_titles_keep_the_maximum_over_all(spark, sf):
    ev, ti = I.events(spark, sf), I.titles(spark, sf)
    few = ti.where("title_id % 7 = 3").select("title_id")
    whole = P.title_features_ts(ti, ev).join(few, "title_id", "left_semi").persist()
    some = P.title_features_ts(ti, ev, only=few).persist()
    assert some.count() == whole.count() > 0 and some.exceptAll(whole).count() == 0
