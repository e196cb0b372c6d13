"""Feature-table queries."""

from pyspark.sql import functions as F

from ..operators.asof import snapshot_in_force
from ..plans import features as P
from ..sources import inputs as I
from .base_sql import GENRES, r, with_
from .registry import query


@query(with_("ev", more="clock AS (SELECT max(event_ts) AS as_of FROM ev)")
       + "SELECT as_of, count(*) AS events FROM ev, clock GROUP BY 1")
def data_clock(spark, d):
    ev = I.events(spark, d)
    return ev.agg(F.max("event_ts").alias("as_of"), F.count(F.lit(1)).alias("events"))


@query(with_("ev", "ti") + """SELECT viewer_id, event_ts::DATE AS day, CAST(sum(watch_seconds) AS BIGINT) AS seconds,
  count(*) AS plays, count(*) FILTER (event_type='skip') AS skips, count(*) FILTER (event_type='complete') AS completes,
  """ + ", ".join(f"CAST(coalesce(sum(watch_seconds) FILTER (primary_genre='{g}'),0) AS BIGINT) AS s_{g}" for g in GENRES)
       + " FROM ev LEFT JOIN ti USING (title_id) WHERE watch_seconds>0 GROUP BY 1,2")
def viewer_daily_facts(spark, d):
    return P.viewer_daily_facts(I.events(spark, d), I.titles(spark, d)).drop("sin", "cos")


@query(with_("ev", "ti", "vf") + "SELECT * FROM vf")
def viewer_features_ts(spark, d):
    return P.viewer_features_ts(I.events(spark, d), I.titles(spark, d))


@query(with_("ev", "ti", "vf") + "SELECT * REPLACE (ts - INTERVAL 1 DAY AS ts) FROM vf")
def viewer_features_day_start(spark, d):
    return P.viewer_features_ts(I.events(spark, d), I.titles(spark, d), stamp="start")


@query(with_("ev", "ti", "vf") + "SELECT * EXCLUDE (ts) FROM vf WHERE ts=(SELECT max(ts) FROM vf)")
def viewer_features_current(spark, d):
    return P.publish_current(P.viewer_features_ts(I.events(spark, d), I.titles(spark, d)), ["viewer_id"])


@query(with_("ev", "ti", "clock", more="""w AS (SELECT viewer_id, primary_genre AS g, CAST(watch_seconds AS DOUBLE) AS s
  FROM ev LEFT JOIN ti USING (title_id), clock WHERE watch_seconds>0 AND event_ts <= as_of - INTERVAL 10 DAY)""")
       + "SELECT viewer_id, " + ", ".join(
           f"coalesce(coalesce(sum(s) FILTER (g='{g}'),0)/nullif(sum(s) FILTER (g IS NOT NULL),0),0.125) AS taste_{g}" for g in GENRES)
       + " FROM w GROUP BY 1")
def genre_affinity_to_cutoff(spark, d):
    ev = I.events(spark, d)
    cut = P.data_clock(ev) - F.expr("INTERVAL 10 DAYS")
    return P.genre_affinity_through(ev, I.titles(spark, d), cut)


@query(with_("ev", "ti", "clock", "tf") + "SELECT * FROM tf")
def title_features(spark, d):
    ev = I.events(spark, d)
    return P.title_features(I.titles(spark, d), ev, P.data_clock(ev))


@query(with_("ev", "ti", "tfts") + "SELECT * FROM tfts")
def title_features_ts(spark, d):
    return P.title_features_ts(I.titles(spark, d), I.events(spark, d))


@query(with_("ev", "ti", "tfts") + """SELECT * EXCLUDE (ts) FROM tfts WHERE ts=(SELECT max(ts) FROM tfts
  WHERE ts <= TIMESTAMP '2024-01-15 12:00:00')""")
def title_features_in_force(spark, d):
    ts = P.title_features_ts(I.titles(spark, d), I.events(spark, d))
    return snapshot_in_force(ts, ["title_id"], F.lit("2024-01-15 12:00:00").cast("timestamp"))


@query(with_("ev", "ti", "tfts") + "SELECT * EXCLUDE (ts) FROM tfts WHERE ts=(SELECT min(ts) FROM tfts)")
def title_features_before_first(spark, d):
    ts = P.title_features_ts(I.titles(spark, d), I.events(spark, d))
    return snapshot_in_force(ts, ["title_id"], F.lit("2023-06-01 00:00:00").cast("timestamp"))


@query(with_("ev", "ti", "clock", "rb") + "SELECT * FROM rb")
def recent_behavior(spark, d):
    ev = I.events(spark, d)
    return P.recent_behavior(ev, I.titles(spark, d), P.data_clock(ev))


@query(with_("ev", "ti", "rbts") + "SELECT * FROM rbts")
def recent_behavior_ts(spark, d):
    return P.recent_behavior_ts(I.events(spark, d), I.titles(spark, d))


@query(with_("imp", "prop") + "SELECT * FROM prop")
def position_propensity(spark, d):
    return P.position_propensity(I.impressions(spark, d))


@query(with_("imp", "iclock", "aud") + "SELECT * FROM aud")
def rail_audience(spark, d):
    imp = I.impressions(spark, d)
    return P.rail_audience(imp, imp.agg(F.max("rendered_ts")).scalar())


@query(with_("ev", "ti", "rails", "clock", "rtm") + "SELECT * FROM rtm")
def rail_title_map(spark, d):
    return P.rail_title_map(I.titles(spark, d), I.rails(spark), P.data_clock(I.events(spark, d)))


@query(with_("ev", "ti", "rails", "imp", "clock", "iclock", "aud", "rtm", "tf", "rf") + "SELECT * FROM rf")
def rail_features(spark, d):
    ev, ti, imp = I.events(spark, d), I.titles(spark, d), I.impressions(spark, d)
    now, rails = P.data_clock(ev), I.rails(spark)
    return P.rail_features(rails, P.rail_title_map(ti, rails, now), P.title_features(ti, ev, now),
                           P.rail_audience(imp, imp.agg(F.max("rendered_ts")).scalar()))


def rail_snapshots(spark, d):
    ev, ti = I.events(spark, d), I.titles(spark, d)
    rails = I.rails(spark)
    return P.rail_features_ts(I.impressions(spark, d), rails,
                              P.rail_title_map(ti, rails, P.data_clock(ev)),
                              P.title_features_ts(ti, ev))


@query(with_("ev", "ti", "rails", "imp", "clock", "rtm", "tfts", "rfts") + "SELECT * FROM rfts")
def rail_features_ts(spark, d):
    return rail_snapshots(spark, d)


@query(with_("imp", "vrf") + "SELECT * FROM vrf")
def viewer_rail_features_ts(spark, d):
    return P.viewer_rail_features_ts(I.impressions(spark, d))


@query(with_("imp", "vrf") + """SELECT * FROM vrf v WHERE ts=(SELECT min(ts) FROM vrf) OR EXISTS (SELECT 1 FROM xd WHERE xd.viewer_id=v.viewer_id
  AND xd.rail_id=v.rail_id AND (v.ts::DATE - 1 - xd.day) IN (0,7,30))""")
def viewer_rail_change_points(spark, d):
    return P.viewer_rail_features_ts(I.impressions(spark, d), dense=False)


@query(with_("imp") + f"""SELECT rail_id, {r('avg(engaged)', 6)} AS ctr, {r('avg(rail_position)', 6)} AS mean_position,
  count(*) AS impressions FROM imp GROUP BY 1""")
def logged_ctr_by_rail(spark, d):
    return (I.impressions(spark, d).groupBy("rail_id")
            .agg(F.round(F.avg("engaged"), 6).alias("ctr"),
                 F.round(F.avg("rail_position"), 6).alias("mean_position"),
                 F.count(F.lit(1)).alias("impressions")))


@query(with_("imp", "vrf") + f"""SELECT viewer_id, rail_id, count(DISTINCT vr_ctr_30d) AS distinct_values, min(vr_ctr_30d) AS lowest,
  max(vr_ctr_30d) AS highest FROM vrf GROUP BY 1,2 HAVING count(DISTINCT vr_ctr_30d) > 3
  ORDER BY distinct_values DESC, viewer_id, rail_id LIMIT 8""")
def snapshot_movement(spark, d):
    v = P.viewer_rail_features_ts(I.impressions(spark, d))
    return (v.groupBy("viewer_id", "rail_id", "vr_ctr_30d").agg(F.lit(1).alias("one"))
            .groupBy("viewer_id", "rail_id")
            .agg(F.count(F.lit(1)).alias("distinct_values"), F.min("vr_ctr_30d").alias("lowest"),
                 F.max("vr_ctr_30d").alias("highest"))
            .where("distinct_values > 3")
            .orderBy(F.col("distinct_values").desc(), "viewer_id", "rail_id").limit(8))


@query(with_("imp", "vrf") + """SELECT viewer_id, rail_id, arg_max(vr_clicks_30d, ts) AS vr_clicks_30d,
  arg_max(vr_ctr_30d, ts) AS vr_ctr_30d, count(*) AS snapshots FROM vrf GROUP BY 1,2""")
def online_compaction(spark, d):
    v = P.viewer_rail_features_ts(I.impressions(spark, d))
    return (v.groupBy("viewer_id", "rail_id")
            .agg(F.max_by("vr_clicks_30d", "ts").alias("vr_clicks_30d"),
                 F.max_by("vr_ctr_30d", "ts").alias("vr_ctr_30d"),
                 F.count(F.lit(1)).alias("snapshots")))
