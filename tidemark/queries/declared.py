"""Declared-feature queries."""

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import declared as D
from ..operators.asof import latest_per_key
from ..operators.orderstats import disc_rank, order_statistics
from ..plans import training as T
from ..session import scratch_dir
from ..sources import inputs as I
from ..sources.tables import read_table, write_table
from .base_sql import r, with_
from .registry import query

H, DAY = 3600, 86400
VIEWER, TITLE = ("viewer_id",), ("title_id",)
# The declared viewer and title features (operator, column, window, slide).
VIEWER_SPECS = [
    D.FeatureSpec("fv_watch_seconds_24h", "Sum", "watch_seconds", VIEWER, DAY, 6 * H),
    D.FeatureSpec("fv_events_24h", "Count", "event_id", VIEWER, DAY, 6 * H),
    D.FeatureSpec("fv_titles_24h", "ApproxCountDistinct", "title_id", VIEWER, DAY, 6 * H),
    D.FeatureSpec("fv_watch_seconds_7d", "Sum", "watch_seconds", VIEWER, 7 * DAY, DAY),
    D.FeatureSpec("fv_events_7d", "Count", "event_id", VIEWER, 7 * DAY, DAY),
    D.FeatureSpec("fv_avg_watch_seconds_7d", "Avg", "watch_seconds", VIEWER, 7 * DAY, DAY),
    D.FeatureSpec("fv_watch_seconds_30d", "Sum", "watch_seconds", VIEWER, 30 * DAY, DAY),
]
TITLE_SPECS = [
    D.FeatureSpec("fvt_events_7d", "Count", "event_id", TITLE, 7 * DAY, DAY),
    D.FeatureSpec("fvt_watch_seconds_7d", "Sum", "watch_seconds", TITLE, 7 * DAY, DAY),
    D.FeatureSpec("fvt_viewers_7d", "ApproxCountDistinct", "viewer_id", TITLE, 7 * DAY, DAY),
    D.FeatureSpec("fvt_events_30d", "Count", "event_id", TITLE, 30 * DAY, DAY),
    D.FeatureSpec("fvt_watch_seconds_30d", "Sum", "watch_seconds", TITLE, 30 * DAY, DAY),
]


def ends(dur, slide, start="ts"):
    """SQL for one row per (event, window end) of sliding windows."""
    return (f"SELECT *, make_timestamp(e*1000000) AS {start} FROM (SELECT *, unnest(range((floor(epoch(event_ts)/{slide})::BIGINT+1)*{slide}, "
            f"floor((epoch(event_ts)+{dur})/{slide})::BIGINT*{slide}+1, {slide})) AS e FROM ev)")


@query(with_("ev") + f"""SELECT viewer_id, ts, CAST(sum(watch_seconds) AS BIGINT) AS fv_watch_seconds_7d, count(event_id) AS fv_events_7d,
  {r('avg(watch_seconds)', 6)} AS fv_avg_watch_seconds_7d FROM ({ends(7 * DAY, DAY)}) GROUP BY 1,2""")
def declared_sliding(spark, d):
    t = D.windowed_features(I.events(spark, d), VIEWER_SPECS, "event_ts", "event_id")[(VIEWER, 7 * DAY, DAY)]
    return t.withColumn("fv_avg_watch_seconds_7d", F.round("fv_avg_watch_seconds_7d", 6))


@query(with_("ev") + f"SELECT viewer_id, ts, CAST(sum(watch_seconds) AS BIGINT) AS fv_watch_seconds_24h, count(*) AS fv_events_24h FROM ({ends(DAY, 6 * H)}) GROUP BY 1,2")
def declared_sliding_24h(spark, d):
    t = D.windowed_features(I.events(spark, d), VIEWER_SPECS, "event_ts", "event_id")[(VIEWER, DAY, 6 * H)]
    return t.drop("fv_titles_24h")


@query(with_("ev") + f"""SELECT 'viewer' AS entity, viewer_id AS id, ts, count(DISTINCT title_id) AS exact_count, true AS within_5_percent FROM ({ends(DAY, 6 * H)}) GROUP BY 2,3
UNION ALL SELECT 'title', title_id, ts, count(DISTINCT viewer_id), true FROM ({ends(7 * DAY, DAY)}) GROUP BY 2,3""")
def declared_approx_distinct(spark, d):
    """Sketched distinct counts beside exact ones, for every entity and window."""
    ev, out = I.events(spark, d), None
    for entity, col, name, specs, dur, step in (
            ("viewer", "title_id", "fv_titles_24h", VIEWER_SPECS, DAY, 6 * H),
            ("title", "viewer_id", "fvt_viewers_7d", TITLE_SPECS, 7 * DAY, DAY)):
        key = f"{entity}_id"
        t = D.windowed_features(ev, specs, "event_ts", "event_id")[((key,), dur, step)].select(key, "ts", name)
        exact = (ev.withColumn("_e", D._ends(F.unix_timestamp("event_ts"), dur, step))
                 .groupBy(key, F.timestamp_seconds("_e").alias("ts")).agg(F.count_distinct(col).alias("exact_count")))
        near = F.abs(F.col(name) - F.col("exact_count")) <= F.greatest(F.lit(1.0), 0.05 * F.col("exact_count"))
        row = t.join(exact, [key, "ts"], "full_outer").select(
            F.lit(entity).alias("entity"), F.col(key).alias("id"), "ts", "exact_count",
            F.coalesce(near, F.lit(False)).alias("within_5_percent"))
        out = row if out is None else out.unionByName(row)
    return out


@query(with_("ev") + f"""SELECT title_id, ts, count(*) AS fvt_events_7d, CAST(sum(watch_seconds) AS BIGINT) AS fvt_watch_seconds_7d FROM ({ends(7 * DAY, DAY)}) GROUP BY 1,2""")
def declared_title_features_7d(spark, d):
    t = D.windowed_features(I.events(spark, d), TITLE_SPECS, "event_ts", "event_id")[(TITLE, 7 * DAY, DAY)]
    return t.drop("fvt_viewers_7d")


@query(with_("ev") + f"""SELECT viewer_id, ts, CAST(sum(watch_seconds) AS BIGINT) AS fv_watch_seconds_30d FROM ({ends(30 * DAY, DAY)}) GROUP BY 1,2""")
def declared_viewer_30d(spark, d):
    return D.windowed_features(I.events(spark, d), VIEWER_SPECS, "event_ts", "event_id")[(VIEWER, 30 * DAY, DAY)]


@query(with_("ev") + f""", e1 AS (SELECT device, date_trunc('day', event_ts) + INTERVAL 1 DAY AS event_ts, count(*) AS n FROM ev GROUP BY 1,2)
SELECT device, ts, max(n) AS busiest_day, {r('avg(n)', 6)} AS mean_day FROM ({ends(7 * DAY, DAY).replace('FROM ev)', 'FROM e1)')}) GROUP BY 1,2""")
def declared_chained(spark, d):
    """A feature over a feature: weekly extremes of the daily counts, each known from its day's end."""
    day = D.windowed_features(I.events(spark, d), [D.FeatureSpec("n", "Count", "event_id", ("device",), DAY)],
                              "event_ts", "event_id")[(("device",), DAY, DAY)]
    specs = [D.FeatureSpec("busiest_day", "Max", "n", ("device",), 7 * DAY, DAY),
             D.FeatureSpec("mean_day", "Avg", "n", ("device",), 7 * DAY, DAY)]
    t = D.windowed_features(day, specs, "ts", "n")[(("device",), 7 * DAY, DAY)]
    return t.withColumn("mean_day", F.round("mean_day", 6))


@query(with_("ev") + f"SELECT title_id, ts, count(*) AS fvt_events_30d, CAST(sum(watch_seconds) AS BIGINT) AS fvt_watch_seconds_30d FROM ({ends(30 * DAY, DAY)}) GROUP BY 1,2")
def declared_title_features(spark, d):
    return D.windowed_features(I.events(spark, d), TITLE_SPECS, "event_ts", "event_id")[(TITLE, 30 * DAY, DAY)]


@query(with_("ev") + "SELECT device, date_trunc('day', event_ts) + INTERVAL 1 DAY AS ts, count(*) AS events_1d, CAST(sum(watch_seconds) AS BIGINT) AS seconds_1d FROM ev GROUP BY 1,2")
def declared_tumbling(spark, d):
    specs = [D.FeatureSpec("events_1d", "Count", "event_id", ("device",), DAY),
             D.FeatureSpec("seconds_1d", "Sum", "watch_seconds", ("device",), DAY)]
    return D.windowed_features(I.events(spark, d), specs, "event_ts", "event_id")[(("device",), DAY, DAY)]


@query(with_("ev") + f"""SELECT viewer_id, ts, min(watch_seconds) AS v_min, max(watch_seconds) AS v_max, arg_min(title_id, (event_ts, event_id)) AS v_first, arg_max(title_id, (event_ts, event_id)) AS v_last,
  {r('stddev_samp(watch_seconds)', 6)} AS v_sds, {r('stddev_pop(watch_seconds)', 6)} AS v_sdp, {r('var_samp(watch_seconds)', 6)} AS v_vs, {r('var_pop(watch_seconds)', 6)} AS v_vp,
  array_to_string(list(title_id ORDER BY event_ts, event_id)[1:3], ',') AS v_first3, array_to_string(list(title_id ORDER BY event_ts DESC, event_id DESC)[1:3], ',') AS v_last3
  FROM ({ends(3 * DAY, DAY)}) GROUP BY 1,2""")
def declared_operators(spark, d):
    one = lambda name, op, col: D.FeatureSpec(name, op, col, VIEWER, 3 * DAY, DAY)
    specs = [one("v_min", "Min", "watch_seconds"), one("v_max", "Max", "watch_seconds"), one("v_first", "First", "title_id"),
             one("v_last", "Last", "title_id"), one("v_sds", "StddevSamp", "watch_seconds"), one("v_sdp", "StddevPop", "watch_seconds"),
             one("v_vs", "VarSamp", "watch_seconds"), one("v_vp", "VarPop", "watch_seconds"),
             one("v_first3", "FirstN", "title_id"), one("v_last3", "LastN", "title_id")]
    t = D.windowed_features(I.events(spark, d), specs, "event_ts", "event_id")[(VIEWER, 3 * DAY, DAY)]
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return t.withColumns({**{c: F.round(c, 6) for c in ("v_sds", "v_sdp", "v_vs", "v_vp")},
                          "v_first3": text("v_first3"), "v_last3": text("v_last3")})


@query(with_("ev") + f""", x AS (SELECT viewer_id, ts, event_type, min((event_ts, event_id)) AS a, max((event_ts, event_id)) AS b FROM ({ends(7 * DAY, DAY)}) GROUP BY 1,2,3)
SELECT viewer_id, ts, array_to_string(list(event_type ORDER BY a)[1:3], ',') AS first_kinds, array_to_string(list(event_type ORDER BY b DESC)[1:3], ',') AS last_kinds FROM x GROUP BY 1,2""")
def declared_distinct_lists(spark, d):
    specs = [D.FeatureSpec("first_kinds", "FirstDistinct", "event_type", VIEWER, 7 * DAY, DAY),
             D.FeatureSpec("last_kinds", "LastDistinct", "event_type", VIEWER, 7 * DAY, DAY)]
    t = D.windowed_features(I.events(spark, d), specs, "event_ts", "event_id")[(VIEWER, 7 * DAY, DAY)]
    return t.withColumns({c: F.array_join(c, ",") for c in ("first_kinds", "last_kinds")})


@query(with_("ev") + f"""SELECT viewer_id, ts, count(*) AS events, quantile_disc(watch_seconds, 0.5) AS p50, quantile_disc(watch_seconds, 0.9) AS p90, true AS p50_near, true AS p90_near, true AS in_order FROM ({ends(7 * DAY, DAY)}) GROUP BY 1,2""")
def declared_approx_percentile(spark, d):
    """Percentiles of every window with as many rows as its sketch holds, which is exact up to there; those of
    larger windows by exact ranks. Every sketch's percentiles have exact ranks within the stated error."""
    ev = I.events(spark, d)
    specs = [D.FeatureSpec("p50", "ApproxPercentile", "watch_seconds", VIEWER, 7 * DAY, DAY, q=0.5),
             D.FeatureSpec("p90", "PercentileApprox", "watch_seconds", VIEWER, 7 * DAY, DAY, q=0.9),
             D.FeatureSpec("n", "Count", "watch_seconds", VIEWER, 7 * DAY, DAY)]
    t = D.windowed_features(ev, specs, "event_ts", "event_id")[(VIEWER, 7 * DAY, DAY)]
    every = (ev.withColumn("_e", D._ends(F.unix_timestamp("event_ts"), 7 * DAY, DAY))
             .select("viewer_id", F.timestamp_seconds("_e").alias("ts"), "watch_seconds"))
    n, x = F.count(F.lit(1)), F.col("watch_seconds")
    near = lambda p, q: ((F.count_if(x < F.col(p)) <= (q + D.RANK_ERROR) * n)
                         & (F.count_if(x <= F.col(p)) >= (q - D.RANK_ERROR) * n))
    keys = ["viewer_id", "ts"]
    large = every.join(t.where(F.col("n") > D.SKETCH).select(*keys), keys, "left_semi")
    exact = order_statistics(large, keys, "watch_seconds", {"x50": disc_rank(50), "x90": disc_rank(90)}).drop("n")
    sketched = every.join(t, keys, "left").groupBy(*keys).agg(
        n.alias("events"), F.max("p50").alias("p50"), F.max("p90").alias("p90"), F.coalesce(near("p50", 0.5), F.lit(False)).alias("p50_near"),
        F.coalesce(near("p90", 0.9), F.lit(False)).alias("p90_near"), F.bool_and(F.col("p50") <= F.col("p90")).alias("in_order"))
    return sketched.join(exact, keys, "left").select(
        *keys, "events", F.coalesce("x50", F.col("p50").cast("bigint")).alias("p50"),
        F.coalesce("x90", F.col("p90").cast("bigint")).alias("p90"), "p50_near", "p90_near", "in_order")


@query(with_("ev") + f"""SELECT viewer_id, event_ts, event_id, CAST(sum(watch_seconds) OVER w AS BIGINT) AS rolling_sum, count(*) OVER w AS rolling_count, {r('avg(watch_seconds) OVER w', 6)} AS rolling_avg
  FROM ev WINDOW w AS (PARTITION BY viewer_id ORDER BY epoch_us(event_ts) RANGE BETWEEN {3 * DAY * 1000000 - 1} PRECEDING AND CURRENT ROW)""")
def declared_rolling(spark, d):
    t = D.rolling_totals(I.events(spark, d), ["viewer_id"], "watch_seconds", "event_ts", "event_id", 3 * DAY)
    return t.withColumn("rolling_avg", F.round("rolling_avg", 6))


@query(with_("ev") + f"SELECT device, ts, CAST(sum(watch_seconds//60) AS BIGINT) AS whole_minutes, CAST(sum(watch_seconds//60) AS BIGINT)/count(*) AS minutes_per_event FROM ({ends(7 * DAY, DAY)}) GROUP BY 1,2")
def declared_transformed_and_chained(spark, d):
    """A row transformation before the aggregate, then a feature built from two features."""
    specs = [D.FeatureSpec("whole_minutes", "Sum", "watch_seconds div 60", ("device",), 7 * DAY, DAY),
             D.FeatureSpec("n", "Count", "event_id", ("device",), 7 * DAY, DAY)]
    t = D.windowed_features(I.events(spark, d), specs, "event_ts", "event_id")[(("device",), 7 * DAY, DAY)]
    return t.withColumn("minutes_per_event", F.col("whole_minutes") / F.col("n")).drop("n")


def _trail(entity, dur, slide, agg):
    return (f"(SELECT {agg} FROM ev e WHERE e.{entity}=l.{entity} AND epoch_us(e.event_ts) >= (floor(epoch(l.label_ts)/{slide})::BIGINT*{slide}-{dur})*1000000 "
            f"AND epoch_us(e.event_ts) < floor(epoch(l.label_ts)/{slide})::BIGINT*{slide}*1000000)")


def _attached_sql():
    """Every declared feature (distinct counts exact) over the newest complete window before a label."""
    agg = {"Sum": "CAST({} AS BIGINT)", "Count": "nullif({}, 0)", "Avg": "round({}, 6)", "ApproxCountDistinct": "nullif({}, 0)"}
    fn = {"Sum": "sum", "Count": "count", "Avg": "avg", "ApproxCountDistinct": "count"}
    cols = []
    for s in VIEWER_SPECS + TITLE_SPECS:
        what = f"{fn[s.operator]}({'DISTINCT ' if s.operator.startswith('Approx') else ''}{s.column})"
        cols.append(agg[s.operator].format(_trail(s.entity[0], s.duration, s.step, what)) + f" AS {s.name}")
    return "SELECT event_id, label_ts, played, " + ", ".join(cols) + " FROM l"


@query(with_("ev") + ", l AS (SELECT event_id, viewer_id, title_id, event_ts AS label_ts, played FROM ev WHERE event_type='impression') "
       + _attached_sql())
def declared_training_set(spark, d):
    """All twelve declared features at each label, distinct counts exact."""
    ev = I.events(spark, d)
    specs = [replace(s, operator=D.EXACT_DISTINCT) if s.operator == "ApproxCountDistinct" else s for s in VIEWER_SPECS + TITLE_SPECS]
    tables = D.windowed_features(ev, specs, "event_ts", "event_id")
    lab = T.title_labels(ev).select("event_id", "viewer_id", "title_id", "label_ts", "played")
    s = D.declared_training_set(lab, tables, "label_ts")
    return s.withColumn("fv_avg_watch_seconds_7d", F.round("fv_avg_watch_seconds_7d", 6)).drop("viewer_id", "title_id")


@query(with_("ev") + f"SELECT device, arg_max(n, ts) AS events_7d, max(ts) AS ts FROM (SELECT device, ts, count(*) AS n FROM ({ends(7 * DAY, DAY)}) GROUP BY 1,2) GROUP BY 1")
def declared_materialized_latest(spark, d):
    """Write tables that do not exist yet, skip the others, publish the newest row per key."""
    specs = [D.FeatureSpec("events_7d", "Count", "event_id", ("device",), 7 * DAY, DAY)]
    t = D.windowed_features(I.events(spark, d), specs, "event_ts", "event_id")[(("device",), 7 * DAY, DAY)]
    root = scratch_dir(spark, "declared")
    save = lambda n, df: write_table(df, f"{root}/{n}")
    created, _ = D.materialize_new({"device_7d": t}, [], save)
    D.materialize_new({"device_7d": t}, created, save)
    return latest_per_key(read_table(spark, f"{root}/device_7d"), ["device"], keep_ts=True)
