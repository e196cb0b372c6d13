"""Feature tables: daily snapshots and as-of-now builds, all as single DataFrame plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import (GENRES, IPS_CAP, MATURITY_RANK, PROPENSITY_FLOOR, RAIL_FEATURES,
                         RAIL_TYPES, RECENT_FEATURES, TITLE_FEATURES, TITLES_PER_RAIL,
                         VIEWER_FEATURES, VIEWER_RAIL_FEATURES)
from ..operators.asof import asof_join, latest_per_key
from ..operators.ranking import top_per_group
from ..operators.windows import (angle_parts, circular_concentration, circular_hour, day_end,
                                 day_range, days_present, ratio, rolling_days, trailing)

def _day() -> Column:
    return F.expr("INTERVAL 1 DAY")


def _spread(titles: DataFrame) -> DataFrame:
    """Titles for a join by shuffle. The catalogue grows with the log, and the size of its compressed
    file, by which Spark would send it through the driver, is a small part of its rows' size there."""
    return titles.hint("merge")


def data_clock(events: DataFrame, fallback: str | None = None) -> Column:
    """Newest event time as a scalar, else end of the ``fallback`` day."""
    top = events.agg(F.max("event_ts")).scalar()
    if fallback is None:
        return top
    return F.coalesce(top, F.lit(f"{fallback} 23:59:59").cast("timestamp"))


# ---------------------------------------------------------------- viewer
def viewer_daily_facts(events: DataFrame, titles: DataFrame) -> DataFrame:
    """Per (viewer, calendar day) sums over watched events; whole seconds, no float sums."""
    w = events.where(F.col("watch_seconds") > 0)
    sin, cos = angle_parts(F.hour("event_ts"))
    ws = F.col("watch_seconds")
    return (w.join(_spread(titles.select("title_id", "primary_genre")), "title_id", "left")
            .groupBy("viewer_id", F.to_date("event_ts").alias("day"))
            .agg(F.sum(ws).alias("seconds"), F.count("event_id").alias("plays"),
                 F.count_if(F.col("event_type") == "skip").alias("skips"),
                 F.count_if(F.col("event_type") == "complete").alias("completes"),
                 F.sum(sin).alias("sin"), F.sum(cos).alias("cos"),
                 *[F.sum(F.when(F.col("primary_genre") == g, ws).otherwise(0)).alias(f"s_{g}")
                   for g in GENRES]))


def viewer_features_ts(events: DataFrame, titles: DataFrame, stamp: str = "end") -> DataFrame:
    """Rolling 7/30-day viewer snapshots on every calendar day of the log.

    ``stamp="end"`` dates a snapshot at the end of the day it sums; ``"start"`` dates it at
    the day's start, which lets a same-day label read that day's own events.
    """
    d30 = lambda c: (f"{c}_30", c, "sum", 30)
    specs = [("seconds_7", "seconds", "sum", 7), ("plays_7", "plays", "sum", 7),
             ("skips_7", "skips", "sum", 7)]
    specs += [d30(c) for c in ["seconds", "plays", "completes", "sin", "cos"]]
    specs += [d30(f"s_{g}") for g in GENRES]
    r = rolling_days(viewer_daily_facts(events, titles), ["viewer_id"], "day", specs,
                     day_range(events, "event_ts"))
    day = F.col("day").cast("timestamp")
    c = F.col
    return r.select(
        "viewer_id", (day + _day() if stamp == "end" else day).alias("ts"),
        F.round(c("seconds_7") / 60.0, 2).alias("minutes_watched_7d"),
        c("plays_7").alias("plays_7d"),
        F.round(ratio(c("completes_30"), c("plays_30")), 4).alias("completion_rate_30d"),
        F.round(ratio(c("seconds_30"), c("plays_30") * 60), 2).alias("avg_watch_minutes_30d"),
        c("skips_7").alias("skips_7d"),
        F.round(circular_hour(c("sin_30"), c("cos_30"), c("plays_30")), 3).alias("typical_watch_hour"),
        F.round(circular_concentration(c("sin_30"), c("cos_30"), c("plays_30")), 4)
         .alias("hour_concentration"),
        *[F.round(ratio(c(f"s_{g}_30"), c("seconds_30")), 4).alias(f"genre_affinity_{g}")
          for g in GENRES]).select("viewer_id", "ts", *VIEWER_FEATURES)


def genre_affinity_through(events: DataFrame, titles: DataFrame, through: Column) -> DataFrame:
    """Share of watch time per genre up to a cut-off, for viewers with watch time by then.

    Time on titles of no listed genre is outside the total; a viewer with none of it in the
    listed genres gets the uniform share.
    """
    w = events.where((F.col("event_ts") <= through) & (F.col("watch_seconds") > 0))
    g = (w.join(_spread(titles.select("title_id", "primary_genre")), "title_id", "left")
         .groupBy("viewer_id").pivot("primary_genre", GENRES).agg(F.sum("watch_seconds"))
         .na.fill(0, GENRES))
    total = sum((F.col(x) for x in GENRES[1:]), F.col(GENRES[0]))
    share = lambda x: F.coalesce(F.col(x) / F.when(total != 0, total), F.lit(1.0 / len(GENRES)))
    return g.select("viewer_id", *[share(x).alias(f"taste_{x}") for x in GENRES])


# ---------------------------------------------------------------- title
def _title_columns(titles: DataFrame, as_of: Column, plays: Column, top: Column) -> list[Column]:
    rank = F.element_at(F.create_map(*[F.lit(v) for kv in MATURITY_RANK.items() for v in kv]),
                        F.col("maturity_rating"))
    return [
        F.round(plays / F.greatest(top, F.lit(1)), 4).alias("popularity_30d"),
        plays.cast("bigint").alias("plays_30d"),
        F.col("avg_rating"),
        F.datediff(as_of, F.make_date(F.col("release_year").cast("int"), F.lit(7), F.lit(1)))
         .cast("bigint").alias("days_since_release"),
        rank.cast("bigint").alias("maturity_rank"),
        F.col("is_simulcast").cast("bigint").alias("is_simulcast"),
        F.round(F.log1p("episode_count"), 4).alias("episodes_log"),
        *[(F.col("primary_genre") == g).cast("bigint").alias(f"genre_{g}") for g in GENRES],
    ]


def _played(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin("complete", "skip"))


def title_features(titles: DataFrame, events: DataFrame, as_of: Column) -> DataFrame:
    """Title features over the trailing 30 days at one instant; every title is kept."""
    plays = (trailing(_played(events), "event_ts", as_of, "30 DAYS")
             .groupBy("title_id").agg(F.count(F.lit(1)).alias("_p")))
    top = F.coalesce(plays.agg(F.max("_p")).scalar(), F.lit(0))
    j = titles.join(plays, "title_id", "left")
    cols = _title_columns(titles, as_of, F.coalesce(F.col("_p"), F.lit(0)), top)
    return j.select("title_id", *cols)


def title_features_ts(titles: DataFrame, events: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """End-of-day title snapshots; popularity is scaled by each day's own maximum.

    ``only`` names the few titles whose snapshots are wanted; the maximum is over all titles.
    """
    facts = (_played(events)
             .groupBy("title_id", F.date_sub(F.to_date(day_end(F.col("event_ts"))), 1).alias("day"))
             .agg(F.count(F.lit(1)).alias("p")))
    r = rolling_days(facts, ["title_id"], "day", [("plays", "p", "sum", 30)],
                     day_range(events, "event_ts"), entities=titles)
    top = r.groupBy("day").agg(F.max("plays").alias("_top"))
    ts = (F.col("day").cast("timestamp") + _day())
    if only is not None:
        few = F.broadcast(only.select("title_id").distinct())
        r, titles = r.join(few, "title_id", "left_semi"), titles.join(few, "title_id", "left_semi")
    # One row a day goes to every task, so the dense table stays dealt by title.
    j = r.join(F.broadcast(top), "day").join(_spread(titles), "title_id")
    return j.select("title_id", ts.alias("ts"),
                    *_title_columns(titles, ts, F.col("plays"), F.col("_top"))
                    ).select("title_id", "ts", *TITLE_FEATURES)


# ---------------------------------------------------------------- recent behaviour
def _recent_by_title(win: DataFrame, keys: list[str]) -> DataFrame:
    """First level: one row per (keys, title); makes the distinct count exact and splits hot keys."""
    watched = F.col("watch_seconds") > 0
    return (win.groupBy(*keys, "title_id")
            .agg(F.sum("watch_seconds").alias("_s"),
                 F.count_if(F.col("event_type") == "skip").alias("_k"),
                 F.max(F.when(watched, F.col("event_ts"))).alias("_t"),
                 F.max(F.when(watched, F.struct("event_ts", "event_id"))).alias("_o")))


def _recent_columns(agg: DataFrame, titles: DataFrame, keys: list[str]) -> DataFrame:
    g = titles.select(F.col("title_id").alias("_title"), "primary_genre")
    c = F.col
    return agg.join(_spread(g), "_title", "left").select(
        *keys,
        F.round(F.coalesce(c("_s"), F.lit(0)) / 60.0, 2).alias("minutes_watched_24h"),
        F.coalesce(c("_k"), F.lit(0)).cast("bigint").alias("skips_24h"),
        F.coalesce(c("_n"), F.lit(0)).cast("bigint").alias("active_titles_24h"),
        F.coalesce(c("primary_genre"), F.lit("none")).alias("last_primary_genre"),
        F.coalesce(F.unix_timestamp(c("_last")), F.lit(0)).cast("bigint").alias("last_event_epoch_s"))


def _recent_roll(by_title: DataFrame, keys: list[str]) -> DataFrame:
    return by_title.groupBy(*keys).agg(
        F.sum("_s").alias("_s"), F.sum("_k").alias("_k"), F.count("_t").alias("_n"),
        F.max("_t").alias("_last"),
        F.max(F.struct("_o", "title_id"))["title_id"].alias("_title0"),
        F.max("_o").alias("_any"))


def recent_behavior(events: DataFrame, titles: DataFrame, as_of: Column,
                    viewers: DataFrame | None = None) -> DataFrame:
    """Last-24-hour behaviour at one instant. Viewers without events in the window stay, as zeros."""
    wanted = (events if viewers is None else viewers).select("viewer_id").distinct()
    win = trailing(events, "event_ts", as_of, "24 HOURS")
    if viewers is not None:
        win = win.join(wanted, "viewer_id", "left_semi")
    facts = _recent_by_title(win, ["viewer_id"])
    rows = facts.unionByName(wanted, allowMissingColumns=True)
    agg = _recent_roll(rows, ["viewer_id"]).withColumn(
        "_title", F.when(F.col("_any").isNotNull(), F.col("_title0")))
    return _recent_columns(agg, titles, ["viewer_id"]).select("viewer_id", *RECENT_FEATURES)


def recent_behavior_ts(events: DataFrame, titles: DataFrame) -> DataFrame:
    """End-of-day snapshots of the last-24-hour features for every viewer and day of the log.

    Each event falls into exactly one snapshot, so all days come from one grouping; the
    viewer-by-day grid is unioned in before it instead of joined after.
    """
    keys = ["viewer_id", "ts"]
    facts = _recent_by_title(events.withColumn("ts", day_end(F.col("event_ts"))), keys)
    grid = (events.select("viewer_id").distinct()
            .select("viewer_id", F.explode(day_range(events, "event_ts")).alias("d"))
            .select("viewer_id", (F.col("d").cast("timestamp") + _day()).alias("ts"),
                    F.lit(True).alias("_grid")))
    rows = facts.unionByName(grid, allowMissingColumns=True)
    agg = (rows.groupBy(*keys).agg(
        F.sum("_s").alias("_s"), F.sum("_k").alias("_k"), F.count("_t").alias("_n"),
        F.max("_t").alias("_last"), F.max("_o").alias("_any"), F.max("_grid").alias("_grid"),
        F.max(F.struct("_o", "title_id"))["title_id"].alias("_title0"))
        .where("_grid")
        .withColumn("_title", F.when(F.col("_any").isNotNull(), F.col("_title0"))))
    return _recent_columns(agg, titles, keys).select("viewer_id", "ts", *RECENT_FEATURES)


# ---------------------------------------------------------------- rails
def position_propensity(impressions: DataFrame) -> DataFrame:
    """P(viewed | position) and its inverse weight; the weight uses the unrounded probability."""
    g = impressions.groupBy("rail_position").agg(
        F.count(F.lit(1)).alias("impressions"), F.count_if("was_viewport").alias("_v"))
    p = F.greatest(F.col("_v") / F.col("impressions"), F.lit(PROPENSITY_FLOOR))
    return g.select("rail_position", "impressions", F.round(p, 4).alias("p_view"),
                    F.round(F.least(1.0 / p, F.lit(IPS_CAP)), 4).alias("ips_weight"))


_AUDIENCE = {"rail_impressions_30d": None, "rail_clicks_30d": "engaged",
             "rail_watch_seconds_30d": "watch_seconds_from_rail",
             "rail_titles_played_30d": "titles_played"}


def _audience_aggs() -> list[Column]:
    return [(F.count(F.lit(1)) if c is None else F.sum(c)).alias(n) for n, c in _AUDIENCE.items()]


def rail_audience(impressions: DataFrame, as_of: Column) -> DataFrame:
    """Trailing 30-day audience totals per rail, bounded at both ends."""
    return (trailing(impressions, "rendered_ts", as_of, "30 DAYS")
            .groupBy("rail_id").agg(*_audience_aggs()))


def rail_title_map(titles: DataFrame, rails: DataFrame, as_of: Column,
                   per_rail: int = TITLES_PER_RAIL) -> DataFrame:
    """Titles each catalogue rail draws from: membership rule, then the most popular few.

    Every title lists the rails it qualifies for, so nothing pairs all titles with all rails.
    """
    genre_rails = (rails.where("rail_type = 'genre'")
                   .select(F.col("rail_genre").alias("_g"), "rail_id"))
    pool = titles.select("title_id", "intrinsic_popularity",
                         F.explode(F.array_distinct(F.array("primary_genre", "secondary_genre")))
                         .alias("_g"))
    by_genre = pool.join(genre_rails, "_g").drop("_g")
    rule = lambda rail, cond: F.when(cond, F.lit(rail))
    fixed = F.array_compact(F.array(
        F.lit("r_top10"), F.lit("r_trending"),
        rule("r_simulcast", F.col("is_simulcast") & (F.col("release_year") >= F.year(as_of) - 1)),
        rule("r_movies", F.col("episode_count") <= 2),
        rule("r_classics", F.col("release_year") <= 2012)))
    others = (titles.select("title_id", "intrinsic_popularity", F.explode(fixed).alias("rail_id"))
              .join(rails.select("rail_id"), "rail_id", "left_semi"))
    both = by_genre.unionByName(others)
    return (top_per_group(both, ["rail_id"], [F.col("intrinsic_popularity").desc(), F.col("title_id")],
                          per_rail, "rank_in_rail")
            .select("rail_id", "title_id", F.col("rank_in_rail").cast("int")))


def _content(members: DataFrame, by: list[str]) -> DataFrame:
    return members.groupBy(*by).agg(
        F.count("title_id").alias("rail_titles_available"),
        F.avg("popularity_30d").alias("rail_avg_popularity"),
        F.avg("avg_rating").alias("rail_avg_rating"),
        F.avg("days_since_release").alias("rail_content_age_days"),
        F.avg("is_simulcast").alias("rail_simulcast_share"))


def genre_index(genre: Column) -> Column:
    pos = F.array_position(F.array(*[F.lit(g) for g in GENRES]), F.coalesce(genre, F.lit("")))
    return (pos - 1).cast("bigint")


def _rail_columns() -> list[Column]:
    c = F.col
    zero = lambda x: F.coalesce(c(x), F.lit(0))
    clicks, shown = zero("rail_clicks_30d"), zero("rail_impressions_30d")
    types = F.array(*[F.lit(t) for t in RAIL_TYPES])
    return [
        F.round(ratio(clicks, shown), 5).alias("rail_ctr_30d"),
        shown.cast("bigint").alias("rail_impressions_30d"),
        clicks.cast("bigint").alias("rail_clicks_30d"),
        F.round(ratio(zero("rail_watch_seconds_30d"), clicks * 60), 3).alias("rail_avg_watch_minutes_30d"),
        zero("rail_titles_available").cast("bigint").alias("rail_titles_available"),
        *[F.round(F.coalesce(c(x), F.lit(0.0)), 4).alias(x)
          for x in ("rail_avg_popularity", "rail_avg_rating", "rail_content_age_days",
                    "rail_simulcast_share")],
        c("is_personalized").cast("bigint").alias("rail_is_personalized"),
        (F.array_position(types, c("rail_type")) - 1).cast("bigint").alias("rail_type_idx"),
        genre_index(c("rail_genre")).alias("rail_genre_idx"),
        c("editorial_rank").cast("bigint").alias("rail_editorial_rank"),
    ]


def rail_features(rails: DataFrame, members: DataFrame, title_features: DataFrame,
                  audience: DataFrame) -> DataFrame:
    """One row per rail: audience behaviour joined to the content it carries."""
    carried = title_features.join(F.broadcast(members.select("title_id").distinct()), "title_id", "left_semi")
    content = _content(members.join(carried, "title_id", "left"), ["rail_id"])
    return (rails.join(audience, "rail_id", "left").join(content, "rail_id", "left")
            .select("rail_id", *_rail_columns()).select("rail_id", *RAIL_FEATURES))


def rail_features_ts(impressions: DataFrame, rails: DataFrame, members: DataFrame,
                     title_ts: DataFrame) -> DataFrame:
    """End-of-day rail snapshots: audience from one rolling pass over the log, content as of
    the same day, the earliest content snapshot standing in before the first one."""
    facts = (impressions
             .groupBy("rail_id", F.date_sub(F.to_date(day_end(F.col("rendered_ts"))), 1).alias("day"))
             .agg(*_audience_aggs()))
    specs = [(n, n, "sum", 30) for n in _AUDIENCE]
    daily = rolling_days(facts, ["rail_id"], "day", specs, days_present(impressions, "rendered_ts"),
                         entities=rails)
    daily = daily.withColumn("ts", F.col("day").cast("timestamp") + _day()).drop("day")
    # The catalogue bounds the members; a stored title table looks small by its compressed columns.
    content = _content(title_ts.join(F.broadcast(members), "title_id"), ["rail_id", "ts"])
    first = content.agg(F.min("ts")).scalar()
    asked = daily.withColumn("_at", F.greatest("ts", first))
    j = asof_join(asked, content.withColumnRenamed("ts", "_cts"), ["rail_id"],
                  label_ts="_at", snapshot_ts="_cts", one_per_bucket=True)
    return (j.join(rails, "rail_id").select("rail_id", "ts", *_rail_columns())
            .select("rail_id", "ts", *RAIL_FEATURES))


def viewer_rail_daily_facts(impressions: DataFrame) -> DataFrame:
    e = F.col("engaged") == 1
    return (impressions.groupBy("viewer_id", "rail_id", F.to_date("rendered_ts").alias("day"))
            .agg(F.count(F.lit(1)).alias("impressions"), F.sum("engaged").alias("clicks"),
                 F.sum("rail_position").alias("positions"),
                 F.sum("watch_seconds_from_rail").alias("seconds"),
                 F.max(F.when(e, F.unix_timestamp("rendered_ts"))).alias("last_click")))


def viewer_rail_features_ts(impressions: DataFrame, dense: bool = True) -> DataFrame:
    """End-of-day (viewer, rail) snapshots; every feature is a nullable double.

    ``dense=True`` gives every pair every day of the log. ``dense=False`` keeps only days on
    which a value can change, which an as-of join reads identically at a fraction of the rows.
    """
    specs = [("i30", "impressions", "sum", 30), ("c30", "clicks", "sum", 30),
             ("c7", "clicks", "sum", 7), ("p30", "positions", "sum", 30),
             ("s30", "seconds", "sum", 30), ("lc", "last_click", "max", None)]
    r = rolling_days(viewer_rail_daily_facts(impressions), ["viewer_id", "rail_id"], "day", specs,
                     days_present(impressions, "rendered_ts"), change_points=not dense)
    c, dbl = F.col, lambda x: F.coalesce(x, F.lit(0)).cast("double")
    return r.select(
        "viewer_id", "rail_id", (c("day").cast("timestamp") + _day()).alias("ts"),
        dbl(c("i30")).alias("vr_impressions_30d"), dbl(c("c30")).alias("vr_clicks_30d"),
        F.round(ratio(c("c30"), c("i30")), 5).alias("vr_ctr_30d"),
        dbl(c("c7")).alias("vr_clicks_7d"),
        F.round(c("s30") / 60.0, 3).alias("vr_watch_minutes_30d"),
        F.round(ratio(c("p30"), c("i30")), 3).alias("vr_avg_position_30d"),
        dbl(c("lc")).alias("vr_last_click_epoch_s"),
    ).select("viewer_id", "rail_id", "ts", *VIEWER_RAIL_FEATURES)


def publish_current(snapshots: DataFrame, keys: list[str]) -> DataFrame:
    """Online copy: newest row per key without the time column."""
    return latest_per_key(snapshots, keys, "ts")
