"""Eligibility, candidate, ranking and homepage queries."""

from pyspark.sql import Window, functions as F

from ..constants import RAIL_TYPES
from ..functions import request as R
from ..operators.ranking import ranked
from ..operators.retrieval import top_k_dot
from ..operators.windows import angle_parts, circular_concentration, circular_hour, ratio, trailing
from ..plans import features as P, ranking as K
from ..sources import inputs as I
from .base_sql import r, unit, with_
from .registry import query
from .training import FIT, HOUR

STATE = f"""watched AS (SELECT viewer_id, title_id, max(event_ts) AS last_ts FROM ev WHERE watch_seconds>0 GROUP BY 1,2),
state AS (SELECT v.viewer_id, coalesce(bool_or(last_ts > as_of - INTERVAL 7 DAY), false) AS has_inprogress,
    count(w.title_id)>0 AS has_history, coalesce(bool_or(is_simulcast), false) AS has_simulcast_history,
    {unit("'watchlist|'||v.viewer_id")} < 0.62 AS has_watchlist
  FROM vi v CROSS JOIN clock LEFT JOIN watched w ON w.viewer_id=v.viewer_id LEFT JOIN ti ON ti.title_id=w.title_id GROUP BY v.viewer_id),
elig AS (SELECT viewer_id, rail_id, rail_type, editorial_rank FROM state CROSS JOIN rails WHERE CASE rail_id WHEN 'r_continue' THEN has_inprogress
    WHEN 'r_because' THEN has_history WHEN 'r_new_eps' THEN has_simulcast_history WHEN 'r_watchlist' THEN has_watchlist ELSE true END)"""
ELIG = ("ev", "ti", "vi", "rails", "clock")

SCORE = f"""vh AS (SELECT viewer_id, {r('(atan2(sn,cs)*(24.0/(2.0*3.141592653589793))::DOUBLE+24.0::DOUBLE)%24.0::DOUBLE', 3)} AS typical_watch_hour,
    {r('sqrt(sn*sn+cs*cs)/1000000000/n', 4)} AS hour_concentration FROM (SELECT viewer_id, count(*) AS n,
      sum(CAST(round(sin(hour(event_ts)*(2.0*3.141592653589793/24.0)::DOUBLE)*1000000000) AS BIGINT))::DOUBLE AS sn,
      sum(CAST(round(cos(hour(event_ts)*(2.0*3.141592653589793/24.0)::DOUBLE)*1000000000) AS BIGINT))::DOUBLE AS cs
    FROM ev WHERE watch_seconds>0 GROUP BY 1)),
vr AS (SELECT viewer_id, rail_id, sum(engaged)/count(*) AS vr_ctr FROM imp, iclock
  WHERE rendered_ts > as_of - INTERVAL 30 DAY AND rendered_ts <= as_of GROUP BY 1,2),
ctx(context, device, hour_of_day) AS (VALUES ('21 tv','tv',21), ('09 tv','tv',9), ('21 mobile','mobile',21), ('09 mobile','mobile',9)),
sc AS (SELECT e.viewer_id, e.rail_id, e.editorial_rank, context, device, hour_of_day,
    {r(f"coalesce(rail_clicks_30d/rail_impressions_30d,0) + 0.5::DOUBLE*coalesce(vr_ctr,0) + 0.1::DOUBLE*({FIT}) + 0.05::DOUBLE*({HOUR})", 9)} AS prediction
  FROM (SELECT *, list_position(['continue_watching','new_release','personalized','trending','watchlist','genre','editorial'], rail_type)-1 AS rail_type_idx
        FROM elig CROSS JOIN ctx) e
  LEFT JOIN aud USING (rail_id) LEFT JOIN vr ON vr.viewer_id=e.viewer_id AND vr.rail_id=e.rail_id LEFT JOIN vh ON vh.viewer_id=e.viewer_id),
rk AS (SELECT viewer_id, rail_id, editorial_rank, prediction, context, row_number() OVER (PARTITION BY viewer_id, context ORDER BY prediction DESC, rail_id) AS rail_rank FROM sc)"""
SCORED = ("ev", "ti", "vi", "rails", "imp", "clock", "iclock", "aud")

CONTEXTS = [("21 tv", "tv", 21), ("09 tv", "tv", 9), ("21 mobile", "mobile", 21), ("09 mobile", "mobile", 9)]


def eligible(spark, d, only=None):
    ev = I.events(spark, d)
    return K.eligible_rails(ev, I.titles(spark, d), I.viewers(spark, d), I.rails(spark), P.data_clock(ev), only)


def scored_pairs(spark, d, contexts=CONTEXTS[:1], only=None):
    """Eligible pairs under each context with a fixed formula score (no trained model)."""
    ev, imp = I.events(spark, d), I.impressions(spark, d)
    sin, cos = angle_parts(F.hour("event_ts"))
    hours = (ev.where("watch_seconds > 0").groupBy("viewer_id")
             .agg(F.sum(sin).alias("s"), F.sum(cos).alias("c"), F.count(F.lit(1)).alias("n"))
             .select("viewer_id", F.round(circular_hour(F.col("s"), F.col("c"), F.col("n")), 3).alias("typical"),
                     F.round(circular_concentration(F.col("s"), F.col("c"), F.col("n")), 4).alias("conc")))
    now = imp.agg(F.max("rendered_ts")).scalar()
    mine = (trailing(imp, "rendered_ts", now, "30 DAYS").groupBy("viewer_id", "rail_id")
            .agg((F.sum("engaged") / F.count(F.lit(1))).alias("vr_ctr")))
    aud = P.rail_audience(imp, now).select("rail_id", ratio(F.col("rail_clicks_30d"), F.col("rail_impressions_30d")).alias("ctr"))
    ctx = F.array(*[F.struct(F.lit(n).alias("context"), F.lit(dev).alias("device"),
                             F.lit(h).cast("bigint").alias("hour_of_day")) for n, dev, h in contexts])
    types = F.array(*[F.lit(t) for t in RAIL_TYPES])
    rails = I.rails(spark).select("rail_id", "editorial_rank",
                                  (F.array_position(types, F.col("rail_type")) - 1).alias("type_idx"))
    p = (eligible(spark, d, only).join(rails, "rail_id").join(aud, "rail_id", "left")
         .join(mine, ["viewer_id", "rail_id"], "left").join(hours, "viewer_id", "left")
         .withColumn("_c", F.explode(ctx)).select("*", "_c.*").drop("_c"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    score = (zero("ctr") + 0.5 * zero("vr_ctr") + 0.1 * R.device_rail_fit(F.col("device"), F.col("type_idx"))
             + 0.05 * R.hour_affinity(F.col("hour_of_day"), F.col("typical"), F.col("conc")))
    return p.select("viewer_id", "rail_id", "editorial_rank", "context", "device", "hour_of_day",
                    F.round(score, 9).alias("prediction"))


@query(with_(*ELIG, more=STATE) + "SELECT * FROM state")
def viewer_state(spark, d):
    ev = I.events(spark, d)
    return K.viewer_state(ev, I.titles(spark, d), I.viewers(spark, d), P.data_clock(ev))


@query(with_(*ELIG, more=STATE) + "SELECT viewer_id, rail_id FROM elig")
def eligible_all(spark, d):
    return eligible(spark, d)


@query(with_(*ELIG, more=STATE) + "SELECT viewer_id, rail_id FROM elig WHERE viewer_id IN (SELECT DISTINCT viewer_id FROM ev WHERE event_type='complete')")
def eligible_for_key_frame(spark, d):
    only = I.events(spark, d).where("event_type = 'complete'").select("viewer_id")
    return eligible(spark, d, only)


@query(with_(*ELIG, more=STATE) + """SELECT rails.rail_id, rail_name, rails.rail_type, rail_genre, rails.editorial_rank FROM elig JOIN rails USING (rail_id)
  WHERE viewer_id=(SELECT viewer_id FROM ev GROUP BY 1 ORDER BY count(*) DESC, viewer_id LIMIT 1)""")
def eligible_for_most_active(spark, d):
    ev = I.events(spark, d)
    top = ev.groupBy("viewer_id").count().orderBy(F.col("count").desc(), "viewer_id").limit(1).select("viewer_id")
    return (eligible(spark, d, top).join(I.rails(spark), "rail_id")
            .select("rail_id", "rail_name", "rail_type", "rail_genre", "editorial_rank"))


@query(with_("ev", "vi") + """SELECT viewer_id, count(*) AS events FROM ev JOIN vi USING (viewer_id) WHERE age_bracket IN ('25-34','35-44','45+')
  GROUP BY 1 ORDER BY events DESC, viewer_id LIMIT 10""")
def most_active_viewers(spark, d):
    v = I.viewers(spark, d).where(F.col("age_bracket").isin("25-34", "35-44", "45+")).select("viewer_id")
    n = I.events(spark, d).groupBy("viewer_id").agg(F.count(F.lit(1)).alias("events"))
    return n.join(v, "viewer_id").orderBy(F.col("events").desc(), "viewer_id").limit(10)


@query(with_("ev", "ti", "vi", "ent") + "SELECT viewer_id, title_id, allowed FROM ent")
def entitlement_rule(spark, d):
    return I.entitlements(spark, d)


CAND = """done AS (SELECT DISTINCT viewer_id, title_id FROM ev WHERE event_type='complete'),
cand AS (SELECT viewer_id, title_id, title_name, primary_genre, maturity_rating, candidate_rank FROM (
  SELECT e.viewer_id, ti.*, row_number() OVER (PARTITION BY e.viewer_id ORDER BY intrinsic_popularity DESC, ti.title_id) AS candidate_rank
  FROM ent e JOIN ti USING (title_id) LEFT JOIN done USING (viewer_id, title_id) WHERE allowed AND done.title_id IS NULL) WHERE candidate_rank<=25)"""


@query(with_("ev", "ti", "vi", "ent", more=CAND) + "SELECT * FROM cand")
def candidates_top_n(spark, d):
    return K.candidates(I.entitlements(spark, d), I.titles(spark, d), I.events(spark, d), parts=I.log_parts(spark, d))


@query(with_("ev", "ti", "vi", "ent", "clock", more=CAND) + """SELECT viewer_id, title_id, 'post_play' AS surface, 'tv' AS device, 'en-US' AS locale,
  CAST(hour(as_of) AS BIGINT) AS hour_of_day, CAST(isodow(as_of)-1 AS BIGINT) AS day_of_week, CAST(floor(epoch(as_of)) AS BIGINT) AS request_epoch_s FROM cand, clock""")
def title_request_rows(spark, d):
    ev = I.events(spark, d)
    c = K.candidates(I.entitlements(spark, d), I.titles(spark, d), ev, parts=I.log_parts(spark, d)).select("viewer_id", "title_id")
    return K.with_context(c, P.data_clock(ev), "tv", surface="post_play")


@query(with_(*ELIG, more=STATE) + """SELECT viewer_id, rail_id, 'tv' AS device, 'en-US' AS locale, CAST(21 AS BIGINT) AS hour_of_day,
  CAST(isodow(as_of)-1 AS BIGINT) AS day_of_week, CAST(floor(epoch(as_of)) AS BIGINT) AS request_epoch_s FROM elig, clock""")
def scoring_frame(spark, d):
    return K.with_context(eligible(spark, d), P.data_clock(I.events(spark, d)), "tv", hour=21)


@query(with_(*SCORED, more=STATE + ",\n" + SCORE) + """SELECT viewer_id, rail_id, rail_rank, prediction AS engagement_probability,
  'v1' AS model_version, 'tv' AS context_device, CAST(21 AS BIGINT) AS context_hour FROM rk WHERE context='21 tv'""")
def rank_within_viewer(spark, d):
    k = K.rank_rails(scored_pairs(spark, d))
    return k.select("viewer_id", "rail_id", "rail_rank", F.col("prediction").alias("engagement_probability"),
                    F.lit("v1").alias("model_version"), F.lit("tv").alias("context_device"),
                    F.lit(21).cast("bigint").alias("context_hour"))


@query(with_(*SCORED, more=STATE + ",\n" + SCORE) + "SELECT viewer_id, rail_id, rail_rank, prediction FROM rk WHERE context='21 tv' AND rail_rank<=5")
def rank_top_five(spark, d):
    return K.rank_rails(scored_pairs(spark, d), top_n=5).select("viewer_id", "rail_id", "rail_rank", "prediction")


@query(with_(*SCORED, more=STATE + ",\n" + SCORE) + """SELECT viewer_id, rail_id, rail_rank, editorial_position, editorial_position-rail_rank AS moved FROM (
  SELECT *, row_number() OVER (PARTITION BY viewer_id ORDER BY editorial_rank) AS editorial_position FROM rk WHERE context='21 tv')""")
def editorial_moved(spark, d):
    k = K.rank_rails(scored_pairs(spark, d)).drop("editorial_rank")
    return K.moved_from_editorial(k, I.rails(spark)).select("viewer_id", "rail_id", "rail_rank",
                                                            "editorial_position", "moved")


@query(with_(*SCORED, more=STATE + ",\n" + SCORE) + """SELECT a.viewer_id, a.context, count(*) AS rails, count(*) FILTER (a.rail_rank<>b.rail_rank) AS moved
  FROM rk a JOIN rk b ON a.viewer_id=b.viewer_id AND a.rail_id=b.rail_id AND b.context='21 tv' WHERE a.context<>'21 tv' GROUP BY 1,2""")
def context_sensitivity(spark, d):
    return K.context_moves(scored_pairs(spark, d, CONTEXTS), "21 tv")


@query(with_(*SCORED, more=STATE + ",\n" + SCORE) + f"""SELECT a.viewer_id, count(*) AS compared, count(*) FILTER (a.rail_rank=b.rail_rank) AS identical_rank,
  {r('max(abs(a.prediction-b.prediction))', 9)} AS max_prob_delta, {r('corr(a.rail_rank, b.rail_rank)', 7)} AS spearman
  FROM rk a JOIN rk b ON a.viewer_id=b.viewer_id AND a.rail_id=b.rail_id AND b.context='09 mobile' WHERE a.context='21 tv' GROUP BY 1""")
def ranking_agreement(spark, d):
    s = scored_pairs(spark, d, [CONTEXTS[0], CONTEXTS[3]])
    half = lambda n: K.rank_rails(s.where(F.col("context") == n))
    g = K.ranking_agreement(half("21 tv"), half("09 mobile"))
    return g.withColumns({"max_prob_delta": F.round("max_prob_delta", 9), "spearman": F.round("spearman", 7)})


@query(with_(*SCORED, more=STATE + ",\n" + SCORE) + f"""SELECT a.viewer_id, a.rail_id, a.prediction AS score_before, b.prediction AS score_after,
  {r('b.prediction-a.prediction', 9)} AS delta, abs(b.prediction-a.prediction)>0.001 AS moved
  FROM rk a JOIN rk b ON a.viewer_id=b.viewer_id AND a.rail_id=b.rail_id AND b.context='21 mobile' WHERE a.context='21 tv'""")
def score_shift(spark, d):
    s = scored_pairs(spark, d, [CONTEXTS[0], CONTEXTS[2]])
    half = lambda n: s.where(F.col("context") == n).select("viewer_id", "rail_id", F.col("prediction").alias("score"))
    g = K.score_shift(half("21 tv"), half("21 mobile"), ["viewer_id", "rail_id"])
    return g.withColumn("delta", F.round("delta", 9))


FILL = """hist AS (SELECT w.viewer_id, w.title_id, last_ts, is_simulcast FROM watched w JOIN ent e USING (viewer_id, title_id) JOIN ti ON ti.title_id=w.title_id WHERE allowed),
fill AS (SELECT viewer_id, rail_id, title_id, position FROM (
    SELECT viewer_id, rail_id, title_id, row_number() OVER (PARTITION BY viewer_id, rail_id ORDER BY last_ts DESC, title_id) AS position
    FROM elig JOIN hist USING (viewer_id) WHERE rail_id IN ('r_continue','r_watchlist','r_because','r_new_eps') AND (rail_type<>'new_release' OR is_simulcast)
  UNION ALL
    SELECT elig.viewer_id, elig.rail_id, rtm.title_id, row_number() OVER (PARTITION BY elig.viewer_id, elig.rail_id ORDER BY rank_in_rail) AS position
    FROM elig JOIN rtm USING (rail_id) JOIN ent e ON e.viewer_id=elig.viewer_id AND e.title_id=rtm.title_id AND allowed
    WHERE rail_id NOT IN ('r_continue','r_watchlist','r_because','r_new_eps')) WHERE position<=10)"""


def filled(spark, d):
    ev, ti, rails = I.events(spark, d), I.titles(spark, d), I.rails(spark)
    return K.rail_fill(eligible(spark, d), rails, P.rail_title_map(ti, rails, P.data_clock(ev)),
                       I.entitlements(spark, d), ev, ti, 10)


@query(with_(*ELIG, "ent", "rtm", more=STATE + ",\n" + FILL) + "SELECT * FROM fill")
def rail_fill(spark, d):
    return filled(spark, d)


@query(with_(*SCORED, "ent", "rtm", more=STATE + ",\n" + SCORE + ",\n" + FILL) + """, ts AS (SELECT viewer_id, title_id, sum(watch_seconds)/60.0::DOUBLE AS s FROM ev GROUP BY 1,2),
l AS (SELECT viewer_id, rail_id, string_agg(title_id::VARCHAR, ',' ORDER BY coalesce(s,0) DESC, position, title_id) AS titles FROM fill LEFT JOIN ts USING (viewer_id, title_id) GROUP BY 1,2)
SELECT viewer_id, rail_id, rail_rank, coalesce(titles,'') AS titles FROM rk LEFT JOIN l USING (viewer_id, rail_id) WHERE context='21 tv' AND rail_rank<=6""")
def homepage(spark, d):
    scores = (I.events(spark, d).groupBy("viewer_id", "title_id")
              .agg((F.sum("watch_seconds") / 60.0).alias("title_score")))
    return K.assemble_homepage(K.rank_rails(scored_pairs(spark, d), top_n=6), filled(spark, d), scores, 6)


LAST_GOOD = """lg AS (SELECT viewer_id, rail_id, min(rail_position) AS cached_rank FROM imp
  JOIN (SELECT viewer_id, arg_max(session_id, (rendered_ts, session_id)) AS session_id FROM imp GROUP BY 1) USING (viewer_id, session_id) GROUP BY 1,2)"""


@query(with_("ev", "ti", "vi", "rails", "imp", "clock", more=STATE + ",\n" + LAST_GOOD) + """SELECT viewer_id, rail_id,
  row_number() OVER (PARTITION BY viewer_id ORDER BY cached_rank IS NULL, cached_rank, editorial_rank) AS rail_rank,
  CASE WHEN viewer_id IN (SELECT viewer_id FROM lg) THEN 'cached' ELSE 'editorial' END AS source FROM elig LEFT JOIN lg USING (viewer_id, rail_id)""")
def fallback_order(spark, d):
    imp = I.impressions(spark, d)
    last = imp.groupBy("viewer_id").agg(F.max(F.struct("rendered_ts", "session_id"))["session_id"].alias("session_id"))
    good = (imp.join(last, ["viewer_id", "session_id"]).groupBy("viewer_id", "rail_id")
            .agg(F.min("rail_position").alias("cached_rank")))
    return K.fallback_rails(eligible(spark, d), I.rails(spark), good)


@query(with_("ev", "ti", "vi", "ent", more="""done AS (SELECT DISTINCT viewer_id, title_id FROM ev WHERE event_type='complete'),
m AS (SELECT user_id AS viewer_id, CAST(regexp_extract(props,'[0-9]+',0) AS BIGINT) AS title_id, max(value) FILTER (event_type='click' AND user_id%3=0) AS ms,
  max(value) FILTER (event_type='signup' AND user_id%3<2) AS rs FROM events GROUP BY 1,2),
c AS (SELECT e.viewer_id, e.title_id, ms, rs, intrinsic_popularity AS pop FROM ent e JOIN ti USING (title_id) LEFT JOIN done USING (viewer_id, title_id)
  LEFT JOIN m ON m.viewer_id=e.viewer_id AND m.title_id=e.title_id WHERE allowed AND done.title_id IS NULL),
s AS (SELECT viewer_id, CASE WHEN count(ms)>0 THEN 'model' WHEN count(rs)>0 THEN 'retrieval' ELSE 'popularity' END AS source FROM c GROUP BY 1)""")
       + """SELECT * FROM (SELECT viewer_id, title_id, source, CASE source WHEN 'model' THEN ms WHEN 'retrieval' THEN rs ELSE pop END AS score,
  row_number() OVER (PARTITION BY viewer_id ORDER BY CASE source WHEN 'model' THEN ms WHEN 'retrieval' THEN rs ELSE pop END DESC NULLS LAST, title_id) AS position
  FROM c JOIN s USING (viewer_id)) WHERE position<=10 AND score IS NOT NULL""")
def title_fallback_chain(spark, d):
    raw = I.table(spark, d, "events")
    t, u = F.col("event_type"), F.col("user_id")
    m = (raw.select(u.alias("viewer_id"), F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("title_id"),
                    F.when((t == "click") & (u % 3 == 0), F.col("value")).alias("ms"),
                    F.when((t == "signup") & (u % 3 < 2), F.col("value")).alias("rs"))
         .groupBy("viewer_id", "title_id").agg(F.max("ms").alias("model_score"), F.max("rs").alias("retrieval_score")))
    open_ = (I.entitlements(spark, d).where("allowed").select("viewer_id", "title_id")
             .join(K.completed_titles(I.events(spark, d)), ["viewer_id", "title_id"], "left_anti"))
    pop = I.titles(spark, d).select("title_id", F.col("intrinsic_popularity").alias("popularity"))
    return K.title_fallback(open_.join(pop, "title_id").join(m, ["viewer_id", "title_id"], "left"), 10)


@query(with_("ev", "ti", "clock", more=STATE.split(",\nstate")[0]) + """SELECT viewer_id, count(*) FILTER (last_ts > as_of - INTERVAL 7 DAY) AS inprogress, count(*) AS history,
  count(*) FILTER (is_simulcast) AS simulcast FROM watched CROSS JOIN clock JOIN ti USING (title_id) GROUP BY 1""")
def viewer_state_counts(spark, d):
    ev = I.events(spark, d)
    return K.state_counts(ev, I.titles(spark, d), P.data_clock(ev))


@query(with_("ev") + """SELECT viewer_id, string_agg(title_id::VARCHAR, ',' ORDER BY title_id) AS done
  FROM (SELECT DISTINCT viewer_id, title_id FROM ev WHERE event_type='complete') GROUP BY 1""")
def completed_sets(spark, d):
    return K.viewer_sets(I.events(spark, d).where("event_type = 'complete'"), "title_id", "done")


@query(with_("ev", "ti", "vi", "ent") + """SELECT viewer_id, string_agg(title_id::VARCHAR, ',' ORDER BY title_id) AS titles FROM ent WHERE allowed GROUP BY 1""")
def entitled_sets(spark, d):
    mine = I.entitlements(spark, d).where("allowed").select("viewer_id", "title_id")
    return K.viewer_sets(I.dealt(mine, I.log_parts(spark, d), "viewer_id"), "title_id", "titles")


@query(with_("ev") + "SELECT DISTINCT viewer_id, title_id FROM ev WHERE event_type='complete' AND event_ts <= (SELECT max(event_ts) - INTERVAL 10 DAY FROM ev)")
def completion_pairs_before_cutoff(spark, d):
    ev = I.events(spark, d)
    cut = P.data_clock(ev) - F.expr("INTERVAL 10 DAYS")
    return K.completed_titles(ev.where(F.col("event_ts") <= cut))


@query(with_("ti") + "SELECT title_id, title_name, intrinsic_popularity FROM ti ORDER BY intrinsic_popularity DESC, title_id LIMIT 25")
def top_titles(spark, d):
    return (I.titles(spark, d).select("title_id", "title_name", "intrinsic_popularity")
            .orderBy(F.col("intrinsic_popularity").desc(), "title_id").limit(25))


@query(with_("imp") + """SELECT viewer_id, CAST(sum(engaged) AS BIGINT) AS clicks FROM imp GROUP BY 1 ORDER BY clicks DESC, viewer_id LIMIT 20""")
def top_keys_by_clicks(spark, d):
    return (I.impressions(spark, d).groupBy("viewer_id").agg(F.sum("engaged").alias("clicks"))
            .orderBy(F.col("clicks").desc(), "viewer_id").limit(20))


RETR = """it AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e, label/10.0::DOUBLE AS pop FROM embeddings),
ret AS (SELECT viewer_id, title_id, s, rank FROM (SELECT q.vec_id AS viewer_id, i.vec_id AS title_id,
    list_dot_product(q.e, i.e) + 0.01::DOUBLE*i.pop AS s,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, i.e) + 0.01::DOUBLE*i.pop DESC, i.vec_id) AS rank
  FROM it q CROSS JOIN it i) WHERE rank<=60)"""


def retrieved(spark, d, k=60):
    v = I.table(spark, d, "embeddings")
    items = v.select(F.col("vec_id").alias("title_id"), F.col("embedding").alias("vector"),
                     (F.col("label") / 10.0 * 0.01).alias("bonus"))
    asks = v.select(F.col("vec_id").alias("viewer_id"), F.col("embedding").alias("vector"))
    return top_k_dot(asks, items, k, "viewer_id", "title_id", bonus="bonus")


@query("WITH " + RETR + f" SELECT viewer_id, title_id, {r('s', 6)} AS retrieval_score, rank FROM ret")
def retrieval_top_k(spark, d):
    return retrieved(spark, d).withColumn("retrieval_score", F.round("retrieval_score", 6))


@query(with_("ev", "ti", "vi", "ent", more="done AS (SELECT DISTINCT viewer_id, title_id FROM ev WHERE event_type='complete'),\n" + RETR)
       + """SELECT r.viewer_id, count(*) AS retrieved, count(*) FILTER (e.title_id IS NOT NULL AND done.title_id IS NULL) AS entitled_unseen,
  least(count(*) FILTER (e.title_id IS NOT NULL AND done.title_id IS NULL), 25) AS ranked
  FROM ret r LEFT JOIN (SELECT * FROM ent WHERE allowed) e ON e.viewer_id=r.viewer_id AND e.title_id=r.title_id
  LEFT JOIN done ON done.viewer_id=r.viewer_id AND done.title_id=r.title_id GROUP BY 1""")
def candidate_funnel(spark, d):
    return K.funnel(retrieved(spark, d), I.entitlements(spark, d), I.events(spark, d), 25)


@query(with_("imp") + """SELECT session_id, rail_id, position, row_number() OVER (PARTITION BY session_id ORDER BY score DESC, rail_id) AS rank_by_score
FROM (SELECT session_id, rail_id, min(rail_position) AS position, max(score_a) AS score FROM imp GROUP BY 1,2)""")
def session_policy_position(spark, d):
    one = (I.impressions(spark, d).groupBy("session_id", "rail_id")
           .agg(F.min("rail_position").alias("position"), F.max("score_a").alias("score")))
    # At most one row per catalog rail in a session after the grouping.
    return ranked(one, ["session_id"], [F.col("score").desc(), F.col("rail_id")], "rank_by_score"
                    ).select("session_id", "rail_id", "position", "rank_by_score")


@query(with_("imp") + """SELECT viewer_id, day, session_id, row_number() OVER (PARTITION BY viewer_id, day ORDER BY rendered_ts, session_id)-1 AS session_seq
FROM (SELECT DISTINCT viewer_id, session_id, rendered_ts, rendered_ts::DATE AS day FROM imp)""")
def session_ordinal(spark, d):
    s = I.impressions(spark, d).select("viewer_id", "session_id", "rendered_ts").distinct()
    return K.session_ordinals(s, I.log_parts(spark, d))


@query(with_("ev", "ti", "rails", "imp", "clock", "iclock", "aud", "rtm", "tf", "rf") + f"""SELECT rail_name, rail_type, editorial_rank,
  rank() OVER (ORDER BY rail_ctr_30d DESC) AS ctr_rank, editorial_rank - rank() OVER (ORDER BY rail_ctr_30d DESC) AS positions_misplaced,
  {r('rail_ctr_30d', 4)} AS ctr, rail_impressions_30d FROM rf JOIN rails USING (rail_id)""")
def editorial_misplacement(spark, d):
    from .features import rail_features
    f = rail_features(spark, d).join(I.rails(spark), "rail_id")
    # The rail catalog has one row per rail; ranking it whole is a handful of rows.
    rk = F.rank().over(Window.partitionBy(F.lit(0)).orderBy(F.col("rail_ctr_30d").desc()))
    return f.withColumn("ctr_rank", rk).select(
        "rail_name", "rail_type", "editorial_rank", "ctr_rank",
        (F.col("editorial_rank") - F.col("ctr_rank")).alias("positions_misplaced"),
        F.round("rail_ctr_30d", 4).alias("ctr"), "rail_impressions_30d")


@query(with_("ev", "ti") + f"""SELECT title_id, title_name, {r('score', 6)} AS score FROM (
  SELECT title_id, avg(played) AS score FROM ev WHERE event_type='impression' GROUP BY 1) JOIN ti USING (title_id)""")
def attach_scores(spark, d):
    s = (I.events(spark, d).where("event_type = 'impression'").groupBy("title_id")
         .agg(F.round(F.avg("played"), 6).alias("score")))
    return (I.titles(spark, d).select("title_id", "title_name").join(s, "title_id")
            .orderBy(F.col("score").desc(), "title_id"))
