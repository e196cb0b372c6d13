"""Operations, cost and quality queries."""

from pyspark.sql import functions as F

from ..plans import features as P, monitor as O
from ..sources import inputs as I
from .base_sql import r, with_
from .registry import query


@query(with_("log") + """SELECT surface, device, locale, hour_of_day, count(*) AS rows_scored, count(DISTINCT request_id) AS requests
  FROM log, (VALUES (0),(1)) s(i) GROUP BY 1,2,3,4""")
def request_mix(spark, d):
    return O.request_mix(I.request_log(spark, d))


@query(with_("log", "ti") + f"""SELECT primary_genre, count(*) AS scored, {r('avg(score)', 4)} AS mean_score, {r('max(score)', 4)} AS max_score FROM (
  SELECT k+i AS title_id, CASE i WHEN 0 THEN value/100 ELSE value/200 END AS score FROM log, (VALUES (0),(1)) s(i) WHERE status_code=200) JOIN ti USING (title_id) GROUP BY 1""")
def score_by_group(spark, d):
    return O.score_by_group(I.request_log(spark, d), I.titles(spark, d))


@query(with_("log") + """SELECT date_trunc('hour', request_time) AS hour_bucket, served_entity_id, count(*) AS requests, quantile_disc(execution_duration_ms, 0.5) AS p50_ms,
  quantile_disc(execution_duration_ms, 0.95) AS p95_ms, quantile_disc(execution_duration_ms, 0.99) AS p99_ms,
  round(100.0::DOUBLE*count(*) FILTER (status_code<>200)/count(*), 2) AS error_pct FROM log GROUP BY 1,2""")
def serving_latency_hourly(spark, d):
    return O.serving_latency_hourly(I.request_log(spark, d))


@query(with_("log") + """SELECT date_trunc('hour', request_time) AS hour_bucket, served_entity_id, count(*) AS requests,
  round(100.0::DOUBLE*count(*) FILTER (status_code<>200)/count(*), 2) AS error_pct FROM log GROUP BY 1,2""")
def serving_volume_hourly(spark, d):
    return O.serving_latency_hourly(I.request_log(spark, d)).select("hour_bucket", "served_entity_id", "requests", "error_pct")


def _interp(q):
    pos = f"({q}::DOUBLE*(n-1))"
    lo, hi = f"max(v) FILTER (i=floor({pos}))", f"max(v) FILTER (i=ceil({pos}))"
    pos = pos.replace("n", "max(n)")
    return (f"round(CASE WHEN ceil({pos})=floor({pos}) THEN {lo} ELSE (ceil({pos})-{pos})*{lo} + ({pos}-floor({pos}))*{hi} END, 1)")


def _ordered(by):
    part = f"PARTITION BY {by}" if by else ""
    return (f"SELECT *, execution_duration_ms::DOUBLE AS v, row_number() OVER ({part} ORDER BY execution_duration_ms)-1 AS i, "
            f"count(*) OVER ({part}) AS n FROM log")


@query(with_("log") + f""", o AS ({_ordered('')} WHERE request_time >= TIMESTAMP '2024-01-10')
SELECT count(*) AS requests, {_interp(0.5)} AS p50_ms, {_interp(0.95)} AS p95_ms, {_interp(0.99)} AS p99_ms,
  max(execution_duration_ms) AS max_ms, count(*) FILTER (status_code<>200) AS non_200 FROM o""")
def latency_since(spark, d):
    return O.latency_since(I.request_log(spark, d), F.lit("2024-01-10").cast("timestamp"))


@query(with_("log") + f""", o AS ({_ordered('served_entity_id')})
SELECT served_entity_id, count(*) AS requests, count(*) FILTER (status_code<>200) AS errors, {_interp(0.95)} AS p95_ms FROM o GROUP BY 1""")
def entity_attribution(spark, d):
    return O.entity_attribution(I.request_log(spark, d))


NR = """nr AS (SELECT event_type AS phase, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events)"""


def _nr(q):
    return f"max(value) FILTER (i = greatest(0, least(n-1, CAST(round_even({q}::DOUBLE*n, 0) AS BIGINT)-1)))"


@query("WITH " + NR + " SELECT phase, max(n) AS n, round(min(value),1) AS min_ms, "
       + ", ".join(f"{r(_nr(q), 1)} AS p{int(q * 100)}_ms" for q in (0.5, 0.9, 0.95, 0.99))
       + f", {r('max(value)', 1)} AS max_ms, {r('avg(value)', 1)} AS mean_ms, {r('stddev_pop(value)', 1)} AS stdev_ms FROM nr GROUP BY 1")
def nearest_rank_percentiles(spark, d):
    s = I.table(spark, d, "events").select(F.col("event_type").alias("phase"), "value")
    return O.latency_percentiles(s, ["phase"], "value")


@query("WITH " + NR + """ SELECT phase AS stage, max(n) AS n, max(value) FILTER (i=least(n-1, floor(0.5::DOUBLE*n))) AS p50_ms,
  max(value) FILTER (i=least(n-1, floor(0.95::DOUBLE*n))) AS p95_ms FROM nr GROUP BY 1""")
def stage_latency(spark, d):
    e = I.table(spark, d, "events")
    stages = e.select(F.explode(F.array(F.struct(F.col("event_type").alias("stage"), F.col("value").alias("ms")))).alias("s")).select("s.*")
    return O.stage_latency(stages, ["stage"], "ms")


@query("""SELECT CASE WHEN event_type='view' THEN 'model' WHEN event_type='click' THEN 'cached' ELSE 'editorial' END AS source, count(*) AS requests FROM events GROUP BY 1""")
def served_source_mix(spark, d):
    t = F.col("event_type")
    return (I.table(spark, d, "events")
            .groupBy(F.when(t == "view", "model").when(t == "click", "cached").otherwise("editorial").alias("source"))
            .agg(F.count(F.lit(1)).alias("requests")))


RUNS = """runs AS (SELECT 'endpoint-'||user_id%3 AS phase, ts, value, CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 429 WHEN 'click' THEN 0 ELSE 200 END AS status FROM events)"""


def runs(spark, d):
    e, t = I.table(spark, d, "events"), F.col("event_type")
    return e.select(F.concat(F.lit("endpoint-"), (F.col("user_id") % 3).cast("string")).alias("phase"),
                    F.col("ts").cast("timestamp").alias("started"), F.col("value").alias("ms"),
                    F.when(t == "error", 500).when(t == "signup", 429).when(t == "click", 0).otherwise(200).alias("status"))


@query("WITH " + RUNS + """ SELECT phase, string_agg(code||'='||n, ',' ORDER BY code||'='||n) AS errors FROM (
  SELECT phase, CASE WHEN status=0 THEN 'transport' ELSE 'http_'||status END AS code, count(*) AS n FROM runs WHERE status<>200 GROUP BY 1,2) GROUP BY 1""")
def error_counts(spark, d):
    return O.error_counts(runs(spark, d), ["phase"], "status")


@query("WITH " + RUNS + """, w AS (SELECT phase, floor((epoch_us(ts)-t0)/(86400*1000000.0::DOUBLE)) AS w, count(*) AS requests, round(count(*) FILTER (status=200)/86400.0::DOUBLE, 1) AS rps0,
   round(CAST(count(*) FILTER (status=200)/86400.0::DOUBLE AS DECIMAL(30,12)),1)::DOUBLE AS rps
  FROM runs JOIN (SELECT phase, min(epoch_us(ts)) AS t0 FROM runs GROUP BY 1) USING (phase) GROUP BY ALL),
b AS (SELECT phase, max(rps) AS best_rps, arg_min(rps, w) AS first_rps FROM w GROUP BY 1)
SELECT phase, best_rps, first_rps, count(*) AS windows, CAST(sum(requests) AS BIGINT) AS requests,
  CAST(min(w*86400) FILTER (best_rps>0 AND rps>=0.9::DOUBLE*best_rps) AS BIGINT) AS seconds_to_90pct_of_best,
  round(best_rps/nullif(first_rps,0),2) AS scale_up_factor FROM w JOIN b USING (phase) GROUP BY 1,2,3""")
def throughput_plateau_daily(spark, d):
    return O.throughput_windows(runs(spark, d), "phase", "started", F.col("status") == 200, 86400)


@query("WITH " + RUNS + """, s AS (SELECT floor((epoch_us(ts)-(SELECT min(epoch_us(ts)) FROM runs WHERE phase='endpoint-0'))/3600000000.0::DOUBLE) AS step, value FROM runs WHERE phase='endpoint-0' AND status=200),
r AS (SELECT step, value, row_number() OVER (PARTITION BY step ORDER BY value)-1 AS i, count(*) OVER (PARTITION BY step) AS n FROM s),
p AS (SELECT step, round(max(value) FILTER (i=greatest(0,least(n-1,CAST(round_even(0.95::DOUBLE*n,0) AS BIGINT)-1))),1) AS p95 FROM r GROUP BY 1),
rb AS (SELECT value, row_number() OVER (ORDER BY value)-1 AS i, count(*) OVER () AS n FROM runs WHERE phase='endpoint-1' AND status=200),
base AS (SELECT round(max(value) FILTER (i=greatest(0,least(n-1,CAST(round_even(0.95::DOUBLE*n,0) AS BIGINT)-1))),1) AS p95 FROM rb)
SELECT arg_min(p.p95, step) AS first_step_p95_ms, max(base.p95) AS baseline_p95_ms, CAST(min(step) FILTER (p.p95<=base.p95*1.5::DOUBLE) AS BIGINT) AS recovered_at_step, count(*) AS steps FROM p, base""")
def spike_recovery_hourly(spark, d):
    x = runs(spark, d)
    return O.spike_recovery(x.where("phase = 'endpoint-0'"), x.where("phase = 'endpoint-1'"), "started", "ms",
                            F.col("status") == 200, 3600)


NEWEST = "measured_at >= (SELECT max(measured_at) - INTERVAL 1 DAY FROM bench)"
ROLL = "max(p50_ms) AS p50_ms, max(p95_ms) AS p95_ms, max(p99_ms) AS p99_ms, max(rps) AS requests_per_second, CAST(sum(requests-ok) AS BIGINT) AS failed"


@query(with_("bench") + f"SELECT concurrency, where_run, rows_per_request, {ROLL} FROM bench WHERE phase='ramp' AND {NEWEST} GROUP BY 1,2,3")
def benchmark_ramp(spark, d):
    return O.benchmark_rollup(I.benchmark_log(spark, d), F.col("phase") == "ramp",
                              ["concurrency", "where_run", "rows_per_request"]).drop("note")


@query(with_("bench") + f"""SELECT rows_per_request, endpoint, max(p50_ms) AS p50_ms, max(p95_ms) AS p95_ms,
  {r('max(p50_ms)/greatest(rows_per_request,1)', 2)} AS p50_ms_per_rail FROM bench WHERE phase IN ('fanout','features_only') AND {NEWEST} GROUP BY 1,2""")
def benchmark_fanout(spark, d):
    g = O.benchmark_rollup(I.benchmark_log(spark, d), F.col("phase").isin("fanout", "features_only"),
                           ["rows_per_request", "endpoint"])
    return g.select("rows_per_request", "endpoint", "p50_ms", "p95_ms",
                    F.round(F.col("p50_ms") / F.greatest("rows_per_request", F.lit(1)), 2).alias("p50_ms_per_rail"))


@query(with_("bench") + f"SELECT phase, concurrency, {ROLL}, max(note) AS note FROM bench WHERE phase LIKE 'spike%' AND {NEWEST} GROUP BY 1,2")
def benchmark_spike(spark, d):
    return O.benchmark_rollup(I.benchmark_log(spark, d), F.col("phase").like("spike%"), ["phase", "concurrency"])


@query(with_("bench") + """, m AS (SELECT where_run, endpoint, max(measured_at) AS measured_at, max('{"route_optimized":'||(k%2=0)||',"served_entities":[{"scale_to_zero":'||(k%3=0)||',"min_provisioned_concurrency":'||k||',"workload_size":"Small"}]}') AS j FROM bench GROUP BY 1,2)
SELECT where_run, endpoint, measured_at, j->>'$.route_optimized' AS route_optimized, j->>'$.served_entities[0].scale_to_zero' AS scale_to_zero,
  j->>'$.served_entities[0].min_provisioned_concurrency' AS min_concurrency, j->>'$.served_entities[0].workload_size' AS workload_size FROM m""")
def benchmark_config(spark, d):
    return O.benchmark_config(I.benchmark_log(spark, d))


PRICE = """us AS (SELECT p_type AS sku_name, l_shipdate AS t, l_shipdate::DATE AS usage_date, l_quantity AS q FROM lineitem JOIN part ON l_partkey=p_partkey),
pr AS (SELECT sku_name, y, (length(sku_name)+y-1990)/100.0::DOUBLE AS price, make_timestamp(y,1,1,0,0,0) AS s, CASE WHEN y<2000 THEN make_timestamp(y+1,1,1,0,0,0) END AS e
  FROM (SELECT DISTINCT p_type AS sku_name FROM part), (SELECT unnest(range(1990,2001)) AS y))"""


@query("WITH " + PRICE + f""" SELECT usage_date, us.sku_name, {r('sum(q)', 2)} AS units, {r('sum(q*price)', 2)} AS list_cost FROM us JOIN pr ON us.sku_name=pr.sku_name AND t>=s AND (e IS NULL OR t<e) GROUP BY 1,2""")
def price_interval_join(spark, d):
    return O.priced_usage(I.usage(spark, d), I.list_prices(spark, d))


@query("WITH " + PRICE + f""" SELECT us.sku_name, {r('sum(q)', 2)} AS units, {r('sum(q*price)', 2)} AS list_cost FROM us JOIN pr ON us.sku_name=pr.sku_name AND t>=s AND (e IS NULL OR t<e)
  WHERE usage_date >= (SELECT max(usage_date) - 14 FROM us) GROUP BY 1""")
def cost_last_two_weeks(spark, d):
    u = I.usage(spark, d)
    recent = u.where(F.col("usage_date") >= F.date_sub(u.agg(F.max("usage_date")).scalar(), 14))
    return (O.priced_usage(recent, I.list_prices(spark, d)).groupBy("sku_name")
            .agg(F.round(F.sum("units"), 2).alias("units"), F.round(F.sum("list_cost"), 2).alias("list_cost")))


SYNC = """sl AS (SELECT 'table-'||user_id AS object, ts AS captured_at, event_type AS state, value AS lag_seconds, event_id AS source_version,
  event_id - CAST(regexp_extract(props,'[0-9]+',0) AS BIGINT)%3 AS processed_version FROM events)"""


def sync_log(spark, d):
    k = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    return I.table(spark, d, "events").select(
        F.concat(F.lit("table-"), F.col("user_id").cast("string")).alias("object"),
        F.col("ts").cast("timestamp").alias("captured_at"), F.col("event_type").alias("state"),
        F.col("value").alias("lag_seconds"), F.col("event_id").alias("source_version"),
        (F.col("event_id") - k % 3).alias("processed_version"))


@query("WITH " + SYNC + """ SELECT object, arg_max(state, (captured_at, source_version)) AS state, max(captured_at) AS last_checked, arg_max(lag_seconds, (captured_at, source_version)) AS lag_seconds,
  arg_max(source_version, (captured_at, source_version)) AS source_version, arg_max(processed_version, (captured_at, source_version)) AS processed_version FROM sl GROUP BY 1""")
def latest_status(spark, d):
    return O.latest_status(sync_log(spark, d))


@query("WITH " + SYNC + """ SELECT object, arg_max(source_version-processed_version, (captured_at, source_version)) AS versions_behind,
  CAST(epoch(TIMESTAMP '2024-02-01') - floor(epoch(max(captured_at))) AS BIGINT) AS seconds_since_sync FROM sl GROUP BY 1""")
def sync_lag(spark, d):
    return O.sync_lag(sync_log(spark, d), F.lit("2024-02-01").cast("timestamp"))


@query(with_("ev", "imp", "ti", "clock", "rb") + f"""SELECT feature_table, n AS rows, e AS newest_event_epoch_s, {r("(epoch(TIMESTAMP '2024-02-10')-e)/60.0::DOUBLE", 1)} AS newest_event_age_min FROM (
  SELECT 'recent_behavior_current' AS feature_table, count(*) AS n, max(last_event_epoch_s) AS e FROM rb UNION ALL
  SELECT 'engagement_events', count(*), CAST(max(floor(epoch(event_ts))) AS BIGINT) FROM ev UNION ALL SELECT 'rail_impressions', count(*), CAST(max(floor(epoch(rendered_ts))) AS BIGINT) FROM imp)""")
def freshness(spark, d):
    ev, imp = I.events(spark, d), I.impressions(spark, d)
    rb = P.recent_behavior(ev, I.titles(spark, d), P.data_clock(ev))
    return O.freshness({"recent_behavior_current": (rb, F.col("last_event_epoch_s")),
                        "engagement_events": (ev, F.unix_timestamp("event_ts")),
                        "rail_impressions": (imp, F.unix_timestamp("rendered_ts"))},
                       F.lit("2024-02-10").cast("timestamp"))


PINS = """pins AS (SELECT DISTINCT p_brand AS model, p_type AS object, CASE WHEN p_type LIKE '%M%' THEN 'table' ELSE 'function' END AS kind FROM part),
now_ AS (SELECT object, substr(sha256(string_agg(s, ',' ORDER BY s)),1,12) AS fingerprint FROM (SELECT DISTINCT p_type AS object, 'size_'||p_size%4||':int' AS s FROM part WHERE p_type<>'PROMO') GROUP BY 1),
rec AS (SELECT model, object, CASE WHEN CAST(regexp_extract(model,'[0-9]+',0) AS INT)%3=1 THEN '000000000000' ELSE fingerprint END AS fingerprint
  FROM pins JOIN now_ USING (object) WHERE CAST(regexp_extract(model,'[0-9]+',0) AS INT)%3<>0)"""


def pin_frames(spark, d):
    p = I.table(spark, d, "part")
    pins = p.select(F.col("p_brand").alias("model"), F.col("p_type").alias("object"),
                    F.when(F.col("p_type").like("%M%"), "table").otherwise("function").alias("kind")).distinct()
    defs = (p.where("p_type <> 'PROMO'")
            .select(F.col("p_type").alias("object"), F.concat(F.lit("size_"), (F.col("p_size") % 4).cast("string")).alias("column_name"),
                    F.lit("int").alias("data_type")).distinct())
    now = O.fingerprints(defs)
    n = F.regexp_extract("model", "[0-9]+", 0).cast("int")
    rec = (pins.join(now, "object").where(n % 3 != 0)
           .select("model", "object", F.when(n % 3 == 1, "000000000000").otherwise(F.col("fingerprint")).alias("fingerprint")))
    return pins, rec, now


@query("WITH " + PINS + """ SELECT model, count(*) FILTER (kind='table') AS tables, count(*) FILTER (kind='function') AS functions, count(*) FILTER (n.fingerprint IS NULL) AS missing,
  count(*) FILTER (n.fingerprint<>r.fingerprint) AS changed, CASE WHEN count(*) FILTER (n.fingerprint IS NULL)>0 THEN 'broken' WHEN count(*) FILTER (n.fingerprint<>r.fingerprint)>0 THEN 'changed'
  WHEN count(r.fingerprint)=0 THEN 'unverifiable' ELSE 'ok' END AS status FROM pins p LEFT JOIN now_ n USING (object) LEFT JOIN rec r USING (model, object) GROUP BY 1""")
def definition_drift(spark, d):
    return O.drift_report(*pin_frames(spark, d))


@query("WITH " + PINS + " SELECT object, count(DISTINCT model) AS models, string_agg(DISTINCT model, ',' ORDER BY model) AS pinned_by FROM pins GROUP BY 1")
def pins_index(spark, d):
    return O.pins_index(pin_frames(spark, d)[0])


def _hash_sql(text, kind=None):
    on = f" FILTER (kind='{kind}')" if kind else ""
    return f"substr(sha256(coalesce(string_agg(DISTINCT {text}, ',' ORDER BY {text}){on}, '')), 1, 12)"


_DEFINED = "object||'='||coalesce(fingerprint,'-')"


@query("WITH " + PINS + f""" SELECT model, {_hash_sql("kind||':'||object")} AS spec_hash, {_hash_sql(_DEFINED, 'table')} AS table_hash,
  {_hash_sql(_DEFINED, 'function')} AS function_hash FROM pins LEFT JOIN now_ USING (object) GROUP BY 1""")
def spec_hashes(spark, d):
    """The shape that each model pinned, and the definitions of its tables and functions, hashed apart."""
    pins, _, now = pin_frames(spark, d)
    return O.spec_hashes(pins, now)


@query("""WITH defs AS (SELECT unnest(['o_orderkey:bigint','o_custkey:bigint','o_orderstatus:string','o_totalprice:double','o_orderdate:timestamp_ntz','o_orderpriority:string']) AS s)
SELECT 'orders' AS object, substr(sha256(string_agg(s, ',' ORDER BY s)),1,12) AS fingerprint FROM defs WHERE (SELECT count(*) FROM orders)>0""")
def schema_fingerprint(spark, d):
    o = I.table(spark, d, "orders")
    return O.fingerprints(O.definition_rows({"orders": o})).where(o.agg(F.count("o_orderkey")).scalar() > 0)


@query(with_("ev", "imp", "ti", "clock", "vi", "ent") + """SELECT 'events fresh within 2 days' AS check_name, date_diff('day', max(event_ts)::DATE, DATE '2024-01-31')<=2 AS passed, date_diff('day', max(event_ts)::DATE, DATE '2024-01-31')::VARCHAR AS detail FROM ev
UNION ALL SELECT 'impressions not empty', count(*)>0, count(*)::VARCHAR FROM imp
UNION ALL SELECT 'one row per entitlement', count(*)=count(DISTINCT (viewer_id, title_id)), (count(*)-count(DISTINCT (viewer_id, title_id)))::VARCHAR FROM ent
UNION ALL SELECT 'required event columns', true, '' FROM (SELECT 1)""")
def quality_checks(spark, d):
    ev, imp, ent = I.events(spark, d), I.impressions(spark, d), I.entitlements(spark, d)
    age = F.datediff(F.lit("2024-01-31").cast("date"), F.to_date(F.max("event_ts")))
    pair = ["viewer_id", "title_id"]
    dup = I.dealt(ent.select(*pair), I.log_parts(spark, d), *pair).groupBy(*pair).agg(F.count(F.lit(1)).alias("n"))
    need = [c for c in ("event_id", "viewer_id", "title_id", "event_ts") if c not in ev.columns]
    return O.quality_checks([
        ("events fresh within 2 days", ev.agg((age <= 2).alias("passed"), age.alias("detail"))),
        ("impressions not empty", imp.agg((F.count(F.lit(1)) > 0).alias("passed"), F.count(F.lit(1)).alias("detail"))),
        ("one row per entitlement", dup.agg((F.sum(F.col("n") - 1) == 0).alias("passed"), F.sum(F.col("n") - 1).alias("detail"))),
        ("required event columns", spark.range(1).select(F.lit(not need).alias("passed"), F.lit(",".join(need)).alias("detail")))])


@query("""WITH b AS (SELECT event_id//500 AS batch, arg_min(ts, event_id) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1), x AS (SELECT batch, first_ts, lag(first_ts) OVER (ORDER BY batch) AS p FROM b)
SELECT count(*) AS batches, count(*) FILTER (first_ts<p) AS decreases, count(*) FILTER (first_ts<p)=0 AS monotonic FROM x""")
def batch_order(spark, d):
    b = (I.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
         .groupBy(F.floor(F.col("event_id") / 500).alias("batch")).agg(F.min_by("ts", "event_id").alias("first_ts")))
    return O.batch_order(b, "batch", "first_ts")
