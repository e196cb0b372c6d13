"""Base relations of the SQL oracles, written against the raw tables."""

GEN = "['action','adventure','fantasy','sci_fi','sports','drama','romance','slice_of_life']"
GENRES = ["action", "adventure", "fantasy", "sci_fi", "sports", "drama", "romance", "slice_of_life"]
DEV = "['tv','mobile','web','console']"
LOC = "['en-US','pt-BR','ja-JP']"
RAIL_IDS = ("['r_continue','r_new_eps','r_because','r_simulcast','r_top10','r_watchlist','r_trending',"
            "'r_action','r_fantasy','r_scifi','r_romance','r_slice','r_drama','r_sports','r_movies','r_classics']")

CTE = {}

CTE["ev"] = f"""ev AS (
  SELECT event_id, user_id AS viewer_id,
    CAST(regexp_extract(props,'[0-9]+',0) AS BIGINT) AS title_id, ts AS event_ts,
    CASE event_type WHEN 'view' THEN 'impression' WHEN 'purchase' THEN 'complete'
      WHEN 'error' THEN 'skip' ELSE event_type END AS event_type,
    CASE WHEN event_type IN ('purchase','error') THEN CAST(round(value*60) AS BIGINT) ELSE 0 END AS watch_seconds,
    CASE WHEN event_type='view' THEN CASE WHEN value>35 THEN 1 ELSE 0 END END AS played,
    CASE WHEN event_id%2=0 THEN 'home_rail' ELSE 'post_play' END AS surface,
    ({DEV})[user_id%4+1] AS device, ({LOC})[user_id%3+1] AS locale,
    CAST(hour(ts) AS BIGINT) AS hour_of_day, epoch_us(ts)//1000 AS produced_epoch_ms
  FROM events)"""

CTE["ti"] = f"""ti AS (
  SELECT p_partkey AS title_id, p_name AS title_name, p_brand AS franchise,
    ({GEN})[p_size%8+1] AS primary_genre, ({GEN})[p_partkey%8+1] AS secondary_genre,
    (['all','13+','16+','18+'])[p_size%4+1] AS maturity_rating, p_size%4 AS maturity_rank,
    CAST(p_size AS BIGINT) AS episode_count, CAST(1990+p_size%35 AS BIGINT) AS release_year,
    p_size%2=0 AS is_simulcast, p_retailprice AS intrinsic_popularity,
    2.5+(p_partkey%26)/10.0::DOUBLE AS avg_rating
  FROM part)"""

CTE["vi"] = """vi AS (
  SELECT c_custkey AS viewer_id, c_nationkey AS country,
    CASE WHEN c_mktsegment='BUILDING' THEN 'fan' ELSE 'premium' END AS tier,
    (['18-24','25-34','35-44','45+'])[c_custkey%4+1] AS age_bracket,
    CASE WHEN c_custkey%4=0 THEN 1 ELSE 3 END AS max_maturity, c_acctbal AS activity_level
  FROM customer)"""


def unit(expr: str) -> str:
    return f"(('0x'||substr(sha256({expr}),1,12))::BIGINT / pow(16,12))"


CTE["ent"] = f"""pairs AS (
  SELECT o_custkey AS viewer_id, l_partkey AS title_id FROM lineitem JOIN orders ON l_orderkey=o_orderkey
  UNION SELECT user_id, CAST(regexp_extract(props,'[0-9]+',0) AS BIGINT) FROM events),
ent AS (
  SELECT viewer_id, title_id,
    (tier<>'fan' OR {unit("'entitled|'||viewer_id||'|'||title_id")} < 0.85) AND maturity_rank<=max_maturity AS allowed
  FROM pairs JOIN vi USING (viewer_id) JOIN ti USING (title_id))"""

CTE["imp"] = f"""imp AS (
  SELECT o_custkey AS viewer_id,
    ({RAIL_IDS})[(CAST(regexp_extract(p_brand,'[0-9]+',0) AS INT)-1)%16+1] AS rail_id,
    l_orderkey AS session_id, t AS rendered_ts, CAST(l_linenumber AS BIGINT) AS rail_position,
    ({DEV})[o_custkey%4+1] AS device, ({LOC})[o_custkey%3+1] AS locale,
    CAST(hour(t) AS BIGINT) AS hour_of_day, CAST(isodow(t)-1 AS BIGINT) AS day_of_week,
    seen AS was_viewport, CAST(seen AND l_returnflag='R' AS INT) AS engaged,
    CASE WHEN seen AND l_returnflag='R' THEN CAST(floor(l_extendedprice) AS BIGINT) ELSE 0 END AS watch_seconds_from_rail,
    CASE WHEN seen AND l_returnflag='R' THEN CAST(1+l_linenumber%2 AS BIGINT) ELSE 0 END AS titles_played,
    l_extendedprice AS score_a, l_discount AS score_b
  FROM (SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(l_orderkey%36*86400 + l_orderkey*7919%86399 + 1) AS t,
          l_quantity >= 5*l_linenumber AS seen FROM lineitem) l
  JOIN orders ON l_orderkey=o_orderkey JOIN part ON l_partkey=p_partkey)"""

_RAILS = [
    "('r_continue','Continue Watching','continue_watching','',true,1)",
    "('r_new_eps','New Episodes for You','new_release','',true,2)",
    "('r_because','Because You Watched','personalized','',true,3)",
    "('r_simulcast','This Season''s Simulcasts','new_release','',false,4)",
    "('r_top10','Top 10 in Your Country','trending','',false,5)",
    "('r_watchlist','Your Watchlist','watchlist','',true,6)",
    "('r_trending','Trending Now','trending','',false,7)",
    "('r_action','Action & Adventure','genre','action',false,8)",
    "('r_fantasy','Fantasy Worlds','genre','fantasy',false,9)",
    "('r_scifi','Sci-Fi & Mecha','genre','sci_fi',false,10)",
    "('r_romance','Romance','genre','romance',false,11)",
    "('r_slice','Slice of Life','genre','slice_of_life',false,12)",
    "('r_drama','Drama','genre','drama',false,13)",
    "('r_sports','Sports','genre','sports',false,14)",
    "('r_movies','Anime Movies','editorial','',false,15)",
    "('r_classics','Classics & Legends','editorial','',false,16)",
]
CTE["rails"] = ("rails(rail_id, rail_name, rail_type, rail_genre, is_personalized, editorial_rank) AS (VALUES "
                + ", ".join(_RAILS) + ")")

CTE["clock"] = "clock AS (SELECT max(event_ts) AS as_of FROM ev)"

CTE["log"] = f"""log AS (
  SELECT event_id AS request_id, user_id, CAST(regexp_extract(props,'[0-9]+',0) AS BIGINT) AS k, value,
    CASE WHEN event_type='error' THEN 500 ELSE 200 END AS status_code, ts AS request_time,
    CAST(floor(value*10) AS BIGINT) AS execution_duration_ms, 'entity-'||user_id%2 AS served_entity_id,
    CASE WHEN event_id%2=0 THEN 'home_rail' ELSE 'post_play' END AS surface,
    ({DEV})[user_id%4+1] AS device, ({LOC})[user_id%3+1] AS locale, hour(ts) AS hour_of_day
  FROM events)"""

CTE["bench"] = """bench AS (
  SELECT ts AS measured_at, CASE WHEN user_id%2=0 THEN 'in_region' ELSE 'laptop' END AS where_run,
    'endpoint-'||user_id%3 AS endpoint,
    CASE event_type WHEN 'view' THEN 'ramp' WHEN 'click' THEN 'fanout' WHEN 'purchase' THEN 'features_only'
      WHEN 'signup' THEN 'spike_baseline' ELSE 'spike_load' END AS phase,
    CAST(([1,8,16,32,64])[user_id%5+1] AS BIGINT) AS concurrency, 4*(1+user_id%8) AS rows_per_request,
    k+10 AS requests, k+10-k%7 AS ok, value AS p50_ms, value*2 AS p95_ms, value*4 AS p99_ms, 1000-value AS rps,
    'note-'||k AS note, k
  FROM (SELECT *, CAST(regexp_extract(props,'[0-9]+',0) AS BIGINT) AS k FROM events))"""


def r(expr: str, digits: int) -> str:
    """Half-up rounding of the decimal value."""
    return f"CAST(round(CAST({expr} AS DECIMAL(30,12)), {digits}) AS DOUBLE)"


def with_(*names: str, more: str = "") -> str:
    parts = [CTE[n] for n in names]
    if more:
        parts.append(more.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n"


# ------------------------------------------------------------ feature tables
_AFF = ",\n".join(
    f"{r(f'coalesce(sum(s) FILTER (genre={g!r}) OVER w30 * 1.0::DOUBLE / nullif(sum(s) OVER w30,0),0)', 4)} AS genre_affinity_{g}"
    for g in GENRES)

CTE["vf"] = f"""vdays AS (SELECT unnest(generate_series(min(event_ts)::DATE, max(event_ts)::DATE, INTERVAL 1 DAY))::DATE AS day FROM ev),
vobs AS (
  SELECT viewer_id, event_ts::DATE AS day, watch_seconds AS s, event_type AS et, primary_genre AS genre,
    CAST(round(sin(hour(event_ts)*(2.0*3.141592653589793/24.0)::DOUBLE)*1000000000) AS BIGINT) AS hs,
    CAST(round(cos(hour(event_ts)*(2.0*3.141592653589793/24.0)::DOUBLE)*1000000000) AS BIGINT) AS hc
  FROM ev LEFT JOIN ti USING (title_id) WHERE watch_seconds>0),
vagg AS (
  SELECT g.viewer_id, g.day,
    coalesce(sum(s) FILTER (o.day > g.day-7),0) AS s7, count(o.day) FILTER (o.day > g.day-7) AS p7,
    count(*) FILTER (o.day > g.day-7 AND et='skip') AS k7,
    coalesce(sum(s),0) AS s30, count(o.day) AS p30, count(*) FILTER (et='complete') AS c30,
    coalesce(sum(hs),0)::DOUBLE AS sn, coalesce(sum(hc),0)::DOUBLE AS cs,
    {", ".join(f"coalesce(sum(s) FILTER (genre={g!r}),0) AS g_{g}" for g in GENRES)}
  FROM (SELECT * FROM (SELECT DISTINCT viewer_id FROM vobs), vdays) g
  LEFT JOIN vobs o ON o.viewer_id=g.viewer_id AND o.day BETWEEN g.day-29 AND g.day
  GROUP BY ALL),
vf AS (
  SELECT viewer_id, day + INTERVAL 1 DAY AS ts, {r('s7/60.0::DOUBLE', 2)} AS minutes_watched_7d, p7 AS plays_7d,
    {r('coalesce(c30/nullif(p30,0),0)', 4)} AS completion_rate_30d,
    {r('coalesce(s30/nullif(p30*60,0),0)', 2)} AS avg_watch_minutes_30d, k7 AS skips_7d,
    {r('CASE WHEN p30>0 THEN (atan2(sn,cs)*(24.0/(2.0*3.141592653589793))::DOUBLE + 24.0::DOUBLE) % 24.0::DOUBLE ELSE 0 END', 3)} AS typical_watch_hour,
    {r('CASE WHEN p30>0 THEN sqrt(sn*sn+cs*cs)/1000000000/p30 ELSE 0 END', 4)} AS hour_concentration,
    {", ".join(r(f"coalesce(g_{g}/nullif(s30,0),0)", 4) + f" AS genre_affinity_{g}" for g in GENRES)}
  FROM vagg)"""

_TCOLS = f"""avg_rating, datediff('day', make_date(release_year::INT,7,1), AS_OF::DATE) AS days_since_release,
  CAST(maturity_rank AS BIGINT) AS maturity_rank, CAST(is_simulcast AS BIGINT) AS is_simulcast,
  {r('ln(1+episode_count)', 4)} AS episodes_log,
  {", ".join(f"CAST(primary_genre={g!r} AS BIGINT) AS genre_{g}" for g in GENRES)}"""

CTE["tf"] = f"""tplays AS (SELECT title_id, count(*) AS p FROM ev, clock WHERE event_type IN ('complete','skip')
    AND event_ts > as_of - INTERVAL 30 DAY AND event_ts <= as_of GROUP BY 1),
tf AS (SELECT title_id, {r('coalesce(p,0)/greatest((SELECT max(p) FROM tplays),1)', 4)} AS popularity_30d,
    coalesce(p,0) AS plays_30d, {_TCOLS.replace('AS_OF', '(SELECT as_of FROM clock)')}
  FROM ti LEFT JOIN tplays USING (title_id))"""

CTE["tfts"] = f"""tdays AS (SELECT unnest(generate_series(min(event_ts)::DATE, max(event_ts)::DATE, INTERVAL 1 DAY)) + INTERVAL 1 DAY AS ts FROM ev),
tcnt AS (SELECT d.ts, title_id, count(*) AS p FROM tdays d JOIN ev ON event_ts > d.ts - INTERVAL 30 DAY AND event_ts <= d.ts
    WHERE event_type IN ('complete','skip') GROUP BY ALL),
tmax AS (SELECT ts, max(p) AS top FROM tcnt GROUP BY 1),
tfts AS (SELECT title_id, d.ts, {r('coalesce(p,0)/greatest(coalesce(top,0),1)', 4)} AS popularity_30d,
    coalesce(p,0) AS plays_30d, {_TCOLS.replace('AS_OF', 'd.ts')}
  FROM ti CROSS JOIN tdays d LEFT JOIN tcnt c USING (title_id, ts) LEFT JOIN tmax m ON m.ts=d.ts)"""

_RB = """{minutes} AS minutes_watched_24h,
    count(*) FILTER (event_type='skip') AS skips_24h,
    count(DISTINCT title_id) FILTER (watch_seconds>0) AS active_titles_24h,
    coalesce(arg_max(primary_genre, (event_ts, event_id)) FILTER (watch_seconds>0), 'none') AS last_primary_genre,
    coalesce(max(CAST(floor(epoch(event_ts)) AS BIGINT)) FILTER (watch_seconds>0), 0) AS last_event_epoch_s""".format(
        minutes=r("coalesce(sum(watch_seconds),0)/60.0::DOUBLE", 2))

CTE["rb"] = f"""rb AS (SELECT v.viewer_id, {_RB}
  FROM (SELECT DISTINCT viewer_id FROM ev) v LEFT JOIN (
    SELECT * FROM ev LEFT JOIN ti USING (title_id), clock
    WHERE event_ts > as_of - INTERVAL 24 HOUR AND event_ts <= as_of) e USING (viewer_id) GROUP BY 1)"""

CTE["rbts"] = f"""rdays AS (SELECT unnest(generate_series(min(event_ts)::DATE, max(event_ts)::DATE, INTERVAL 1 DAY)) + INTERVAL 1 DAY AS ts FROM ev),
rbts AS (SELECT g.viewer_id, g.ts, {_RB}
  FROM (SELECT * FROM (SELECT DISTINCT viewer_id FROM ev), rdays) g LEFT JOIN (
    SELECT * FROM ev LEFT JOIN ti USING (title_id)) e
    ON e.viewer_id=g.viewer_id AND event_ts > g.ts - INTERVAL 1 DAY AND event_ts <= g.ts GROUP BY 1,2)"""

CTE["prop"] = f"""prop AS (SELECT rail_position, n AS impressions, {r('p', 4)} AS p_view, {r('least(1.0::DOUBLE/p,10.0)', 4)} AS ips_weight
  FROM (SELECT rail_position, count(*) AS n, greatest(count(*) FILTER (was_viewport)/count(*),0.02::DOUBLE) AS p FROM imp GROUP BY 1))"""

CTE["iclock"] = "iclock AS (SELECT max(rendered_ts) AS as_of FROM imp)"

CTE["aud"] = """aud AS (SELECT rail_id, count(*) AS rail_impressions_30d, CAST(sum(engaged) AS BIGINT) AS rail_clicks_30d,
    CAST(sum(watch_seconds_from_rail) AS BIGINT) AS rail_watch_seconds_30d, CAST(sum(titles_played) AS BIGINT) AS rail_titles_played_30d
  FROM imp, iclock WHERE rendered_ts > as_of - INTERVAL 30 DAY AND rendered_ts <= as_of GROUP BY 1)"""

CTE["rtm"] = """rtm AS (SELECT rail_id, title_id, CAST(rn AS INT) AS rank_in_rail FROM (
    SELECT rail_id, title_id, row_number() OVER (PARTITION BY rail_id ORDER BY intrinsic_popularity DESC, title_id) AS rn
    FROM rails JOIN ti ON CASE WHEN rail_type='genre' THEN primary_genre=rail_genre OR secondary_genre=rail_genre
      WHEN rail_id='r_simulcast' THEN is_simulcast AND release_year >= year((SELECT as_of FROM clock))-1
      WHEN rail_id IN ('r_trending','r_top10') THEN true
      WHEN rail_id='r_movies' THEN episode_count<=2
      WHEN rail_id='r_classics' THEN release_year<=2012 ELSE false END) WHERE rn<=20)"""

_RCOLS = f"""{r('coalesce(c/nullif(i,0),0)', 5)} AS rail_ctr_30d, i AS rail_impressions_30d, c AS rail_clicks_30d,
    {r('coalesce(s/nullif(c*60,0),0)', 3)} AS rail_avg_watch_minutes_30d, coalesce(cn,0) AS rail_titles_available,
    {r('coalesce(cp,0)', 4)} AS rail_avg_popularity, {r('coalesce(cr,0)', 4)} AS rail_avg_rating,
    {r('coalesce(cd,0)', 4)} AS rail_content_age_days, {r('coalesce(cs,0)', 4)} AS rail_simulcast_share,
    CAST(is_personalized AS BIGINT) AS rail_is_personalized,
    list_position(['continue_watching','new_release','personalized','trending','watchlist','genre','editorial'], rail_type)-1 AS rail_type_idx,
    coalesce(list_position({GEN}, rail_genre),0)-1 AS rail_genre_idx, CAST(editorial_rank AS BIGINT) AS rail_editorial_rank"""
_CONTENT = ("count(title_id) AS cn, avg(popularity_30d) AS cp, avg(avg_rating) AS cr, "
            "avg(days_since_release) AS cd, avg(is_simulcast) AS cs")

CTE["rf"] = f"""rf AS (SELECT rail_id, {_RCOLS} FROM (
    SELECT rails.*, coalesce(rail_impressions_30d,0) AS i, coalesce(rail_clicks_30d,0) AS c,
      coalesce(rail_watch_seconds_30d,0) AS s, cn, cp, cr, cd, cs
    FROM rails LEFT JOIN aud USING (rail_id)
    LEFT JOIN (SELECT rail_id, {_CONTENT} FROM rtm LEFT JOIN tf USING (title_id) GROUP BY 1) USING (rail_id)))"""

CTE["rfts"] = f"""idays AS (SELECT DISTINCT rendered_ts::DATE + INTERVAL 1 DAY AS ts FROM imp),
raud AS (SELECT d.ts, rail_id, count(*) AS i, CAST(sum(engaged) AS BIGINT) AS c, CAST(sum(watch_seconds_from_rail) AS BIGINT) AS s
  FROM idays d JOIN imp ON rendered_ts > d.ts - INTERVAL 30 DAY AND rendered_ts <= d.ts GROUP BY ALL),
rcon AS (SELECT rail_id, ts AS cts, {_CONTENT} FROM rtm JOIN tfts USING (title_id) GROUP BY ALL),
rpick AS (SELECT ts, coalesce((SELECT max(cts) FROM rcon WHERE cts<=ts), (SELECT min(cts) FROM rcon)) AS cts FROM idays),
rfts AS (SELECT rail_id, ts, {_RCOLS} FROM (
    SELECT r.*, p.ts, coalesce(i,0) AS i, coalesce(c,0) AS c, coalesce(s,0) AS s, cn, cp, cr, cd, cs
    FROM rails r CROSS JOIN rpick p LEFT JOIN raud a ON a.rail_id=r.rail_id AND a.ts=p.ts
    LEFT JOIN rcon k ON k.rail_id=r.rail_id AND k.cts=p.cts))"""

CTE["vrf"] = f"""xdays AS (SELECT DISTINCT rendered_ts::DATE AS day FROM imp),
xd AS (SELECT viewer_id, rail_id, rendered_ts::DATE AS day, count(*) AS i, sum(engaged) AS c, sum(rail_position) AS p,
    sum(watch_seconds_from_rail) AS s, max(CASE WHEN engaged=1 THEN CAST(epoch(rendered_ts) AS BIGINT) END) AS lc FROM imp GROUP BY ALL),
xg AS (SELECT viewer_id, rail_id, day, i, c, p, s, lc FROM (SELECT DISTINCT viewer_id, rail_id FROM xd) CROSS JOIN xdays
    LEFT JOIN xd USING (viewer_id, rail_id, day)),
xr AS (SELECT viewer_id, rail_id, day, sum(i) OVER w30 AS i, sum(c) OVER w30 AS c, sum(c) OVER w7 AS c7, sum(p) OVER w30 AS p,
    sum(s) OVER w30 AS s, max(lc) OVER wall AS lc FROM xg
  WINDOW w30 AS (PARTITION BY viewer_id, rail_id ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW),
    w7 AS (PARTITION BY viewer_id, rail_id ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW),
    wall AS (PARTITION BY viewer_id, rail_id ORDER BY day)),
vrf AS (SELECT viewer_id, rail_id, day + INTERVAL 1 DAY AS ts, coalesce(i,0)::DOUBLE AS vr_impressions_30d,
    coalesce(c,0)::DOUBLE AS vr_clicks_30d, {r('coalesce(c/nullif(i,0),0)', 5)} AS vr_ctr_30d, coalesce(c7,0)::DOUBLE AS vr_clicks_7d,
    {r('coalesce(s,0)/60.0::DOUBLE', 3)} AS vr_watch_minutes_30d, {r('coalesce(p/nullif(i,0),0)', 3)} AS vr_avg_position_30d,
    coalesce(lc,0)::DOUBLE AS vr_last_click_epoch_s FROM xr)"""
