"""Table, merge and change-feed queries."""

from pyspark.sql import Window, functions as F

from ..constants import RAILS
from ..plans import ranking as K
from ..session import scratch_dir
from ..sources import changes as C, inputs as I
from ..sources.tables import BucketedTable, export_training_set, read_table, write_table
from .base_sql import r, with_
from .ranking import SCORE, SCORED, STATE, scored_pairs
from .registry import query
from .training import rail_label_frame

#: Buckets of the queries' keyed tables; a large table takes one for every few hundred MB.
BUCKETS = 16
CUT = "2024-01-16 00:00:00"
HALF = """a AS (SELECT viewer_id, count(*) AS events, CAST(sum(watch_seconds) AS BIGINT) AS seconds FROM ev WHERE event_ts < TIMESTAMP '2024-01-16' GROUP BY 1),
b AS (SELECT viewer_id, count(*) AS events, CAST(sum(watch_seconds) AS BIGINT) AS seconds FROM ev WHERE event_ts >= TIMESTAMP '2024-01-16' AND watch_seconds>0 GROUP BY 1)"""


def halves(spark, d):
    ev = I.events(spark, d)
    agg = lambda x: x.groupBy("viewer_id").agg(F.count(F.lit(1)).alias("events"), F.sum("watch_seconds").alias("seconds"))
    cut = F.lit(CUT).cast("timestamp")
    return (agg(ev.where(F.col("event_ts") < cut)),
            agg(ev.where((F.col("event_ts") >= cut) & (F.col("watch_seconds") > 0))))


@query(with_("ev", more=HALF) + "SELECT * FROM b UNION ALL SELECT * FROM a WHERE viewer_id NOT IN (SELECT viewer_id FROM b)")
def upsert_merge(spark, d):
    a, b = halves(spark, d)
    t = BucketedTable(spark, scratch_dir(spark, "upsert"), ["viewer_id"], buckets=BUCKETS)
    t.upsert(a)
    t.upsert(b)
    return t.read()


DIFF = """SELECT viewer_id, coalesce(b.events,a.events) AS events, coalesce(b.seconds,a.seconds) AS seconds,
  CASE WHEN a.viewer_id IS NULL THEN 'insert' WHEN b.viewer_id IS NULL THEN 'delete' ELSE 'update_postimage' END AS change_type
  FROM a FULL OUTER JOIN b USING (viewer_id) WHERE a.events IS DISTINCT FROM b.events OR a.seconds IS DISTINCT FROM b.seconds"""


@query(with_("ev", more=HALF) + DIFF)
def change_feed_diff(spark, d):
    a, b = halves(spark, d)
    return C.diff_rows(a, b, ["viewer_id"])


@query(with_("ev", more=HALF) + f"SELECT change_type, count(*) AS keys FROM ({DIFF}) GROUP BY 1")
def change_feed_since_version(spark, d):
    a, b = halves(spark, d)
    t = BucketedTable(spark, scratch_dir(spark, "feed"), ["viewer_id"], buckets=BUCKETS)
    t.create(a)
    first = t.latest()
    t.overwrite(b)
    return t.changes(first).groupBy("change_type").agg(F.count(F.lit(1)).alias("keys"))


@query(with_(*SCORED, more=STATE + ",\n" + SCORE) + """, k AS (SELECT DISTINCT viewer_id FROM ev WHERE event_type='complete')
SELECT viewer_id, rail_id, rail_rank, CASE WHEN viewer_id IN (SELECT viewer_id FROM k) THEN 'v2' ELSE 'v1' END AS model_version
FROM rk WHERE context = CASE WHEN viewer_id IN (SELECT viewer_id FROM k) THEN '21 mobile' ELSE '21 tv' END""")
def replace_where(spark, d):
    keys = I.events(spark, d).where("event_type = 'complete'").select("viewer_id").distinct()
    s = scored_pairs(spark, d, [("21 tv", "tv", 21)]).unionByName(
        scored_pairs(spark, d, [("21 mobile", "mobile", 21)], only=keys))
    one = lambda c, v: (K.rank_rails(s.where(F.col("context") == c))
                        .select("viewer_id", "rail_id", "rail_rank", F.lit(v).alias("model_version")))
    t = BucketedTable(spark, scratch_dir(spark, "replace"), ["viewer_id", "rail_id"], ["viewer_id"], BUCKETS)
    t.create(one("21 tv", "v1"))
    t.replace(keys, one("21 mobile", "v2"), ["viewer_id"])
    return t.read()


@query(with_("ev", more=HALF) + """SELECT 'incremental' AS mode, 'changed viewers only' AS reason, n AS viewers_to_rescore
  FROM (SELECT count(*) AS n FROM (""" + DIFF + "))")
def incremental_decision(spark, d):
    a, b = halves(spark, d)
    ch = C.diff_rows(a, b, ["viewer_id"]).select(F.lit("viewer_features_ts").alias("table_name"), "viewer_id")
    sig = F.lit(C.signature(model="ranker", device="tv", hour=21))
    return C.rescoring_decision(ch, sig, sig)


@query(with_("ev", "imp", more=HALF) + """SELECT CASE WHEN n > 0 THEN 'full' ELSE 'incremental' END AS mode,
  CASE WHEN n > 0 THEN 'rail-grain change' ELSE 'changed viewers only' END AS reason, CASE WHEN n = 0 THEN v END AS viewers_to_rescore
  FROM (SELECT count(DISTINCT rail_id) AS n FROM imp WHERE rendered_ts >= TIMESTAMP '2024-01-20'),
       (SELECT count(*) AS v FROM (""" + DIFF + "))")
def incremental_decision_rail_grain(spark, d):
    a, b = halves(spark, d)
    ch = C.diff_rows(a, b, ["viewer_id"]).select(F.lit("viewer_features_ts").alias("table_name"), "viewer_id")
    # Every rail rendered since the earlier run has new sums.
    rail = (I.impressions(spark, d).where(F.col("rendered_ts") >= F.lit("2024-01-20").cast("timestamp"))
            .select("rail_id").distinct()
            .select(F.lit("rail_features_ts").alias("table_name"), F.lit(None).cast("bigint").alias("viewer_id")))
    sig = F.lit(C.signature(model="ranker"))
    return C.rescoring_decision(ch.unionByName(rail), sig, sig)


@query("""SELECT user_id AS table_id, coalesce(max(event_id) FILTER (event_type NOT IN ('error','signup')), max(event_id)) AS version FROM events GROUP BY 1""")
def latest_data_version(spark, d):
    e = I.table(spark, d, "events")
    op = (F.when(F.col("event_type") == "error", "OPTIMIZE").when(F.col("event_type") == "signup", "vacuum start")
          .otherwise("MERGE"))
    h = e.select(F.col("user_id").alias("table_id"), F.col("event_id").alias("version"), op.alias("operation"))
    return C.latest_data_version(h, ["table_id"])


@query(with_("ev") + """SELECT 'event_type' AS column_name, 'string' AS data_type, 'removed' AS change, count(event_type) AS non_null FROM ev
UNION ALL SELECT 'watch_seconds', 'bigint', 'removed', count(*) FILTER (event_type <> 'skip') FROM ev
UNION ALL SELECT 'watch_seconds', 'double', 'added', count(*) FILTER (event_type <> 'skip') FROM ev
UNION ALL SELECT 'played', 'int', 'added', count(played) FROM ev""")
def schema_difference(spark, d):
    """Columns added and removed between two stored versions of a table, with the values they hold there."""
    ev = I.events(spark, d).withColumn("watch_seconds", F.when(F.col("event_type") != "skip", F.col("watch_seconds")))
    versions = {"removed": ev.select("event_id", "event_type", "watch_seconds"),
                "added": ev.select("event_id", F.col("watch_seconds").cast("double").alias("watch_seconds"), "played")}
    stored = {}
    for change, df in versions.items():
        path = scratch_dir(spark, f"version-{change}")
        write_table(df, path)
        stored[change] = read_table(spark, path)
    counts = None
    for change, t in stored.items():
        row = t.agg(*[F.count(c).alias(c) for c in t.columns]).unpivot([], t.columns, "column_name", "non_null").withColumn(
            "change", F.lit(change))
        counts = row if counts is None else counts.unionByName(row)
    return C.schema_difference(stored["removed"], stored["added"]).join(counts, ["column_name", "change"]).select(
        "column_name", "data_type", "change", "non_null")


_FORMULA = """(SELECT viewer_id, rail_id, row_number() OVER (PARTITION BY viewer_id ORDER BY (seconds % (17 + editorial_rank)) / events DESC, rail_id) AS rail_rank
  FROM b, rails)"""


def _ranked_by_features(spark, features):
    """Every catalog rail of each viewer, ranked by a fixed formula over the viewer's features."""
    catalog = F.array(*[F.struct(F.lit(x[0]).alias("rail_id"), F.lit(x[5]).alias("editorial_rank")) for x in RAILS])
    s = features.select("viewer_id", "events", "seconds", F.explode(catalog).alias("r")).select(
        "viewer_id", "r.rail_id", ((F.col("seconds") % (17 + F.col("r.editorial_rank"))) / F.col("events")).alias("score"))
    w = Window.partitionBy("viewer_id").orderBy(F.desc("score"), "rail_id")
    return s.select("viewer_id", "rail_id", F.row_number().over(w).alias("rail_rank"))


def incremental_run(spark, d):
    """A run over old features, then one that rescores only what changed; the table and both states."""
    a, b = halves(spark, d)
    t = BucketedTable(spark, scratch_dir(spark, "rescore"), ["viewer_id", "rail_id"], ["viewer_id"], BUCKETS)
    states = scratch_dir(spark, "state")
    sig = C.signature(model="ranker", device="tv", hour=21)
    none = spark.createDataFrame([], "table_name string, viewer_id bigint")
    changed = C.diff_rows(a, b, ["viewer_id"]).select(F.lit("viewer_features_ts").alias("table_name"), "viewer_id")
    previous = F.lit(None).cast("string")
    for features, changes in ((a, none), (b, changed)):
        score = lambda keys: _ranked_by_features(
            spark, features if keys is None else features.join(keys, "viewer_id", "left_semi"))
        state = C.rescore(t, changes, previous, sig, score)
        write_table(state, states, "append")
        previous = F.lit(sig)
    return t, read_table(spark, states)


@query(with_("ev", "rails", more=HALF) + "SELECT * FROM " + _FORMULA)
def incremental_rescore(spark, d):
    """Changed viewers rescored and patched in: the table equals a full run on the new features."""
    return incremental_run(spark, d)[0].read()


@query(with_("ev", "rails", more=HALF) + f"""SELECT 'full' AS mode, 'no previous state' AS reason, (SELECT count(*) FROM a, rails) AS rows_scored, 'ranker' AS signature_model
UNION ALL SELECT 'incremental', 'changed viewers only', (SELECT count(*) FROM b JOIN ({DIFF}) c USING (viewer_id), rails), 'ranker'""")
def run_state_json(spark, d):
    """The state rows that the two runs left behind."""
    return incremental_run(spark, d)[1].select(
        "mode", "reason", "rows_scored", F.get_json_object("signature", "$.model").alias("signature_model"))


@query(with_("ev") + "SELECT event_ts::DATE AS day, count(*) AS events, count(*) FILTER (event_type='skip') AS late_column FROM ev GROUP BY 1")
def partitioned_append_roundtrip(spark, d):
    """Full write partitioned by day, an append with one more column, and a merged-schema read."""
    ev = I.events(spark, d).select("event_id", "event_type", F.to_date("event_ts").alias("day"))
    path = scratch_dir(spark, "log")
    write_table(ev.where("event_type <> 'skip'"), path, "overwrite", ["day"])
    write_table(ev.where("event_type = 'skip'").withColumn("late_column", F.lit(1)), path, "append", ["day"])
    t = read_table(spark, path, merge_schema=True)
    return t.groupBy("day").agg(F.count(F.lit(1)).alias("events"), F.count("late_column").alias("late_column"))


@query(with_("imp") + f"""SELECT engaged, count(*) AS rows, {r('avg(p)', 6)} AS mean_position FROM (SELECT viewer_id, rail_id, session_id, max(engaged) AS engaged, min(rail_position) AS p FROM imp GROUP BY 1,2,3) GROUP BY 1""")
def exported_training_set(spark, d):
    key = ["viewer_id", "rail_id", "session_id"]
    # The rows come from the labels, what is attached from the raw impressions.
    n = I.log_parts(spark, d)
    rows = I.dealt(rail_label_frame(spark, d).groupBy(*key).agg(F.max("engaged").alias("engaged")), n, *key)
    side = I.dealt(I.impressions(spark, d).groupBy(*key).agg(F.min("rail_position").alias("p")), n, *key)
    path = export_training_set(rows, scratch_dir(spark, "export"), side, key)
    return read_table(spark, path).groupBy("engaged").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("p"), 6).alias("mean_position"))


@query(with_("ev", "ti", "vi", "imp") + """SELECT 'events' AS table_name, count(*) AS rows, 'rail ranker, watch-next ranker' AS read_by, true AS shared FROM ev
UNION ALL SELECT 'titles', count(*), 'rail ranker, watch-next ranker', true FROM ti UNION ALL SELECT 'viewers', count(*), '-', false FROM vi
UNION ALL SELECT 'impressions', count(*), 'rail ranker', false FROM imp""")
def table_catalogue(spark, d):
    readers = {"events": ["rail ranker", "watch-next ranker"], "titles": ["rail ranker", "watch-next ranker"],
               "impressions": ["rail ranker"]}
    frames = {"events": I.events(spark, d), "titles": I.titles(spark, d), "viewers": I.viewers(spark, d),
              "impressions": I.impressions(spark, d)}
    out = None
    for name, df in frames.items():
        who = readers.get(name, ["-"])
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(", ".join(who)).alias("read_by"),
            F.lit(len(who) > 1).alias("shared"))
        out = row if out is None else out.unionByName(row)
    return out


@query(with_("ev", more=HALF) + """SELECT viewer_id FROM a FULL OUTER JOIN b USING (viewer_id) WHERE a.seconds IS DISTINCT FROM b.seconds OR a.events IS DISTINCT FROM b.events
UNION SELECT viewer_id FROM ev WHERE event_type='skip' AND event_ts >= TIMESTAMP '2024-01-29'""")
def changed_keys_across_tables(spark, d):
    a, b = halves(spark, d)
    skips = I.events(spark, d).where("event_type = 'skip'").where(F.col("event_ts") >= F.lit("2024-01-29").cast("timestamp"))
    return C.diff_rows(a, b, ["viewer_id"]).select("viewer_id").union(skips.select("viewer_id")).distinct()
