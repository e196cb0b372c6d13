"""The given parquet tables seen as the catalogue, event log and logs the operators expect.

Every view covers its whole base table: values are derived, rows are never dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..constants import GENRES, MATURITY_RANK, RAILS
from ..functions.keys import stable_unit

DEVICES = ["tv", "mobile", "web", "console"]
LOCALES = ["en-US", "pt-BR", "ja-JP"]
AGE_BRACKETS = ["18-24", "25-34", "35-44", "45+"]
MATURITY_LABELS = list(MATURITY_RANK)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of the log that one task joins, groups or orders, about.
TASK_ROWS = 300_000


def log_parts(spark: SparkSession, sf_dir: str) -> int:
    """Into how many parts the log is dealt, so that a task's memory does not grow with it; 0 while
    it is small enough for Spark's own choice. Row counts come from file footers."""
    rows = sum(table(spark, sf_dir, t).count() for t in ("lineitem", "events"))
    n = -(-rows // TASK_ROWS)
    return n if n > spark.sparkContext.defaultParallelism else 0


def dealt(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``df`` in that many parts by its keys; groupings, windows and joins on the same keys follow without a shuffle."""
    return df.repartition(parts, *keys) if parts else df


def merged(df: DataFrame, parts: int) -> DataFrame:
    """A lookup table for a join by shuffle once the log is dealt: it grows with the log, and a broadcast
    would stand whole in the driver and in every task."""
    return df.hint("merge") if parts else df


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement log: one row per event, watch time only on completes and skips."""
    e = table(spark, sf_dir, "events")
    return shape_events(e)


def shape_events(e: DataFrame) -> DataFrame:
    t, v = F.col("event_type"), F.col("value")
    kind = (F.when(t == "view", "impression").when(t == "purchase", "complete")
            .when(t == "error", "skip").otherwise(t))
    ts = F.col("ts").cast("timestamp")
    return e.select(
        "event_id",
        F.col("user_id").alias("viewer_id"),
        F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("title_id"),
        ts.alias("event_ts"),
        kind.alias("event_type"),
        F.when(t.isin("purchase", "error"), F.round(v * 60).cast("bigint"))
         .otherwise(F.lit(0).cast("bigint")).alias("watch_seconds"),
        F.when(t == "view", F.when(v > 35, 1).otherwise(0)).alias("played"),
        F.when(F.col("event_id") % 2 == 0, "home_rail").otherwise("post_play").alias("surface"),
        pick(DEVICES, F.col("user_id") % 4).alias("device"),
        pick(LOCALES, F.col("user_id") % 3).alias("locale"),
        F.hour(ts).cast("bigint").alias("hour_of_day"),
        F.unix_millis(ts).alias("produced_epoch_ms"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("title_id"),
        F.col("p_name").alias("title_name"),
        F.col("p_brand").alias("franchise"),
        pick(GENRES, F.col("p_size") % 8).alias("primary_genre"),
        pick(GENRES, F.col("p_partkey") % 8).alias("secondary_genre"),
        pick(MATURITY_LABELS, F.col("p_size") % 4).alias("maturity_rating"),
        F.col("p_size").cast("bigint").alias("episode_count"),
        (F.lit(1990) + F.col("p_size") % 35).cast("bigint").alias("release_year"),
        (F.col("p_size") % 2 == 0).alias("is_simulcast"),
        F.col("p_retailprice").alias("intrinsic_popularity"),
        (F.lit(2.5) + (F.col("p_partkey") % 26) / F.lit(10.0)).alias("avg_rating"),
    )


def viewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("viewer_id"),
        F.col("c_nationkey").alias("country"),
        F.when(F.col("c_mktsegment") == "BUILDING", "fan").otherwise("premium").alias("tier"),
        pick(AGE_BRACKETS, F.col("c_custkey") % 4).alias("age_bracket"),
        F.when(F.col("c_custkey") % 4 == 0, 1).otherwise(3).alias("max_maturity"),
        F.col("c_acctbal").alias("activity_level"),
    )


def licensed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(viewer, title) pairs in the catalogue contract: bought titles and touched titles."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    n = log_parts(spark, sf_dir)
    bought = (dealt(li, n, "l_orderkey").join(merged(dealt(od, n, "o_orderkey"), n), F.col("l_orderkey") == F.col("o_orderkey"))
              .select(F.col("o_custkey").alias("viewer_id"), F.col("l_partkey").alias("title_id")))
    touched = events(spark, sf_dir).select("viewer_id", "title_id")
    return dealt(bought.unionByName(touched), n, "viewer_id", "title_id").distinct()


def entitlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entitlement rule over licensed pairs: maturity above the viewer's limit is never
    allowed; the fan tier misses a stable 15 % of the rest."""
    pairs, n = licensed_pairs(spark, sf_dir), log_parts(spark, sf_dir)
    v = merged(viewers(spark, sf_dir).select("viewer_id", "tier", "max_maturity"), n)
    t = merged(titles(spark, sf_dir).select("title_id", "maturity_rating"), n)
    rank = maturity_rank(F.col("maturity_rating"))
    return (pairs.join(v, "viewer_id").join(t, "title_id")
            .select("viewer_id", "title_id",
                    entitled(F.col("tier"), rank, F.col("max_maturity"),
                             F.col("viewer_id"), F.col("title_id")).alias("allowed")))


def entitled(tier: Column, maturity: Column, limit: Column, viewer: Column, title: Column) -> Column:
    in_tier = (tier != "fan") | (stable_unit(F.lit("entitled"), viewer, title) < 0.85)
    return in_tier & (maturity <= limit)


def maturity_rank(label: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in MATURITY_RANK.items() for x in kv])
    return F.element_at(m, label)


def rails(spark: SparkSession) -> DataFrame:
    """The rail catalog: a fixed 16-row relation."""
    return spark.createDataFrame(
        [r + (20,) for r in RAILS],
        "rail_id string, rail_name string, rail_type string, rail_genre string, "
        "is_personalized boolean, editorial_rank bigint, max_titles bigint")


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Homepage log: one row per rendered rail; a session is an order. A large log is dealt by session."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # By shuffle: the catalogue grows with the log, and Spark would judge it by its compressed file.
    brand = F.regexp_extract("p_brand", "[0-9]+", 0).cast("int")
    pt = table(spark, sf_dir, "part").select("p_partkey", brand.alias("brand")).hint("merge")
    key = F.col("l_orderkey")
    start = F.lit(1704067200)  # 2024-01-01 00:00:00 UTC
    rendered = F.timestamp_seconds(start + key % 36 * 86400 + key * 7919 % 86399 + 1)
    seen = F.col("l_quantity") >= 5 * F.col("l_linenumber")
    hit = (seen & (F.col("l_returnflag") == "R")).cast("int")
    n = log_parts(spark, sf_dir)
    # Sessions last, so that what is grouped or ranked in a session needs no further shuffle.
    shown = dealt(li.join(pt, li.l_partkey == pt.p_partkey), n, "l_orderkey")
    return (shown.join(merged(dealt(od, n, "o_orderkey"), n), key == F.col("o_orderkey"))
            .select(
                F.col("o_custkey").alias("viewer_id"),
                pick([r[0] for r in RAILS], (F.col("brand") - 1) % 16).alias("rail_id"),
                key.alias("session_id"),
                rendered.alias("rendered_ts"),
                F.col("l_linenumber").cast("bigint").alias("rail_position"),
                pick(DEVICES, F.col("o_custkey") % 4).alias("device"),
                pick(LOCALES, F.col("o_custkey") % 3).alias("locale"),
                F.hour(rendered).cast("bigint").alias("hour_of_day"),
                F.weekday(rendered).cast("bigint").alias("day_of_week"),
                seen.alias("was_viewport"),
                hit.alias("engaged"),
                (hit * F.floor("l_extendedprice")).cast("bigint").alias("watch_seconds_from_rail"),
                (hit * (1 + F.col("l_linenumber") % 2)).cast("bigint").alias("titles_played"),
                F.col("l_extendedprice").alias("score_a"),
                F.col("l_discount").alias("score_b"),
            ))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving request log with JSON payload columns: one request per event, two rows each."""
    e = table(spark, sf_dir, "events").withColumn(
        "title", F.regexp_extract("props", "[0-9]+", 0).cast("bigint"))
    rec = lambda shift: F.struct(
        F.col("user_id").cast("string").alias("viewer_id"),
        (F.col("title") + shift).cast("string").alias("title_id"),
        F.when(F.col("event_id") % 2 == 0, "home_rail").otherwise("post_play").alias("surface"),
        pick(DEVICES, F.col("user_id") % 4).alias("device"),
        pick(LOCALES, F.col("user_id") % 3).alias("locale"),
        F.hour(F.col("ts").cast("timestamp")).alias("hour_of_day"))
    return e.select(
        F.col("event_id").alias("request_id"),
        F.to_json(F.struct(F.array(rec(0), rec(1)).alias("dataframe_records"))).alias("request"),
        F.to_json(F.struct(F.array(F.col("value") / 100, F.col("value") / 200)
                           .alias("predictions"))).alias("response"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        F.col("ts").cast("timestamp").alias("request_time"),
        F.floor(F.col("value") * 10).cast("bigint").alias("execution_duration_ms"),
        F.concat(F.lit("entity-"), (F.col("user_id") % 2).cast("string")).alias("served_entity_id"),
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_quantity")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return li.join(pt, li.l_partkey == pt.p_partkey).select(
        F.col("p_type").alias("sku_name"),
        F.col("l_shipdate").cast("timestamp").alias("usage_end_time"),
        F.to_date("l_shipdate").alias("usage_date"),
        F.col("l_quantity").alias("usage_quantity"))


def list_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price row per SKU and calendar year; the last year is open-ended."""
    sku = table(spark, sf_dir, "part").select(F.col("p_type").alias("sku_name")).distinct()
    y = F.col("year")
    return (sku.withColumn("year", F.explode(F.sequence(F.lit(1990), F.lit(2000))))
            .select("sku_name",
                    ((F.length("sku_name") + y - 1990) / F.lit(100.0)).alias("price"),
                    F.make_timestamp(y, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
                     .alias("price_start_time"),
                    F.when(y < 2000, F.make_timestamp(y + 1, F.lit(1), F.lit(1), F.lit(0),
                                                      F.lit(0), F.lit(0)))
                     .alias("price_end_time")))


def benchmark_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load-test log: one measured phase row per event."""
    e = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    phase = (F.when(F.col("event_type") == "view", "ramp")
             .when(F.col("event_type") == "click", "fanout")
             .when(F.col("event_type") == "purchase", "features_only")
             .when(F.col("event_type") == "signup", "spike_baseline").otherwise("spike_load"))
    conc = F.element_at(F.array(*[F.lit(c) for c in (1, 8, 16, 32, 64)]),
                        (F.col("user_id") % 5 + 1).cast("int")).cast("bigint")
    return e.select(
        F.col("ts").cast("timestamp").alias("measured_at"),
        F.when(F.col("user_id") % 2 == 0, "in_region").otherwise("laptop").alias("where_run"),
        F.concat(F.lit("endpoint-"), (F.col("user_id") % 3).cast("string")).alias("endpoint"),
        phase.alias("phase"), conc.alias("concurrency"),
        (F.lit(4) * (1 + F.col("user_id") % 8)).alias("rows_per_request"),
        (k + 10).alias("requests"), (k + 10 - k % 7).alias("ok"),
        F.col("value").alias("p50_ms"), (F.col("value") * 2).alias("p95_ms"),
        (F.col("value") * 4).alias("p99_ms"), (F.lit(1000) - F.col("value")).alias("rps"),
        F.concat(F.lit("note-"), k.cast("string")).alias("note"),
        F.to_json(F.struct(
            (k % 2 == 0).alias("route_optimized"),
            F.array(F.struct((k % 3 == 0).alias("scale_to_zero"),
                             k.alias("min_provisioned_concurrency"),
                             F.lit("Small").alias("workload_size"))).alias("served_entities")))
        .alias("endpoint_config_json"))
