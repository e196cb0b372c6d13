"""Operations reports: status, latency, cost, freshness, quality, definitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.intervals import interval_join
from ..operators.orderstats import floor_rank, interpolated, nearest_rank, order_statistics

REQUEST = ("dataframe_records array<struct<viewer_id string, title_id string, surface string, "
           "device string, locale string, hour_of_day int>>")


# ---------------------------------------------------------------- request log
def request_mix(log: DataFrame) -> DataFrame:
    """Rows and requests per request context, from the JSON payload.

    Rows are counted per (context, request) first, so the distinct count needs no wide state.
    """
    keys = ["surface", "device", "locale", "hour_of_day"]
    rec = (log.select("request_id", F.explode(F.from_json("request", REQUEST)["dataframe_records"]).alias("x"))
           .select("request_id", *[F.col(f"x.{k}").alias(k) for k in keys]))
    return (rec.groupBy(*keys, "request_id").agg(F.count(F.lit(1)).alias("n"))
            .groupBy(*keys).agg(F.sum("n").alias("rows_scored"), F.count(F.lit(1)).alias("requests")))


def score_by_group(log: DataFrame, titles: DataFrame) -> DataFrame:
    """Scores by genre: prediction i belongs to request row i; successful calls only."""
    z = (log.where("status_code = 200")
         .select(F.from_json("request", "dataframe_records array<struct<title_id string>>")["dataframe_records"].alias("q"),
                 F.from_json("response", "predictions array<double>")["predictions"].alias("p"))
         .select("q", F.posexplode("p").alias("i", "score"))
         .select(F.get(F.col("q"), F.col("i"))["title_id"].cast("bigint").alias("title_id"), "score"))
    per = z.groupBy("title_id").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("s"), F.max("score").alias("m"))
    return (per.join(titles.select("title_id", "primary_genre"), "title_id").groupBy("primary_genre")
            .agg(F.sum("n").alias("scored"), F.round(F.sum("s") / F.sum("n"), 4).alias("mean_score"),
                 F.round(F.max("m"), 4).alias("max_score")))


def serving_latency_hourly(log: DataFrame) -> DataFrame:
    q = lambda p: F.round(F.percentile_approx("execution_duration_ms", p), 1)
    return (log.groupBy(F.date_trunc("hour", "request_time").alias("hour_bucket"), "served_entity_id")
            .agg(F.count(F.lit(1)).alias("requests"), q(0.5).alias("p50_ms"), q(0.95).alias("p95_ms"),
                 q(0.99).alias("p99_ms"),
                 F.round(100.0 * F.count_if(F.col("status_code") != 200) / F.count(F.lit(1)), 2).alias("error_pct")))


def latency_since(log: DataFrame, since: Column) -> DataFrame:
    """Exact interpolated percentiles and failures from ``since`` on."""
    w = log.where(F.col("request_time") >= since)
    p = interpolated(w, [], "execution_duration_ms", {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99})
    tail = w.agg(F.max("execution_duration_ms").alias("m"), F.count_if(F.col("status_code") != 200).alias("e"))
    return p.select(F.col("n").alias("requests"), *[F.round(c, 1).alias(c) for c in ("p50_ms", "p95_ms", "p99_ms")],
                    tail.select("m").scalar().alias("max_ms"), tail.select("e").scalar().alias("non_200"))


def entity_attribution(log: DataFrame) -> DataFrame:
    """Requests, failures and p95 per served entity."""
    n = log.groupBy("served_entity_id").agg(F.count(F.lit(1)).alias("requests"),
                                            F.count_if(F.col("status_code") != 200).alias("errors"))
    p = interpolated(log, ["served_entity_id"], "execution_duration_ms", {"p95_ms": 0.95}).drop("n")
    return n.join(p, "served_entity_id").withColumn("p95_ms", F.round("p95_ms", 1))


# ---------------------------------------------------------------- load tests
def latency_percentiles(samples: DataFrame, by: list[str], value: str) -> DataFrame:
    """Nearest-rank percentiles with count, extremes, mean and population deviation."""
    p = order_statistics(samples, by, value, {f"p{int(q * 100)}_ms": nearest_rank(q) for q in (0.5, 0.9, 0.95, 0.99)})
    s = samples.groupBy(*by).agg(F.min(value).alias("min_ms"), F.max(value).alias("max_ms"),
                                 F.avg(value).alias("mean_ms"), F.stddev_pop(value).alias("stdev_ms"))
    j = p.join(s, by)
    return j.select(*by, "n", *[F.round(c, 1).alias(c) for c in
                                ("min_ms", "p50_ms", "p90_ms", "p95_ms", "p99_ms", "max_ms", "mean_ms", "stdev_ms")])


def stage_latency(stages: DataFrame, by: list[str], value: str) -> DataFrame:
    """Floor-index percentiles per stage."""
    return order_statistics(stages, by, value, {"p50_ms": floor_rank(0.5), "p95_ms": floor_rank(0.95)})


def error_counts(samples: DataFrame, by: list[str], status: str) -> DataFrame:
    """Non-200 answers per status as one string per group; code 0 is a transport failure."""
    code = F.when(F.col(status) == 0, "transport").otherwise(F.concat(F.lit("http_"), F.col(status).cast("string")))
    g = samples.where(F.col(status) != 200).groupBy(*by, code.alias("code")).agg(F.count(F.lit(1)).alias("n"))
    # One entry per status code.
    return g.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(
        F.concat_ws("=", "code", F.col("n").cast("string")))), ",").alias("errors"))


def throughput_windows(samples: DataFrame, phase: str, started: str, ok: Column, width: int) -> DataFrame:
    """Successful requests per fixed window since the phase began, and the time to plateau:
    the first window within 10 % of the best."""
    t0 = samples.groupBy(phase).agg(F.min(started).alias("_t0"))
    w = F.floor((F.unix_micros(started) - F.unix_micros("_t0")) / F.lit(width * 1_000_000))
    wins = (samples.join(t0, phase).groupBy(phase, w.alias("w"))
            .agg(F.count(F.lit(1)).alias("requests"), F.count_if(ok).alias("_ok"))
            .withColumn("rps", F.round(F.col("_ok") / float(width), 1)))
    best = wins.groupBy(phase).agg(F.max("rps").alias("best_rps"), F.min_by("rps", "w").alias("first_rps"))
    j = wins.join(best, phase)
    return j.groupBy(phase, "best_rps", "first_rps").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("requests").alias("requests"),
        F.min(F.when((F.col("best_rps") > 0) & (F.col("rps") >= 0.9 * F.col("best_rps")), F.col("w") * width)
              ).alias("seconds_to_90pct_of_best"),
        ).withColumn("scale_up_factor", F.round(F.col("best_rps") / F.when(F.col("first_rps") != 0, F.col("first_rps")), 2))


def spike_recovery(load: DataFrame, baseline: DataFrame, started: str, value: str, ok: Column,
                   width: int = 1) -> DataFrame:
    """p95 per time step of a spike, and the first step back within 1.5 x the baseline p95.

    Only calls that succeeded (``ok``) have a latency; a step without one has no row. Steps count
    from the spike's first call of any outcome.
    """
    t0 = load.agg(F.min(F.unix_micros(started))).scalar()
    step = F.floor((F.unix_micros(started) - t0) / F.lit(width * 1_000_000))
    per = order_statistics(load.where(ok).select(step.alias("step"), value), ["step"], value, {"p95": nearest_rank(0.95)})
    base = order_statistics(baseline.where(ok), [], value, {"p95": nearest_rank(0.95)}).select(F.round("p95", 1)).scalar()
    p95 = F.round("p95", 1)
    return per.agg(F.min_by(p95, "step").alias("first_step_p95_ms"), F.first(base).alias("baseline_p95_ms"),
                   F.min(F.when(p95 <= base * 1.5, F.col("step"))).alias("recovered_at_step"),
                   F.count(F.lit(1)).alias("steps"))


def benchmark_rollup(log: DataFrame, keep: Column, by: list[str]) -> DataFrame:
    """Best-of rollup over rows within one day of the newest measurement."""
    newest = log.agg(F.max("measured_at")).scalar()
    w = log.where(keep & (F.col("measured_at") >= newest - F.expr("INTERVAL 1 DAY")))
    return w.groupBy(*by).agg(F.max("p50_ms").alias("p50_ms"), F.max("p95_ms").alias("p95_ms"),
                              F.max("p99_ms").alias("p99_ms"), F.max("rps").alias("requests_per_second"),
                              F.sum(F.col("requests") - F.col("ok")).alias("failed"), F.max("note").alias("note"))


def benchmark_config(log: DataFrame) -> DataFrame:
    """Endpoint settings the numbers belong to, read out of the stored JSON by path."""
    c = log.groupBy("where_run", "endpoint").agg(F.max("measured_at").alias("measured_at"),
                                                 F.max("endpoint_config_json").alias("_j"))
    at = lambda p: F.get_json_object("_j", p)
    return c.select("where_run", "endpoint", "measured_at", at("$.route_optimized").alias("route_optimized"),
                    at("$.served_entities[0].scale_to_zero").alias("scale_to_zero"),
                    at("$.served_entities[0].min_provisioned_concurrency").alias("min_concurrency"),
                    at("$.served_entities[0].workload_size").alias("workload_size"))


# ---------------------------------------------------------------- cost, freshness, sync
def priced_usage(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Daily quantity and list cost per SKU under the price in force at the usage end.

    Usage is summed per (SKU, day, end time) before it meets the price list; the validity
    interval is closed at its start and open at its end, and a null end never expires.
    """
    u = usage.groupBy("sku_name", "usage_date", "usage_end_time").agg(F.sum("usage_quantity").alias("q"))
    j = interval_join(u, prices.select("sku_name", "price_start_time", "price_end_time", "price"), ["sku_name"],
                      "usage_end_time", "price_start_time", "price_end_time")
    return j.groupBy("usage_date", "sku_name").agg(
        F.round(F.sum("q"), 2).alias("units"), F.round(F.sum(F.col("q") * F.col("price")), 2).alias("list_cost"))


def latest_status(log: DataFrame) -> DataFrame:
    """Newest state per object; ties in time resolve by version."""
    at = F.struct("captured_at", "source_version")
    pick = lambda c: F.max_by(c, at).alias(c)
    return log.groupBy("object").agg(pick("state"), F.max("captured_at").alias("last_checked"),
                                     pick("lag_seconds"), pick("source_version"), pick("processed_version"))


def sync_lag(log: DataFrame, now: Column) -> DataFrame:
    """Versions and seconds each object is behind its source, from its newest row."""
    s = latest_status(log)
    return s.select("object", (F.col("source_version") - F.col("processed_version")).alias("versions_behind"),
                    (F.unix_timestamp(now) - F.unix_timestamp("last_checked")).alias("seconds_since_sync"))


def freshness(tables: dict[str, tuple[DataFrame, Column]], now: Column) -> DataFrame:
    """Rows and minutes since the newest event, one row per table."""
    out = None
    for name, (df, epoch) in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("rows"), F.max(epoch).cast("bigint").alias("newest_event_epoch_s"))
        row = row.select(F.lit(name).alias("feature_table"), "rows", "newest_event_epoch_s",
                         F.round((F.unix_timestamp(now) - F.col("newest_event_epoch_s")) / 60.0, 1).alias("newest_event_age_min"))
        out = row if out is None else out.unionByName(row)
    return out


# ---------------------------------------------------------------- definitions
def definition_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per (table, column, type): the shape a model resolved when it was trained."""
    any_df = next(iter(tables.values()))
    rows = [(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema.fields]
    return any_df.sparkSession.createDataFrame(rows, "object string, column_name string, data_type string")


def fingerprints(definitions: DataFrame) -> DataFrame:
    """Twelve hex digits over each object's sorted (name, type) pairs; column order is ignored."""
    pair = F.concat_ws(":", "column_name", "data_type")
    return definitions.groupBy("object").agg(
        F.substring(F.sha2(F.array_join(F.array_sort(F.collect_list(pair)), ","), 256), 1, 12).alias("fingerprint"))


def drift_report(pins: DataFrame, recorded: DataFrame, now: DataFrame) -> DataFrame:
    """Per model: broken, changed, unverifiable or ok.

    ``pins``: model, object, kind. ``recorded``: model, object, fingerprint at training.
    ``now``: object, fingerprint.
    """
    j = (pins.join(now.withColumnRenamed("fingerprint", "_now"), "object", "left")
         .join(recorded.withColumnRenamed("fingerprint", "_then"), ["model", "object"], "left"))
    g = j.groupBy("model").agg(
        F.count_if(F.col("kind") == "table").alias("tables"),
        F.count_if(F.col("kind") == "function").alias("functions"),
        F.count_if(F.col("_now").isNull()).alias("missing"), F.count("_then").alias("_known"),
        F.count_if(F.col("_now") != F.col("_then")).alias("changed"))
    status = (F.when(F.col("missing") > 0, "broken").when(F.col("changed") > 0, "changed")
              .when(F.col("_known") == 0, "unverifiable").otherwise("ok"))
    return g.select("model", "tables", "functions", "missing", "changed", status.alias("status"))


def spec_hashes(pins: DataFrame, now: DataFrame) -> DataFrame:
    """Per model twelve hex digits each of its shape (which objects it pins), of its tables' and of its
    functions' definitions now; a missing object counts as ``-``.

    A model whose shape stays while a definition hash moves reads the same objects, redefined.
    """
    def over(text, on=None):
        some = F.collect_set(text if on is None else F.when(on, text))
        return F.substring(F.sha2(F.array_join(F.array_sort(some), ","), 256), 1, 12)
    defined = F.concat_ws("=", "object", F.coalesce("fingerprint", F.lit("-")))
    return pins.join(now, "object", "left").groupBy("model").agg(
        over(F.concat_ws(":", "kind", "object")).alias("spec_hash"),
        over(defined, F.col("kind") == "table").alias("table_hash"),
        over(defined, F.col("kind") == "function").alias("function_hash"))


def pins_index(pins: DataFrame) -> DataFrame:
    """Which models break if an object changes."""
    return pins.groupBy("object").agg(F.count_distinct("model").alias("models"),
                                      F.array_join(F.array_sort(F.collect_set("model")), ",").alias("pinned_by"))


# ---------------------------------------------------------------- quality
def quality_checks(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """Union of one-row frames (passed, detail) under their check names."""
    out = None
    for name, df in checks:
        row = df.select(F.lit(name).alias("check_name"), "passed", F.col("detail").cast("string").alias("detail"))
        out = row if out is None else out.unionByName(row)
    return out


def batch_order(batches: DataFrame, batch: str, first_ts: str) -> DataFrame:
    """How many ordered batches start before their predecessor did.

    A batch is held against the nearest lower number that exists. Numbers are cut into ranges:
    neighbours are found inside a range, and a range's first batch looks at the newest batch of the
    ranges before it, of which there is one row each.
    """
    width = 10_000
    b = batches.select(F.col(batch).alias("_b"), F.col(first_ts).alias("_t"),
                       F.floor(F.col(batch) / width).alias("_range"))
    last = b.groupBy("_range").agg(F.max_by("_t", "_b").alias("_end"))
    last = last.select("_range", F.lag("_end").over(Window.orderBy("_range")).alias("_before"))
    inside = Window.partitionBy("_range").orderBy("_b")
    seen = b.join(last, "_range").withColumn("_prev", F.coalesce(F.lag("_t").over(inside), "_before"))
    return (seen.withColumnRenamed("_t", first_ts)
            .agg(F.count(F.lit(1)).alias("batches"), F.count_if(F.col(first_ts) < F.col("_prev")).alias("decreases"))
            .withColumn("monotonic", F.col("decreases") == 0))


def importance_by_source(importance: DataFrame, source: DataFrame) -> DataFrame:
    """Feature importance summed per source table with its share of the total."""
    total = importance.agg(F.sum("importance")).scalar()
    return (importance.join(source, "feature").groupBy("source")
            .agg(F.count(F.lit(1)).alias("features"), F.sum("importance").alias("importance"))
            .withColumn("share", F.col("importance") / total))
