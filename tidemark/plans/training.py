"""Label frames, splits, samples and point-in-time training sets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.request import FeatureFunction, apply_functions
from ..operators.asof import asof_join, asof_join_many, lookup_latest
from ..operators.orderstats import interpolated
from ..session import materialize
from ..sources.changes import schema_rows

RAIL_LABEL_SIDE = ["rail_position", "was_viewport", "sample_weight"]


@dataclass(frozen=True)
class Lookup:
    """A feature table to attach: by time when ``ts`` is given, else newest value.

    ``daily`` states that a key has one snapshot per day, as every feature table here does.
    """
    table: DataFrame
    keys: list[str]
    ts: str | None = None
    columns: list[str] | None = field(default=None)
    daily: bool = True


def title_labels(events: DataFrame) -> DataFrame:
    """Watch-next labels: impressions only, with request context and the request clock."""
    return (events.where(F.col("event_type") == "impression")
            .select("event_id", "viewer_id", "title_id", F.col("event_ts").alias("label_ts"),
                    "surface", "device", "locale", "hour_of_day",
                    F.unix_timestamp("event_ts").alias("request_epoch_s"), "played"))


def rail_labels(impressions: DataFrame, propensity: DataFrame) -> DataFrame:
    """Homepage labels; the inverse propensity weighs engaged rows only."""
    # One row a position: sent to every task, so that the log is not dealt by its few positions.
    p = F.broadcast(propensity.select("rail_position", "ips_weight"))
    w = F.when(F.col("engaged") == 1, F.col("ips_weight")).otherwise(F.lit(1.0))
    return (impressions.join(p, "rail_position")
            .select("session_id", "viewer_id", "rail_id", F.col("rendered_ts").alias("label_ts"),
                    "device", "locale", "hour_of_day", "day_of_week",
                    F.unix_timestamp("rendered_ts").alias("request_epoch_s"),
                    "rail_position", "was_viewport", "engaged", w.alias("sample_weight")))


def temporal_split(labels: DataFrame, ts: str, holdout_days: int) -> DataFrame:
    """Adds ``split``: train up to ``max(ts) - holdout_days``, test after."""
    cut = labels.agg(F.max(ts) - F.expr(f"INTERVAL {holdout_days} DAYS")).scalar()
    return labels.withColumn("split", F.when(F.col(ts) <= cut, "train").otherwise("test"))


def quantile_split(labels: DataFrame, ts: str, q: float = 0.8) -> DataFrame:
    """Adds ``split`` at an exact time quantile (interpolated, microseconds)."""
    us = labels.select(F.unix_micros(ts).alias("_us"))
    cut = interpolated(us, [], "_us", {"cut": q}).select("cut").scalar()
    return labels.withColumn("split", F.when(F.unix_micros(ts) <= cut, "train").otherwise("test"))


def training_set(labels: DataFrame, lookups: list[Lookup], functions: list[FeatureFunction],
                 label_ts: str, exclude: list[str]) -> DataFrame:
    """Labels, then every lookup, then request functions, then exclusions; columns in that order.

    Daily lookups on the same keys are attached together, so labels are shuffled once for each set
    of keys. Filter or sample ``labels`` before calling: nothing can be pushed below the as-of joins.
    """
    out, columns = labels, list(labels.columns)
    together: dict[tuple, list] = {}
    for lk in lookups:
        cols = lk.columns or [c for c in lk.table.columns if c not in lk.keys and c != lk.ts]
        columns += cols
        t = lk.table.select(*lk.keys, *([lk.ts] if lk.ts else []), *cols)
        if lk.ts and lk.daily:
            together.setdefault(tuple(lk.keys), []).append((t, lk.ts, None))
        elif lk.ts:
            out = asof_join(out, t, lk.keys, label_ts=label_ts, snapshot_ts=lk.ts, probe=labels)
        else:
            out = lookup_latest(out, t, lk.keys)
    for keys, tables in together.items():
        out = asof_join_many(out, tables, list(keys), label_ts, probe=labels)
    return apply_functions(out.select(*columns), functions).drop(*exclude)


def reattach(frame: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """One-to-one re-attachment of excluded columns.

    The job fails if a key repeats on the side frame or has no match there. Both checks ride
    on the join itself, so no extra pass is made.
    """
    extra = [c for c in side.columns if c not in keys]
    one = side.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                  *[F.first(c).alias(c) for c in extra])
    j = frame.join(one, keys, "left")
    ok = F.when(F.col("_n").isNull(), F.raise_error(F.lit("row has no match on re-attach keys"))
                ).when(F.col("_n") > 1, F.raise_error(F.lit("re-attach keys are not unique"))
                       ).otherwise(F.lit(True))
    return j.where(ok).drop("_n")


def column_status(df: DataFrame, roles: dict[str, list[str]]) -> DataFrame:
    """(column_name, role, status) of a training set against the fixed roles: ``ok``, ``missing``
    from the set, or ``unclaimed`` by any role."""
    fixed = df.sparkSession.createDataFrame([(c, role) for role, cols in roles.items() for c in cols],
                                            "column_name string, role string")
    here = schema_rows(df).select("column_name", F.lit(True).alias("_here"))
    status = F.when(F.col("_here").isNull(), "missing").when(F.col("role").isNull(), "unclaimed").otherwise("ok")
    return fixed.join(here, "column_name", "full_outer").select("column_name", "role", status.alias("status"))


def non_double_columns(df: DataFrame, keys: list[str]) -> list[tuple[str, str]]:
    """Columns that break the rule that all but keys are doubles."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields
            if f.name not in keys and f.dataType.simpleString() != "double"]


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of nulls per column, one pass, one row per column."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return one.unpivot([], columns, "column_name", "null_rate")


def context_varies(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Per entity: does a request-time value change across its request contexts?"""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("requests"),
                               (F.min(value) < F.max(value)).alias("varies"))


def pit_report(labels: DataFrame, snapshots: DataFrame, keys: list[str], value: str,
               label_ts: str) -> DataFrame:
    """Value in force at label time beside the newest value, with a difference flag."""
    from ..operators.asof import latest_per_key
    then = asof_join(labels, snapshots.select(*keys, "ts", value), keys, label_ts=label_ts,
                     how="inner", one_per_bucket=True)
    now = latest_per_key(snapshots.select(*keys, "ts", value), keys).withColumnRenamed(
        value, f"{value}_now")
    return (then.join(now, keys)
            .withColumn("differs", F.col(value) != F.col(f"{value}_now")))


# ---------------------------------------------------------------- encodings
def dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, position) of the distinct non-null values of a column, positions dense and in value order.

    Values are cut into ranges; a position is the count of the ranges before plus the place inside its
    own, so nothing orders all values in one task and no array of them is built.
    """
    d = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    # Stored, because ranges are drawn from a sample and a rerun may cut elsewhere.
    cut = materialize(d.repartitionByRange("value").withColumn("_range", F.spark_partition_id()), "dictionary")
    sizes = cut.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy("value"))
    return (cut.withColumn("_place", place).join(before, "_range")
            .select("value", (F.col("_before") + F.col("_place") - 1).alias("position")))


def encode(df: DataFrame, columns: dict[str, str], fit_on: DataFrame) -> DataFrame:
    """``df`` with an index for each categorical column (column -> name of its index) from the values of
    ``fit_on``; unseen and null values share the index after the last."""
    out = df
    for column, name in columns.items():
        known = materialize(dictionary(fit_on, column), "dictionary-positions")
        size = known.agg(F.count(F.lit(1)).alias("n"))
        out = (out.join(known.select(F.col("value").alias(column), F.col("position").alias(name)), column, "left")
               .withColumn(name, F.coalesce(F.col(name), size.scalar()).cast("bigint")))
    return out.select(*df.columns, *columns.values())


def standardize(df: DataFrame, fit_on: DataFrame, columns: list[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / sample deviation with moments of ``fit_on``; constant columns use scale 1."""
    stats = fit_on.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"m_{c}") for c in columns],
                       *[F.stddev_samp(c).alias(f"s_{c}") for c in columns])
    one = stats.select(F.struct(*stats.columns)).scalar()
    out = {}
    for c in columns:
        sd = F.col("_fit")[f"s_{c}"]
        scale = F.when(sd.isNull() | F.isnan(sd) | (F.abs(sd) <= 1e-8), F.lit(1.0)).otherwise(sd)
        out[f"{c}{suffix}"] = (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.col("_fit")[f"m_{c}"]) / scale
    return df.withColumn("_fit", one).withColumns(out).drop("_fit")
