"""Trailing windows, day buckets and rolling calendar windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Angle sums are kept as integers so results do not depend on summation order.
ANGLE_SCALE = 1_000_000_000


def trailing(df: DataFrame, ts: str, as_of: Column, interval: str) -> DataFrame:
    """Rows with ``as_of - interval < ts <= as_of``."""
    return df.where((F.col(ts) > as_of - F.expr(f"INTERVAL {interval}")) & (F.col(ts) <= as_of))


def day_end(ts: Column) -> Column:
    """End-of-day stamp of the half-open day (D 00:00, D+1 00:00] that holds ``ts``.

    Windows measured back from such a stamp are lower-open and upper-closed, so an event at
    midnight belongs to the day that just ended.
    """
    return F.date_trunc("day", ts - F.expr("INTERVAL 1 MICROSECOND")) + F.expr("INTERVAL 1 DAY")


def day_range(df: DataFrame, ts: str) -> Column:
    """Every calendar day between the first and the last row, as a one-value array."""
    span = df.agg(F.min(F.to_date(ts)).alias("a"), F.max(F.to_date(ts)).alias("b"))
    return span.select(F.sequence("a", "b")).scalar()


def days_present(df: DataFrame, ts: str) -> Column:
    """Days that occur in the log; the array is bounded by the calendar, not by rows."""
    d = df.select(F.to_date(ts).alias("d")).distinct()
    return d.agg(F.array_sort(F.collect_set("d"))).scalar()


def rolling_days(facts: DataFrame, keys: list[str], day: str,
                 specs: list[tuple[str, str, str, int | None]], days: Column,
                 entities: DataFrame | None = None, change_points: bool = False) -> DataFrame:
    """Rolling calendar-day aggregates from facts pre-aggregated to (keys, day).

    ``specs`` lists (output, fact column, "sum" or "max", days or None for all history).
    Only facts cross the shuffle on ``keys``. Behind it a fact also stands on the days on which it
    leaves a window, and windows are ordered over these days alone; a day between two of them has
    the values of the earlier one, so the dense days are dealt out last and never ordered. A hot key
    is bounded by the calendar.

    ``change_points=True`` emits only days on which some output can change (a fact enters or
    leaves a window) and the log's first day. An as-of join reads the same values from it as from the dense grid.
    ``entities`` lists the keys that have rows, with facts or without.
    """
    measures = sorted({c for _, c, _, _ in specs})
    steps = sorted({n for _, _, _, n in specs if n})
    first, last = F.element_at(days, 1), F.element_at(days, -1)
    blank = [F.lit(None).cast(facts.schema[m].dataType).alias(m) for m in measures]
    rows = facts.select(*keys, day, *measures)
    if entities is not None:
        rows = (rows.withColumn("_known", F.lit(False))
                .unionByName(entities.select(*keys, F.lit(None).cast("date").alias(day), *blank, F.lit(True).alias("_known"))))
        first = F.when(F.col("_known"), first)
    known = [] if entities is None else ["_known"]
    # Step 0 is the fact itself, -1 the log's first day; columns of their own, so that unread measures are not shuffled.
    rows = (rows.repartition(*keys).select("*", F.explode(F.array(*[F.lit(n) for n in (0, *steps, -1)])).alias("_s"))
            .select(*keys, *known, F.when(F.col("_s") < 0, first).otherwise(F.date_add(day, "_s")).alias(day),
                    *[F.when(F.col("_s") == 0, F.col(m)).alias(m) for m in measures])
            .where(F.col(day) <= last).withColumn("_d", F.unix_date(day)))
    base = Window.partitionBy(*keys).orderBy("_d")
    since_start = lambda until: base.rangeBetween(Window.unboundedPreceding, until)
    whole = {m for m in measures if facts.schema[m].dataType.typeName() in ("integer", "long", "short", "byte")}
    parts, cols = {}, []
    for out, c, op, n in specs:
        if op == "sum" and c in whole:
            # Whole numbers: the window is a difference of two running totals, which Spark keeps
            # up to date row by row, where a sliding frame would add up every window again.
            parts[f"_{c}_0"] = F.sum(c).over(since_start(0))
            total = F.coalesce(F.col(f"_{c}_0"), F.lit(0))
            if n is not None:
                parts[f"_{c}_{n}"] = F.sum(c).over(since_start(-n))
                total = total - F.coalesce(F.col(f"_{c}_{n}"), F.lit(0))
            cols.append(total.alias(out))
            continue
        w = base.rangeBetween(Window.unboundedPreceding if n is None else -(n - 1), 0)
        parts[f"_w_{out}"] = getattr(F, op)(c).over(w)
        v = F.col(f"_w_{out}")
        cols.append((F.coalesce(v, F.lit(0)) if op == "sum" else v).alias(out))
    parts["_next"] = F.lead("_d").over(base)
    if known:
        parts["_known"] = F.max("_known").over(Window.partitionBy(*keys))
    # Rows of one day are peers and hold the same values; the last of them stands for the day.
    framed = rows.select(*keys, day, "_d", *[v.alias(k) for k, v in parts.items()]).where("_next IS NULL OR _next > _d")
    if known:
        framed = framed.where("_known")
    if not change_points:
        until = F.coalesce(F.col("_next") - 1, F.unix_date(last))
        held = [k for k in parts if k not in ("_next", "_known")]
        framed = (framed.select(*keys, *held, F.explode(F.sequence(F.col("_d"), until)).alias("_d"))
                  .withColumn(day, F.date_from_unix_date("_d")).where(F.array_contains(days, F.col(day))))
    return framed.select(*keys, day, *cols)


def angle_parts(hour: Column) -> tuple[Column, Column]:
    """(sin, cos) of an hour on the 24 h circle as scaled integers."""
    a = hour * F.lit(2.0 * 3.141592653589793 / 24.0)
    as_int = lambda x: F.round(x * ANGLE_SCALE).cast("bigint")
    return as_int(F.sin(a)), as_int(F.cos(a))


def circular_hour(sin_sum: Column, cos_sum: Column, n: Column) -> Column:
    """Circular mean hour in [0, 24); zero when nothing was observed."""
    a = F.atan2(sin_sum.cast("double"), cos_sum.cast("double"))
    h = F.pmod(a * F.lit(24.0 / (2.0 * 3.141592653589793)), F.lit(24.0))
    return F.when(n > 0, h).otherwise(F.lit(0.0))


def circular_concentration(sin_sum: Column, cos_sum: Column, n: Column) -> Column:
    """Resultant length in [0, 1]; zero when nothing was observed."""
    s, c = sin_sum.cast("double"), cos_sum.cast("double")
    return F.when(n > 0, F.sqrt(s * s + c * c) / ANGLE_SCALE / n).otherwise(F.lit(0.0))


def ratio(num: Column, den: Column) -> Column:
    """num / den, zero when the denominator is zero or missing."""
    return F.coalesce(num / F.when(den != 0, den), F.lit(0.0))
