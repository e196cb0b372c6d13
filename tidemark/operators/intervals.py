"""Points that meet the intervals they fall into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_DAY_US = 86_400_000_000


def interval_join(points: DataFrame, intervals: DataFrame, on: list[str], at: str, start: str, end: str,
                  days: int = 30) -> DataFrame:
    """Every point with each interval of its key that holds it: ``start <= at`` and ``at < end``.

    Intervals are cut into calendar buckets of ``days`` days inside the points' own span, a point lies
    in one bucket, and overlap is decided there. So a key with many points and many intervals is as
    many join keys as it has buckets, and a long interval costs one narrow row for each. A null end
    never expires; a null start, key or point time matches nothing. Overlapping intervals all match.
    """
    clash = sorted((set(points.columns) & set(intervals.columns)) - set(on))
    if clash:
        raise ValueError(f"both frames have columns {clash}")
    bucket = lambda c: F.floor(F.unix_micros(c) / (days * _DAY_US))
    first, last = (points.agg(f(at)).scalar() for f in (F.min, F.max))
    s, e = F.col(start), F.col(end)
    near = intervals.where((s <= last) & (e.isNull() | (e > first)))
    upto: Column = F.least(F.coalesce(e, last), last)
    cut = near.withColumn("_b", F.explode(F.sequence(bucket(F.greatest(s, first)), bucket(upto))))
    return (points.withColumn("_b", bucket(F.col(at))).join(cut, [*on, "_b"])
            .where((F.col(at) >= s) & (e.isNull() | (F.col(at) < e))).drop("_b"))
