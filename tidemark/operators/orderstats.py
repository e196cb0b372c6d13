"""Exact ranks and percentiles without putting a whole group in one task.

Values are first collapsed to (group, value, count). Approximate cut points then split each
group into value ranges; counts are prefix-summed over ranges (a few rows per group) and,
separately, inside each range. The cut points only place boundaries: ranks stay exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

_STRIDE = 64
#: Groups of more rows are cut into value ranges; a smaller group is ordered as it is.
GROUP_ROWS = 200_000


def _search(cuts: str, coarse: str, value: Column) -> Column:
    """How many cut points lie below ``value``: first among every ``_STRIDE``-th point, then
    among the points of that stretch."""
    block = F.size(F.filter(coarse, lambda c: c < value))
    start = F.greatest(block - 1, F.lit(0)) * _STRIDE
    return start + F.size(F.filter(F.slice(cuts, start + 1, F.lit(_STRIDE)), lambda c: c < value))


def _ranges(df: DataFrame) -> int:
    """Value ranges per group: as many as shuffle tasks, so ordering work spreads with the cluster."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return min(4096, max(64, tasks))


def value_ranks(df: DataFrame, by: list[str], value: str, ranges: int | None = None,
                extra: dict[str, Column] | None = None, size: str | None = None) -> DataFrame:
    """One row per distinct (by, value): ``n`` equal rows, ``n_less`` rows below it, plus any
    ``extra`` additive aggregates (as ``name``) with their running total below (``name_less``).
    ``size`` names a column for the group's non-null rows."""
    extra = extra or {}
    ranges = ranges or _ranges(df)
    vals = (df.where(F.col(value).isNotNull()).groupBy(*by, value)
            .agg(F.count(F.lit(1)).alias("n"), *[a.alias(k) for k, a in extra.items()]))
    points = [i / ranges for i in range(1, ranges)]
    sketch = F.percentile_approx(value, points, max(1000, 4 * ranges)).alias("_cuts")
    every = F.filter("_cuts", lambda c, i: i % _STRIDE == 0).alias("_coarse")
    if by:
        # A join by shuffle would put each group's values into one task, to be ordered there whole. The
        # cuts of the large groups go to every task instead: ``ranges`` values per ``GROUP_ROWS`` rows at most.
        cuts = (df.groupBy(*by).agg(sketch, F.count(value).alias("_rows")).where(F.col("_rows") > GROUP_ROWS)
                .select(*by, "_cuts", every))
        vals = vals.join(F.broadcast(cuts), by, "left")
    else:
        one = df.agg(sketch).select(F.struct("_cuts", every))
        vals = vals.withColumn("_s", one.scalar()).select("*", "_s.*").drop("_s")
    # Never null, so that no filter on it makes two plans of the one that both branches below share.
    place = F.coalesce(_search("_cuts", "_coarse", F.col(value)), F.lit(0))
    vals = vals.withColumn("_r", place).drop("_cuts", "_coarse")

    sums = ["n"] + list(extra)
    for b in by:
        vals = vals.where(F.col(b).isNotNull())
    part = vals.groupBy(*by, "_r").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    # At most ``ranges`` rows per group.
    over = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = over.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select(*by, "_r", "_t_n", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_b_{c}")
                                    for c in sums],
                       *([F.sum("_t_n").over(over).alias(size)] if size else []))
    inside = (Window.partitionBy(*by, "_r").orderBy(value)
              .rowsBetween(Window.unboundedPreceding, -1))
    out = vals.withColumns({f"_i_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    out = out.join(part, by + ["_r"], "left")
    # A sketch depends on the order in which its parts are merged. Spark makes it once for both branches; were it
    # made twice, some range would hold more rows here than were counted there, and the ranks would be wrong.
    same = F.coalesce(F.col("_i_n") + F.col("n") <= F.col("_t_n"), F.lit(False))
    below = lambda c: F.when(same, (F.col(f"_b_{c}") + F.col(f"_i_{c}")).cast("bigint")
                             ).otherwise(F.raise_error(F.lit("value ranges were cut twice")).cast("bigint"))
    return out.select(*by, value, *sums, *[below(c).alias(f"{c}_less") for c in sums], *([size] if size else []))


def order_statistics(df: DataFrame, by: list[str], value: str,
                     index: dict[str, Callable[[Column], Column]], ranges: int | None = None) -> DataFrame:
    """Values at the given zero-based positions of each group's sorted values.

    ``index`` maps an output name to a function of the group size. Returns by, n, names.
    """
    ranks = value_ranks(df, by, value, ranges, size="_size")
    hits = []
    for name, at in index.items():
        i = at(F.col("_size"))
        inside = (i >= F.col("n_less")) & (i < F.col("n_less") + F.col("n"))
        hits.append(F.max(F.when(inside, F.col(value))).alias(name))
    return ranks.groupBy(*by).agg(F.max("_size").alias("n"), *hits)


def nearest_rank(q: float) -> Callable[[Column], Column]:
    """Index ``round_half_even(q * n) - 1`` held inside the group."""
    return lambda n: F.greatest(F.lit(0), F.least(n - 1, F.rint(F.lit(q) * n).cast("bigint") - 1))


def floor_rank(q: float) -> Callable[[Column], Column]:
    """Index ``floor(q * n)`` held inside the group."""
    return lambda n: F.least(n - 1, F.floor(F.lit(q) * n))


def disc_rank(percent: int) -> Callable[[Column], Column]:
    """Index of the first value with at least ``percent`` of the group up to it (the SQL ``percentile_disc``)."""
    return lambda n: F.greatest(F.lit(0), F.ceil(n * percent / 100) - 1)


def interpolated(df: DataFrame, by: list[str], value: str, qs: dict[str, float]) -> DataFrame:
    """Linear-interpolated percentiles (the exact SQL ``percentile``)."""
    idx = {}
    for name, q in qs.items():
        idx[f"_lo_{name}"] = (lambda q: lambda n: F.floor(F.lit(q) * (n - 1)))(q)
        idx[f"_hi_{name}"] = (lambda q: lambda n: F.ceil(F.lit(q) * (n - 1)))(q)
    s = order_statistics(df, by, value, idx)
    cols = []
    for name, q in qs.items():
        pos = F.lit(q) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        mixed = (F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi
        cols.append(F.when(F.ceil(pos) == F.floor(pos), lo).otherwise(mixed).cast("double").alias(name))
    return s.select(*by, "n", *cols)


def average_ranks(df: DataFrame, by: list[str], value: str, out: str) -> DataFrame:
    """Ascending average rank (ties share the mean) attached to every row."""
    r = value_ranks(df, by, value)
    r = r.select(*by, value, (F.col("n_less") + (F.col("n") + 1) / 2).alias(out))
    return df.join(r, by + [value], "left")


def ordinals(df: DataFrame, by: list[str], value: str, tie: str, out: str) -> DataFrame:
    """Zero-based position in (value, tie) order inside each group, groups of any size: rows
    below the value are counted, and only rows sharing it are ordered together."""
    r = value_ranks(df, by, value).select(*by, value, F.col("n_less").alias("_below"))
    same = Window.partitionBy(*by, value).orderBy(tie)
    return (df.join(r, by + [value])
            .withColumn(out, F.col("_below") + F.row_number().over(same) - 1).drop("_below"))
