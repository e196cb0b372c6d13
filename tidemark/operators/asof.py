"""Point-in-time joins and newest-row selection.

``asof_join`` never sorts a key's whole history in one task. Time is cut into buckets:

* buckets that hold labels are found by a map-side-combined count, and only their snapshots
  go on to the join;
* snapshots are ordered inside (key, bucket); the value a bucket starts with is carried over
  from earlier buckets, one row per (key, bucket), so a key costs at most as many rows there
  as it has buckets;
* labels meet intervals in an equi-join on (key, bucket), which Spark broadcasts when the
  intervals are small, and buckets holding more than ``hot_rows`` labels are split further
  by a row hash, with the few intervals of that bucket repeated per split.

Labels do not interact with each other, so splitting them is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_BUCKET_US = {"hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def asof_join(labels: DataFrame, snapshots: DataFrame, on: list[str], label_ts: str = "event_ts",
              snapshot_ts: str = "ts", how: str = "left", keep_ts: str | None = None,
              bucket: str = "day", hot_rows: int = 1_000_000, probe: DataFrame | None = None,
              one_per_bucket: bool = False) -> DataFrame:
    """Attach to each label the newest snapshot of its key with ``snapshot_ts <= label_ts``.

    A label with no such snapshot keeps null features (``how="left"``) or is removed
    (``how="inner"``). Duplicate labels are kept. ``keep_ts`` names a column that reports
    the matched snapshot time. ``probe`` is a cheaper frame with the same (keys, time) rows,
    read to learn which buckets hold labels; chains of lookups pass the original labels so
    the plan grows linearly. ``one_per_bucket`` states that a key has at most one snapshot per
    bucket, as daily tables do: one ordering per key then suffices, and the job fails if the
    statement is wrong.
    """
    if one_per_bucket:
        return asof_join_many(labels, [(snapshots, snapshot_ts, keep_ts)], on, label_ts, how, bucket, hot_rows, probe)
    width = _BUCKET_US[bucket]
    feats = _features(labels, snapshots, on, snapshot_ts, keep_ts)
    need = _buckets_with_labels(labels if probe is None else probe, on, label_ts, width)
    snap = _tagged(snapshots, on, snapshot_ts, width, feats, "_v").withColumn("_start", F.col("_v._at"))
    right = _many_per_bucket(snap.unionByName(need, allowMissingColumns=True), on)
    cond = (f" AND (r._start IS NULL OR r._start <= l.`{label_ts}`)"
            f" AND (r._end IS NULL OR l.`{label_ts}` < r._end)")
    joined = _meet(labels, right, need, on, label_ts, width, hot_rows, how, cond, {"_hit": "r._v"})
    if how == "inner":
        joined = joined.where("_hit IS NOT NULL")
    result = joined.select(*labels.columns, "_hit.*")
    return result.withColumnRenamed("_at", keep_ts) if keep_ts else result.drop("_at")


def asof_join_many(labels: DataFrame, tables: list[tuple[DataFrame, str, str | None]], on: list[str],
                   label_ts: str = "event_ts", how: str = "left", bucket: str = "day", hot_rows: int = 1_000_000,
                   probe: DataFrame | None = None) -> DataFrame:
    """``asof_join`` of several tables with one key at once: (snapshots, their time, ``keep_ts``) each.

    All tables join one timeline per key, ordered once, so labels and snapshots cross one shuffle
    whatever the number of tables. Each table has at most one snapshot per key and bucket.
    ``how="inner"`` keeps labels that have a snapshot in every table.
    """
    width = _BUCKET_US[bucket]
    need = _buckets_with_labels(labels if probe is None else probe, on, label_ts, width)
    rows, seen, picks = need, labels, {}
    for i, (snapshots, ts, keep) in enumerate(tables):
        feats = _features(seen, snapshots, on, ts, keep)
        seen = seen.select("*", *[F.lit(None).alias(c) for c in [*feats, *([keep] if keep else [])]])
        rows = rows.unionByName(_tagged(snapshots, on, ts, width, feats, f"_v{i}"), allowMissingColumns=True)
        picks[f"_hit{i}"] = f"CASE WHEN r._new{i}._at <= l.`{label_ts}` THEN r._new{i} ELSE r._old{i} END"
    right = _one_per_bucket(rows, on, len(tables))
    joined = _meet(labels, right, need, on, label_ts, width, hot_rows, how, "", picks)
    if how == "inner":
        joined = joined.where(" AND ".join(f"{h} IS NOT NULL" for h in picks))
    out = [F.col(f"`{c}`") for c in labels.columns]
    for h, (snapshots, ts, keep) in zip(picks, tables):
        out += [F.col(f"{h}.`{c}`") for c in snapshots.columns if c not in on and c != ts]
        out += [F.col(f"{h}._at").alias(keep)] if keep else []
    return joined.select(*out)


def _quoted(names: list[str]) -> list[str]:
    return [f"`{c}`" for c in names]


def _bucket_of(ts: str, width: int) -> str:
    return f"CAST(floor(unix_micros(`{ts}`) / {width}) AS BIGINT) AS _b"


def _features(labels: DataFrame, snapshots: DataFrame, on: list[str], ts: str, keep_ts: str | None) -> list[str]:
    """The columns a table adds to the labels; they must be new there."""
    feats = [c for c in snapshots.columns if c not in on and c != ts]
    clash = sorted({*feats, *([keep_ts] if keep_ts else [])} & set(labels.columns))
    if clash:
        raise ValueError(f"label frame already has columns {clash}")
    return feats


def _buckets_with_labels(labels: DataFrame, on: list[str], label_ts: str, width: int) -> DataFrame:
    return (labels.selectExpr(*_quoted(on), _bucket_of(label_ts, width)).where("_b IS NOT NULL")
            .groupBy(*on, "_b").agg(F.count(F.lit(1)).alias("_n")))


def _tagged(snapshots: DataFrame, on: list[str], ts: str, width: int, feats: list[str], name: str) -> DataFrame:
    """(keys, bucket, one struct of features and time) of a snapshot table."""
    body = ", ".join(_quoted(feats) + [f"`{ts}` AS _at"])
    return snapshots.where(f"`{ts}` IS NOT NULL").selectExpr(*_quoted(on), _bucket_of(ts, width), f"struct({body}) AS {name}")


def _meet(labels: DataFrame, intervals: DataFrame, need: DataFrame, on: list[str], label_ts: str, width: int,
          hot_rows: int, how: str, cond: str, picks: dict[str, str]) -> DataFrame:
    """Labels with the picked columns of the intervals of their key and bucket; hot buckets are split."""
    key = on + ["_b"]
    right = intervals.selectExpr("*", f"explode(sequence(0, CAST((_n - 1) DIV {hot_rows} AS INT))) AS _salt")
    # At most labels / hot_rows rows; Spark sends them to every task only if they are small.
    hot = (need.where(f"_n > {hot_rows}")
           .selectExpr(*_quoted(key), f"(_n - 1) DIV {hot_rows} + 1 AS _splits"))
    row = ", ".join(_quoted(_hashable(labels)))
    left = (labels.selectExpr("*", _bucket_of(label_ts, width)).join(hot, key, "left")
            .selectExpr(*_quoted(labels.columns), "_b",
                        f"CAST(coalesce(pmod(xxhash64({row}), _splits), 0) AS INT) AS _salt"))
    same = " AND ".join(f"l.`{k}` = r.`{k}`" for k in key + ["_salt"])
    return (left.alias("l").join(right.alias("r"), F.expr(same + cond), how)
            .selectExpr("l.*", *[f"{e} AS {n}" for n, e in picks.items()]).drop("_b", "_salt"))


def _one_per_bucket(rows: DataFrame, on: list[str], tables: int) -> DataFrame:
    """One row per bucket that holds labels: for each table its own snapshot and the newest one before it."""
    by = f"PARTITION BY {', '.join(_quoted(on))} ORDER BY _b RANGE BETWEEN"
    here = f"OVER ({by} CURRENT ROW AND CURRENT ROW)"
    per = [f"last(_v{i}, true) OVER ({by} UNBOUNDED PRECEDING AND 1 PRECEDING) AS _old{i}" for i in range(tables)]
    per += [f"last(_v{i}, true) {here} AS _new{i}" for i in range(tables)]
    most = [f"count(_v{i}) {here}" for i in range(tables)]
    r = rows.selectExpr(*_quoted(on), "_b", "_n", *per,
                        f"{f'greatest({chr(44).join(most)})' if tables > 1 else most[0]} AS _c")
    fail = "raise_error('more than one snapshot in a bucket')"
    return r.where("_n IS NOT NULL").where(f"CASE WHEN _c > 1 THEN {fail} ELSE true END").drop("_c")


def _many_per_bucket(rows: DataFrame, on: list[str]) -> DataFrame:
    """Validity intervals [_start, _end) inside buckets that hold labels, including the value a
    bucket starts with (null ``_start``). Only one row per (key, bucket) is ordered per key."""
    key = [f"`{c}`" for c in on] + ["_b"]
    by = ", ".join(key)
    # A label row sorts first, so its ``_end`` is the bucket's first snapshot time.
    w = rows.selectExpr("*", f"lead(_start) OVER (PARTITION BY {by} ORDER BY _start NULLS FIRST) AS _end",
                        f"max(_n) OVER (PARTITION BY {by}) AS _labels")
    inside = w.where("_n IS NULL AND _labels IS NOT NULL").selectExpr(*key, "_start", "_end", "_v", "_labels AS _n")
    edge = w.where("_n IS NOT NULL OR _end IS NULL").select(*on, "_b", "_n", "_end", "_v")
    per_key = f"PARTITION BY {', '.join(key[:-1])} ORDER BY _b"
    carried = (edge.selectExpr(*key, "_n", "_end",
                               f"last(_v, true) OVER ({per_key} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _v")
               .where("_n IS NOT NULL AND _v IS NOT NULL"))
    return inside.unionByName(carried, allowMissingColumns=True)


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]


def latest_per_key(df: DataFrame, keys: list[str], ts: str = "ts", tie: list[str] | None = None,
                   keep_ts: bool = False) -> DataFrame:
    """Newest row per key. The rank filter is pushed below the shuffle by Spark, so a hot key
    sends one row per map task."""
    order = [F.col(ts).desc()] + [F.col(c).desc() for c in tie or []]
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return out if keep_ts else out.drop(ts)


def snapshot_in_force(df: DataFrame, keys: list[str], as_of: Column, ts: str = "ts") -> DataFrame:
    """Newest snapshot at or before ``as_of``; if none exists at all, the earliest snapshot date.

    One pass: rows past the cut are usable only when they carry the table's first date and
    nothing precedes the cut.
    """
    first = df.agg(F.min(ts)).scalar()
    cut = F.greatest(as_of, first)
    return latest_per_key(df.where(F.col(ts) <= cut), keys, ts)


def lookup_latest(df: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Left equi-join on a one-row-per-key table."""
    clash = sorted((set(table.columns) - set(on)) & set(df.columns))
    if clash:
        raise ValueError(f"frame already has columns {clash}")
    return df.join(table, on, "left")


def asof_by_rank(labels: DataFrame, snapshots: DataFrame, on: list[str], row_id: str,
                 label_ts: str = "event_ts", snapshot_ts: str = "ts") -> DataFrame:
    """The quadratic definition (join on key, rank by time); kept as a cross-check only."""
    s = snapshots.withColumnRenamed(snapshot_ts, "_sts")
    j = labels.join(s, on).where(F.col("_sts") <= F.col(label_ts))
    w = Window.partitionBy(row_id).orderBy(F.col("_sts").desc())
    return j.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_sts")
