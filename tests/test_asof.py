import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.asof import asof_by_rank, asof_join, asof_join_many, latest_per_key, snapshot_in_force
from tidemark.plans.training import Lookup, training_set

T0 = dt.datetime(2024, 1, 10, 12)
US = dt.timedelta(microseconds=1)


def frames(spark, labels, snaps):
    lab = spark.createDataFrame(labels, "k string, id int, event_ts timestamp")
    sn = spark.createDataFrame(snaps, "k string, ts timestamp, v int")
    return lab, sn


@pytest.mark.parametrize("one", [True, False])
def test_edges(spark, one):
    day = dt.timedelta(days=1)
    lab, sn = frames(spark,
                     [("a", 1, T0), ("a", 2, T0 - US), ("a", 3, T0 + US), ("b", 4, T0), ("a", 5, T0 + 9 * day),
                      ("a", 1, T0), (None, 6, T0)],
                     [("a", T0 - 3 * day, 1), ("a", T0, 2), ("c", T0, 9)])
    got = rows(asof_join(lab, sn, ["k"], one_per_bucket=one), "id", F.coalesce("v", F.lit(-1)))
    assert got == [(1, 2), (1, 2), (2, 1), (3, 2), (4, -1), (5, 2), (6, -1)]
    assert asof_join(lab, sn, ["k"], how="inner", one_per_bucket=one).count() == 5


def test_matched_time_and_clash(spark):
    lab, sn = frames(spark, [("a", 1, T0)], [("a", T0 - dt.timedelta(days=40), 7)])
    r = asof_join(lab, sn, ["k"], keep_ts="seen").first()
    assert r["v"] == 7 and r["seen"] == T0 - dt.timedelta(days=40)
    with pytest.raises(ValueError):
        asof_join(lab.withColumn("v", F.lit(1)), sn, ["k"])


def test_two_snapshots_in_a_day_break_the_daily_promise(spark):
    lab, sn = frames(spark, [("a", 1, T0)], [("a", T0 - 2 * US, 1), ("a", T0 - US, 2)])
    assert asof_join(lab, sn, ["k"]).first()["v"] == 2
    with pytest.raises(Exception, match="more than one snapshot"):
        asof_join(lab, sn, ["k"], one_per_bucket=True).collect()


def test_hot_key_is_split_and_exact(spark):
    """A key with most of the labels and many snapshots, split into tiny pieces, against brute force."""
    lab = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "cold").otherwise("hot").alias("k"), F.col("id"),
        F.timestamp_seconds(1704067200 + F.col("id") * 7919 % 400000).alias("event_ts"))
    sn = spark.range(900).select(
        F.when(F.col("id") % 5 == 0, "cold").otherwise("hot").alias("k"),
        F.timestamp_seconds(1704067200 + F.col("id") * 443).alias("ts"), F.col("id").alias("v"))
    a = asof_join(lab, sn, ["k"], hot_rows=50)
    assert a.count() == 4000
    b = asof_by_rank(lab, sn, ["k"], "id")
    assert a.where("v is not null").exceptAll(b.select(*a.columns)).count() == 0
    assert a.where("v is not null").count() == b.count()
    assert asof_join(lab, sn, ["k"], bucket="hour", hot_rows=9).exceptAll(a).count() == 0


def daily(spark, name, step, shift):
    """One snapshot a key and day, on some days only."""
    return spark.range(200).select(
        F.concat(F.lit("k"), (F.col("id") % 7).cast("string")).alias("k"),
        F.timestamp_seconds(1704067200 + F.floor(F.col("id") / 7) * 86400 * step + shift).alias("ts"),
        F.col("id").alias(name), F.when(F.col("id") % 4 > 0, F.col("id") * 2).alias(f"{name}2"))


def many_labels(spark):
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), (F.col("id") % 8).cast("string"))).otherwise("k1").alias("k"),
        (F.col("id") % 5).alias("j"), F.col("id"),
        F.timestamp_seconds(1704000000 + F.col("id") * 7919 % 4000000).alias("event_ts"))


@pytest.mark.parametrize("hot_rows", [1_000_000, 40])
def test_several_tables_at_once_as_one_after_the_other(spark, hot_rows):
    lab, a, b = many_labels(spark), daily(spark, "a", 1, 0), daily(spark, "b", 3, 40000)
    got = asof_join_many(lab, [(a, "ts", None), (b.withColumnRenamed("ts", "at"), "at", "b_ts")], ["k"], hot_rows=hot_rows)
    want = asof_join(asof_join(lab, a, ["k"]), b, ["k"], keep_ts="b_ts")
    assert got.columns == want.columns and got.count() == 3000
    assert got.exceptAll(want).count() == 0
    both = asof_join_many(lab, [(a, "ts", None), (b, "ts", None)], ["k"], how="inner", hot_rows=hot_rows)
    assert both.count() == want.where("a is not null and b is not null").count()
    with pytest.raises(ValueError):
        asof_join_many(lab, [(a, "ts", None), (a, "ts", None)], ["k"])
    empty = asof_join_many(lab.limit(0), [(a, "ts", None), (b, "ts", None)], ["k"])
    assert empty.count() == 0
    none = asof_join_many(lab, [(a.limit(0), "ts", None), (b, "ts", None)], ["k"])
    assert none.where("a is not null").count() == 0 and none.where("b is not null").count() > 0


def test_training_set_orders_columns_by_lookup_and_shuffles_labels_once_a_key(spark):
    lab, a, b, c = many_labels(spark), daily(spark, "a", 1, 0), daily(spark, "b", 3, 40000), daily(spark, "c", 2, 5)
    c = c.withColumn("j", F.col("c") % 5).drop("k").groupBy("j", "ts").agg(F.max("c").alias("c"))
    looks = [Lookup(a, ["k"], "ts"), Lookup(c, ["j"], "ts"), Lookup(b, ["k"], "ts", columns=["b2"])]
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = training_set(lab, looks, [], "event_ts", exclude=["id", "a2"])
        assert got.columns == ["k", "j", "event_ts", "a", "c", "b2"]
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join LeftOuter") == 4  # for each key: labels to intervals, and to hot buckets
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = asof_join(asof_join(asof_join(lab, a, ["k"]), c, ["j"]), b.select("k", "ts", "b2"), ["k"])
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == 3000


def test_latest_and_in_force(spark):
    _, sn = frames(spark, [("a", 1, T0)], [("a", T0, 1), ("a", T0 + US, 2), ("b", T0, 3)])
    assert rows(latest_per_key(sn, ["k"]), "k", "v") == [("a", 2), ("b", 3)]
    early = snapshot_in_force(sn, ["k"], F.lit("2020-01-01").cast("timestamp"))
    assert rows(early, "k", "v") == [("a", 1), ("b", 3)]
