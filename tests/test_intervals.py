from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.intervals import interval_join

T0 = 1704067200


def seconds(c):
    return F.timestamp_seconds(c)


def test_edges_overlaps_and_open_ends(spark):
    p = spark.createDataFrame([("a", 1, 100), ("a", 2, 200), ("a", 3, 10 ** 7), ("b", 4, 100), (None, 5, 100), ("a", 6, None), ("a", 1, 100)],
                              "k string, i long, t long").withColumn("at", seconds("t"))
    v = spark.createDataFrame([("a", 100, 200, 1), ("a", 200, None, 2), ("a", 0, 101, 3), ("a", None, 500, 4), ("a", 300, 300, 5),
                               ("a", 2 * 10 ** 7, None, 6), ("c", 0, None, 7)], "k string, s long, e long, v long")
    v = v.select("k", seconds("s").alias("lo"), seconds("e").alias("hi"), "v")
    for days in (1, 30):
        got = Counter((r.i, r.v) for r in interval_join(p, v, ["k"], "at", "lo", "hi", days).collect())
        assert got == Counter({(1, 1): 2, (1, 3): 2, (2, 2): 1, (3, 2): 1})
    assert interval_join(p.limit(0), v, ["k"], "at", "lo", "hi").count() == 0
    assert interval_join(p, v.limit(0), ["k"], "at", "lo", "hi").count() == 0
    with pytest.raises(ValueError):
        interval_join(p, v.withColumn("i", F.lit(1)), ["k"], "at", "lo", "hi")


def test_a_hot_key_with_many_intervals_is_split_by_time(spark):
    """A third of the points and 100,000 back-to-back intervals under one key."""
    n, step = 100_000, 600
    v = spark.range(n).select(F.lit("hot").alias("k"), seconds(T0 + F.col("id") * step).alias("lo"),
                              seconds(T0 + (F.col("id") + 1) * step).alias("hi"), F.col("id").alias("v"))
    p = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
                                   F.col("id").alias("i"), (F.pmod(F.xxhash64("id"), F.lit(n * step)).cast("long")).alias("off"))
    p = p.withColumn("at", seconds(T0 + F.col("off")))
    got = interval_join(p, v, ["k"], "at", "lo", "hi", days=1)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_b" in plan and "Cartesian" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 30_000 and got.where(F.col("v") != F.floor(F.col("off") / step)).count() == 0
    assert v.withColumn("b", F.floor(F.unix_seconds("lo") / 86400)).groupBy("b").count().agg(F.max("count")).first()[0] <= 86400 // step
