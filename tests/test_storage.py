from pathlib import Path

from pyspark.sql import functions as F

from conftest import rows
from tidemark.session import scratch_dir
from tidemark.sources import changes as C
from tidemark.sources.tables import BucketedTable


def kv(spark, data, kind="int"):
    return spark.createDataFrame(data, f"k int, v {kind}")


def table(spark, by=None, buckets=8):
    return BucketedTable(spark, scratch_dir(spark, "t"), ["k"], by, buckets)


def files(t):
    """Data files by bucket, with the time they were written."""
    return {p.parent.name: {(f.name, f.stat().st_mtime_ns) for f in p.parent.glob("*.parquet")}
            for p in Path(t.root, "rows").glob("__bucket=*/*.parquet")}


def test_upsert(spark):
    t = table(spark)
    assert t.upsert(kv(spark, [(1, 1), (2, 2)])) is None
    assert t.upsert(kv(spark, [(2, 20), (3, 30)])) in (1, 2)
    assert rows(t.read()) == [(1, 1), (2, 20), (3, 30)]
    assert t.upsert(kv(spark, [(2, 20)])) == 0 and t.latest() == 1
    t.upsert(kv(spark, [(9, 9)], "bigint"))
    assert rows(t.read()) == [(9, 9)]
    t.upsert(kv(spark, [], "bigint"))
    assert rows(t.read()) == [(9, 9)]


def test_untouched_buckets_keep_their_files(spark):
    t = table(spark, buckets=8)
    t.create(spark.range(400).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("v")))
    was = files(t)
    assert len(was) == 8
    ids = kv(spark, [(5, 0), (6, 0)]).select(t.bucket()).distinct().collect()
    touched = {f"__bucket={r[0]}" for r in ids}
    t.upsert(kv(spark, [(5, 2), (6, 1)]))  # the second changes nothing
    now = files(t)
    differ = {b for b in was if was[b] != now[b]}
    assert differ <= touched and len(differ) == 1
    t.replace(spark.createDataFrame([(6,)], "k int"), kv(spark, [(6, 9)]), ["k"])
    again = files(t)
    assert {b for b in now if now[b] != again[b]} <= touched
    # A full overwrite joins and writes only what differs.
    assert t.overwrite(t.read().withColumn("v", F.when(F.col("k") == 7, 70).otherwise(F.col("v")))) == 1
    last = files(t)
    assert sum(again[b] != last[b] for b in again) == 1
    assert t.read().count() == 400 and t.read().where("v > 1").count() == 3
    plan = t._stored().where("__bucket in (1, 2)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__bucket" in plan or "PartitionFilters: [__bucket" in plan


def test_changes_start_after_the_write(spark):
    t = table(spark)
    t.create(kv(spark, [(1, 1), (2, 2), (3, None)]))
    assert t.changes().count() == 0 and t.latest() == 0
    t.overwrite(kv(spark, [(1, 1), (2, 5), (4, 4)]))
    assert rows(t.changes(), "k", "v", "change_type") == [
        (2, 5, "update_postimage"), (3, None, "delete"), (4, 4, "insert")]
    t.upsert(kv(spark, [(1, 7)]))
    assert rows(t.changes(1), "k", "v", "change_type") == [(1, 7, "update_postimage")]
    assert t.changes(2).count() == 0 and t.changes().count() == 4


def test_replace_empty_lists_and_emptied_buckets(spark):
    t = BucketedTable(spark, scratch_dir(spark, "t"), ["k", "v"], ["k"], 8)
    t.create(kv(spark, [(1, 1), (1, 2), (2, 3)]))
    one = spark.createDataFrame([(1,)], "k int")
    t.replace(one, kv(spark, [(1, 9)]), ["k"])
    assert rows(t.read()) == [(1, 9), (2, 3)]
    n = t.latest()
    assert t.replace(one.limit(0), kv(spark, []), ["k"]) == 0 and t.latest() == n
    t.replace(one, kv(spark, []), ["k"])
    assert rows(t.read()) == [(2, 3)]
    t.overwrite(kv(spark, []))
    assert rows(t.read()) == [] and rows(t.changes(n), "k", "change_type") == [(1, "delete"), (2, "delete")]
    t.upsert(kv(spark, [(4, 4)]))
    assert rows(t.read()) == [(4, 4)]


def test_a_write_that_failed_half_way_is_run_again(spark):
    """The change rows are there and the rows are not: the next run reports them again and writes them."""
    t = table(spark)
    t.create(kv(spark, [(1, 1), (2, 2)]))
    (kv(spark, [(1, 5)]).withColumns({"change_type": F.lit("update_postimage"), "batch": F.lit(1)})
     .write.partitionBy("batch").parquet(f"{t.root}/changes"))
    t.upsert(kv(spark, [(1, 5)]))
    assert rows(t.read()) == [(1, 5), (2, 2)]
    assert rows(t.changes(), "k", "v", "batch") == [(1, 5, 1), (1, 5, 2)]


def test_incremental_equals_full(spark):
    """Rescore only changed keys, patch the table, and get what a full run gives."""
    score = lambda df: df.select("k", (F.col("v") * 3).alias("v"))
    old = spark.range(200).select(F.col("id").cast("int").alias("k"), (F.col("id") % 17).cast("int").alias("v"))
    new = old.where("k % 41 <> 0").withColumn("v", F.when(F.col("k") % 7 == 0, F.col("v") + 1).otherwise(F.col("v")))
    t = table(spark)
    t.create(score(old))
    keys = C.diff_rows(old, new, ["k"]).select("k")
    t.replace(keys, score(new.join(keys, "k", "left_semi")), ["k"])
    assert rows(t.read()) == rows(score(new))


def test_decisions(spark):
    ch = lambda d: spark.createDataFrame(d, "table_name string, viewer_id long")
    s = F.lit("s")
    run = lambda d, prev: tuple(C.rescoring_decision(ch(d), prev, s).first())
    assert run([("a", 1), ("b", 1), ("a", 2)], s) == ("incremental", "changed viewers only", 2)
    assert run([("r", None)], s)[0:2] == ("full", "rail-grain change")
    assert run([("a", 1)], F.lit("other"))[1] == "scoring configuration changed"
    assert run([("a", 1)], F.lit(None).cast("string"))[1] == "no previous state"
    assert run([], s) == ("incremental", "changed viewers only", 0)


def test_latest_data_version(spark):
    h = spark.createDataFrame([("a", 1, "MERGE"), ("a", 2, "OPTIMIZE"), ("b", 4, "optimize"), ("b", 5, None)],
                              "t string, version long, operation string")
    assert rows(C.latest_data_version(h, ["t"])) == [("a", 1), ("b", 5)]
    assert rows(C.latest_data_version(h.where("operation = 'optimize'"), ["t"])) == [("b", 4)]
