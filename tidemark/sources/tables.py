"""Reading and writing parquet tables, and keyed tables that are patched bucket by bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType

from ..session import materialize
from .changes import diff_rows, differing_buckets, merge_rows, replace_rows, same_schema


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def export_training_set(training: DataFrame, path: str, extra: DataFrame | None = None,
                        keys: list[str] | None = None) -> str:
    """Write a training set as snappy parquet, optionally re-attaching side columns.

    The write fails when a side key repeats or is missing, so rows can neither multiply nor
    lose their weight.
    """
    from ..plans.training import reattach
    if extra is not None:
        if not keys:
            raise ValueError("keys are required with extra columns")
        training = reattach(training, extra, keys)
    out = f"{path.rstrip('/')}/training_set"
    training.write.mode("overwrite").option("compression", "snappy").parquet(out)
    return out


class BucketedTable:
    """Rows in parquet folders by a hash of ``by`` (default: the keys), and the rows that each write changed.

    A write reads, compares and overwrites only the folders it touches, by Spark's dynamic partition
    overwrite. Change rows of write ``n`` are stored under ``changes/batch=n`` before the rows
    themselves; a write that fails half-way and is run again is reported twice at most, never missed,
    and leaves the same rows. One writer at a time. ``keys`` identify a row. A table keeps the number
    of buckets it was created with.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], by: list[str] | None = None, buckets: int = 64):
        self.spark, self.root, self.keys, self.by, self.buckets = spark, root.rstrip("/"), keys, by or keys, buckets

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _there(self, name: str) -> bool:
        fs, path = self._path(name)
        return fs.exists(path)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def _stored(self) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.root}/schema").schema
        return self.spark.read.schema(schema.add("__bucket", IntegerType())).parquet(f"{self.root}/rows")

    def read(self) -> DataFrame:
        return self._stored().drop("__bucket")

    def create(self, df: DataFrame) -> None:
        """All rows anew; nothing is reported as changed."""
        rows = materialize(df.withColumn("__bucket", self.bucket()), "bucketed-rows")
        df.limit(0).write.mode("overwrite").parquet(f"{self.root}/schema")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("__bucket").parquet(f"{self.root}/rows")

    def _touched(self, rows: DataFrame) -> list[int]:
        """Numbers of the buckets of some rows: at most as many as there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def _patch(self, touched: list[int], change: Callable[[DataFrame], DataFrame]) -> int:
        """Overwrites the touched buckets that ``change`` makes differ; returns how many."""
        if not touched:
            return 0
        old = self._stored().where(F.col("__bucket").isin(touched))
        new = materialize(change(old.drop("__bucket")).withColumn("__bucket", self.bucket()), "bucketed-rows")
        diff = materialize(diff_rows(old, new, [*self.keys, "__bucket"]), "bucketed-changes")
        now = {r[0]: r[1] for r in diff.groupBy("__bucket").agg(F.count_if(F.col("change_type") != "delete")).collect()}
        if not now:
            return 0
        batch = self.latest() + 1
        (diff.drop("__bucket").withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(f"{self.root}/changes"))
        kept = {r[0] for r in new.where(F.col("__bucket").isin(list(now))).select("__bucket").distinct().collect()}
        (new.where(F.col("__bucket").isin(list(now))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("__bucket").parquet(f"{self.root}/rows"))
        for b in set(now) - kept:  # an emptied bucket has no rows that would replace it
            fs, path = self._path(f"rows/__bucket={b}")
            fs.delete(path, True)
        return len(now)

    def upsert(self, updates: DataFrame) -> int | None:
        """Create when absent, merge when (name, type) pairs match, create anew otherwise (None)."""
        if not self._there("schema") or not same_schema(self.read(), updates):
            self.create(updates)
            return None
        return self._patch(self._touched(updates), lambda old: merge_rows(old, updates, self.keys))

    def replace(self, keys: DataFrame, rows: DataFrame, on: list[str]) -> int:
        """Partial overwrite of the listed keys (of the columns ``by``); an empty list leaves the table as it is."""
        return self._patch(self._touched(keys), lambda old: replace_rows(old, keys, rows, on))

    def overwrite(self, df: DataFrame) -> int:
        """All rows anew, of which only the buckets with another content are joined and written."""
        fresh = materialize(df, "bucketed-new")
        touched = differing_buckets(self.read(), fresh, self.bucket())
        return self._patch(touched, lambda old: fresh.where(self.bucket().isin(touched)))

    def latest(self) -> int:
        """Number of the last write that changed rows."""
        if not self._there("changes"):
            return 0
        return self.spark.read.parquet(f"{self.root}/changes").agg(F.coalesce(F.max("batch"), F.lit(0))).first()[0]

    def changes(self, since: int = 0) -> DataFrame:
        """Change rows of the writes after number ``since``."""
        if not self._there("changes"):
            return self.read().limit(0).withColumns({"change_type": F.lit(None).cast("string"), "batch": F.lit(0)})
        return self.spark.read.parquet(f"{self.root}/changes").where(F.col("batch") > since)
