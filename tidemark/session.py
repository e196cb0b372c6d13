"""Session defaults and the shared folder for written intermediates."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: The setting that names the folder which driver and executors share.
SHARED = "spark.checkpoint.dir"
_local_root: list[str] = []
_made: list[str] = []
#: How often ``release`` has removed what was written; what is kept by a caller is void after it.
_releases = [0]


def generation() -> int:
    return _releases[0]


def build_session(app: str = "tidemark", **conf: str) -> SparkSession:
    """Session with the settings every job here assumes: UTC clock and adaptive execution.

    Shuffle partition count, memory, master and the shared folder are left to the cluster unless
    passed in.
    """
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; on a cluster it has to be set.

    Where everything runs in one process a folder of its own is made, and removed when that ends.
    """
    root = spark.conf.get(SHARED, None)
    if root:
        return root
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"{SHARED} must name a shared folder on a cluster")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="spark-"))
        atexit.register(shutil.rmtree, _local_root[0], ignore_errors=True)
    return _local_root[0]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared root; ``release`` removes all that were given out."""
    path = os.path.join(shared_root(spark), f"{label}-{uuid.uuid4().hex[:12]}")
    _made.append(path)
    return path


def materialize(df, label: str):
    """Cut lineage by writing to the shared folder and reading back."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_all(frames: dict) -> dict:
    """``materialize`` of independent frames at the same time, so that a small one does not hold up the others."""
    if not frames:
        return {}
    # Threads of the session carry its job group and settings.
    spark = next(iter(frames.values())).sparkSession
    with ThreadPoolExecutor(min(8, len(frames))) as pool:
        jobs = {name: pool.submit(inheritable_thread_target(spark)(materialize), df, name) for name, df in frames.items()}
        return {name: job.result() for name, job in jobs.items()}


def discard(spark: SparkSession, path: str) -> None:
    """Removes one folder given out before; a frame that reads it is void."""
    _made.remove(path)
    _delete(spark, path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> int:
    """Removes every intermediate written so far; frames that read them are void. Returns how many."""
    n = len(_made)
    _releases[0] += 1
    while _made:
        _delete(spark, _made.pop())
    return n
