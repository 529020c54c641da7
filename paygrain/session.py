"""Session settings the library is written for."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime re-planning does three jobs here: it merges small shuffle partitions,
# turns a sort-merge join into a broadcast join once the measured side is small,
# and splits a partition that one hot key has made too large.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles here are often followed by an expansion (ranges to days, employments to
    # periods to rules), so small partitions are merged only as far as idle cores allow.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "paygrain", master: str | None = None, **extra: str) -> SparkSession:
    """Create a session with the library's settings; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="paygrain-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or else the default file system's.

    Only a session whose executors are threads of this process (master ``local``) may fall back on a
    temporary folder of this machine, one per process. Elsewhere that would scatter parts over the
    executors' disks, so it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    store = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if not store.startswith("file:"):
        return f"{store.rstrip('/')}/tmp"
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return _local_dir()
    raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, in the folder of this application's run."""
    return f"{shared_dir(spark)}/paygrain/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
