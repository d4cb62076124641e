"""Session settings and the scratch folder shared by all executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot order may sit on one side of a join that feeds an aggregate on the
    # same key; splitting it is worth the extra exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Lists of keys up to this length reach the parquet scan as they are, not as one range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "200",
    # Batches for Python are cut by size as well: rows hold whole texts of any length.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # Deduplication state of a stream outgrows the heap; keep it on local disk
    # with its changelog in the checkpoint.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "shopstrata", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings this package relies on; ``extra`` adds more or overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the settings on a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files behind.

    They would stay until the driver happens to collect its garbage, so a job of several writes would
    hold the shuffles of all of them at once. ``spark`` is the session of the rows that are written.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors share one machine's disk by construction."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, removed when the driver's JVM ends.

    It lies below ``spark.checkpoint.dir``. Where that is unset, a temporary folder is
    made if the session runs in one process (tests); on a cluster executors would then
    write to disks of their own, so the call is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        folder = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
        return folder
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix=f"{label}-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    return local
