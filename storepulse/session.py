"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state goes to local RocksDB with changelog uploads, so a large
    # seen-set does not live on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "storepulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, key: str, value: str | None):
    """A setting of the session for a while; none is changed without a value."""
    before = spark.conf.get(key)
    if value:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Where the shared folder is kept if `spark.checkpoint.dir` is not set.
_ROOT = "storepulse.work.dir"


def _configured(spark: SparkSession) -> str | None:
    return (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(_ROOT, None))


def use_work_root(spark: SparkSession, path: str) -> None:
    """Name the shared folder of a session that has no `spark.checkpoint.dir`."""
    if not _configured(spark):
        spark.conf.set(_ROOT, path)


def default_work_root(spark: SparkSession) -> None:
    """For tests and trials on one machine: a temporary folder, if none is named.

    On a cluster nothing is set; `work_folder` then refuses to work."""
    if not _configured(spark) and spark.sparkContext.master.split("[")[0] == "local":
        use_work_root(spark, tempfile.mkdtemp(prefix="storepulse-"))


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below `spark.checkpoint.dir`, which every executor can reach."""
    root = _configured(spark)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
