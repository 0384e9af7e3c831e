"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# Settings the library is meant to run with. They go to the builder or to spark-submit.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}

# Keeps streaming state off the heap; used when a stateful query is started.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def delta_conf() -> dict[str, str]:
    """Session settings for Delta tables; the Delta jar has to be on the classpath."""
    return {
        "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
        "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    }


def object_store_conf(
    endpoint: str, *, path_style: bool = True, ssl: bool = False
) -> dict[str, str]:
    """S3A settings for an S3-compatible store. Credentials come from the S3A provider chain."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="rowtide-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session, which has no other machines, falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


_made: list[str] = []


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing path below the shared folder.

    What is written there serves the results that were made from it, so it stays until
    ``remove_scratch``.
    """
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Removes all that was written under ``scratch`` paths so far, when its results are no longer
    read."""
    conf = spark._jsc.hadoopConfiguration()
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def defaults(spark: SparkSession, conf: dict[str, str]):
    """Session settings for the length of a block, where the session has none of its own."""
    unset = [name for name in conf if spark.conf.get(name, None) is None]
    for name in unset:
        spark.conf.set(name, conf[name])
    try:
        yield spark
    finally:
        for name in unset:
            spark.conf.unset(name)
