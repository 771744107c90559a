"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Functions and processors of this package travel to the executors themselves, so that those (and
# the worker in which Spark prepares a stream's processors) need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules["keyflow"])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# What results depend on: the time zone, and a state store that spills to disk.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def configure(spark: SparkSession) -> SparkSession:
    """Sets a session up for the package, for good."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def configured(spark: SparkSession) -> Iterator[SparkSession]:
    """The same for the time in which tables are put together or streams run; then the caller's settings are back.

    Expressions keep the time zone that was set when they were made.
    """
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    try:
        yield configure(spark)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


# How many tasks list folders. Unless told, Spark takes one for each folder.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """While tables of very many folders are opened: these are listed by a few tasks for each core."""
    before = spark.conf.get(LISTING, None)
    spark.conf.set(LISTING, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before) if before is not None else spark.conf.unset(LISTING)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder, ``spark.checkpoint.dir``.

    Where driver and executors are one machine and nothing is configured, a temporary folder serves,
    which is removed when the program ends. On a cluster the setting must be there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and the executors of {master} share")
        base = tempfile.mkdtemp(prefix="keyflow-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base}/keyflow-{label}-{uuid.uuid4().hex}"


def drop(spark: SparkSession, path: str) -> None:
    """Removes a scratch folder that nothing can need any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
