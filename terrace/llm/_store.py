"""Shared scratch tables: what cuts lineage is a Parquet table in the cluster's shared folder.

The folder is the session's ``spark.checkpoint.dir``; only where that is unset and the master is local (tests) is a
temporary folder made: on a cluster it has to be set. Tables are removed when the Python session ends, or earlier with ``drop``.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import tempfile
import time
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes of one Arrow batch: documents can be long, so batches are kept short.
ARROW_ROWS, ARROW_BYTES = 1024, 4 << 20
#: The folder that holds this package.
HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


_TEMPORARY: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as a URI without a trailing slash."""
    own = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not own:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _TEMPORARY:
            _TEMPORARY.append("file://" + tempfile.mkdtemp(prefix="terrace-"))
        own = _TEMPORARY[0]
    where, files = hadoop_path(spark, own)
    return files.makeQualified(where).toString().replace("file:/", "file:///", 1).replace("file://///", "file:///", 1).rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small, and let Python workers find this package where it lies.

    Both affect only the exchange with Python workers.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def hadoop_path(spark: SparkSession, path: str):
    """The JVM's path object and its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store; a missing one is no error."""
    with contextlib.suppress(Exception):
        where, files = hadoop_path(spark, path)
        files.delete(where, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished jobs before more are written.

    The cleaner follows the collection of their plans, in Python first and then in the JVM, and works by itself:
    it is given a moment, twice, as the first collection frees what the second one finds.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(1)


_OWN: dict = {}


def hand_back() -> None:
    """Return freed memory to the machine: workers stay between tasks, and so would what their allocators hold."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(Exception):  # where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def claim(owner: str) -> None:
    """Forget what another operator has kept in this worker."""
    if _OWN and _OWN.get("owner") != owner:
        _OWN.clear()
        gc.collect()
        hand_back()
    _OWN["owner"] = owner


def tidy(kernel):
    """A kernel over batches that drops what other operators have kept, and hands memory back when its task ends."""
    owner = kernel.__module__

    def run(batches):
        claim(owner)
        try:
            yield from kernel(batches)
        finally:
            hand_back()

    return run


def worker_own(name, make):
    """What an operator keeps in its Python worker from task to task. A worker keeps one operator's at a time, so that the
    stages of a pipeline, which share workers, do not add up."""
    if name not in _OWN:
        owner = _OWN.get("owner")
        if len(_OWN) > 1:
            _OWN.clear()
            gc.collect()
            hand_back()
        _OWN.update({"owner": owner, name: make()})
    return _OWN[name]


class Scratch:
    """A family of scratch tables under one unique folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(remove, spark, self.root)

    def path(self, tag: str) -> str:
        return f"{self.root}/{tag}"

    def save(self, df: DataFrame, tag: str) -> DataFrame:
        """Write ``df`` and read it again: downstream work restarts from here when an executor is lost."""
        schema = df.schema
        df.write.mode("overwrite").parquet(self.path(tag))
        return self.spark.read.schema(schema).parquet(self.path(tag))

    def drop(self, tag: str) -> None:
        remove(self.spark, self.path(tag))
