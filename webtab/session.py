"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings a job should start with. Everything else is left to the cluster.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # HTML cells are wide: keep the batches handed to Python small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# the folder of the job that runs, if it is one that cleans up after itself
_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)
_local_dir: str | None = None


def build_session(name: str = "webtab", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables, shared by all executors.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder of its own.
    """
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="webtab-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def _file_system(spark: SparkSession, path: str):
    """The store that holds ``path``, and the path as it names it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _file_system(spark, path)
    return store.exists(where)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """What is written to the scratch area inside goes to one folder, deleted at the end, also on failure.

    Nothing that is still to be computed may read it afterwards.
    """
    folder = f"{scratch_root(spark)}/webtab/run-{uuid.uuid4().hex}"
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        store, where = _file_system(spark, folder)
        store.delete(where, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{_run_folder.get() or scratch_root(spark) + '/webtab'}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back.

    This cuts the lineage, survives the loss of executors, and gives the
    planner true sizes and prunable columns for whatever follows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
