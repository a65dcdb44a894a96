"""Shared working folder: intermediate tables and stream progress live there."""

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_local_folders: dict[str, str] = {}
_scopes = threading.local()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="cashtide-")
    return _local_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage so that a lost executor does not replay the work before it, and gives the
    planner true sizes for choosing between broadcast and shuffle joins.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    if getattr(_scopes, "open", None):
        _scopes.open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread materializes inside are deleted at the end.

    For work whose results are all written before it ends, as the batches of a stream.
    """
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    _scopes.open.append([])
    try:
        yield
    finally:
        for path in _scopes.open.pop():
            delete(spark, path)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
