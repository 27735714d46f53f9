"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a staged table up to which Spark may broadcast it: compressed, so that what it unpacks to stays small.
SMALL = 256 << 10

#: Bytes of a staged table from which the shuffles that made it are given back at once.
LARGE = 16 << 20

#: Only for a local master, whose executors are the driver's own threads.
LOCAL_FOLDER = "file:///tmp/checkpoints/loomgraph"

_owner: ContextVar[str] = ContextVar("owner", default="")
_owned: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; without one a folder of this machine, but only for a local master."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return LOCAL_FOLDER


def _file(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stage(df: DataFrame, name: str, merge: bool = True) -> DataFrame:
    """df written as Parquet and read again, so that loops don't grow the plan and lost executors don't matter.

    Spark takes the size of the compressed files for that of the table, and would broadcast millions of rows that
    compress well; so, with `merge`, a table of more than SMALL bytes is joined by a merge unless the other side is broadcast.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    target, files = _file(spark, path)
    files.deleteOnExit(target)
    if _owner.get():
        _owned.setdefault(_owner.get(), []).append(path)
    out = spark.read.schema(df.schema).parquet(path)
    size = files.getContentSummary(target).getLength()
    if merge and size > SMALL:
        out = out.hint("merge")
    if size > LARGE:
        free_shuffles(spark)
    out._staged_path = path
    return out


def free_shuffles(spark: SparkSession) -> None:
    """Shuffles that nothing reads any more go at once: Spark deletes their files only when the driver's JVM has collected what reads them."""
    spark.sparkContext._jvm.System.gc()


def drop(*staged: DataFrame) -> None:
    """Deletes what stage() returned, once nothing reads it any more."""
    for df in staged:
        target, files = _file(df.sparkSession, df._staged_path)
        files.delete(target, True)


@contextmanager
def owned(owner: str) -> Iterator[None]:
    """What is staged inside belongs to owner, whose tables release() deletes together."""
    token = _owner.set(owner)
    try:
        yield
    finally:
        _owner.reset(token)


def release(spark: SparkSession, owner: str, still_read: DataFrame) -> None:
    """Deletes the tables of owner, but for those that still_read reads."""
    paths = _owned.pop(owner, [])
    kept = " ".join(still_read.inputFiles()) if paths else ""
    for path in paths:
        if path.rsplit("/", 1)[1] in kept:
            _owned.setdefault(owner, []).append(path)
        else:
            target, files = _file(spark, path)
            files.delete(target, True)
