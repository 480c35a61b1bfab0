"""Staged tables: an intermediate result written once to the cluster's shared folder.

A staged table cuts the lineage, survives the loss of executors, and, being Parquet, still lets later reads prune
columns. ``DataFrame.checkpoint`` would compute its last stage twice and keep whole rows. Inside ``scope`` the tables
staged are deleted at the end; others stay until the caller calls ``release``.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own = threading.local()  # staged paths by thread, so that one thread's scope leaves another's tables alone
_local: list[tempfile.TemporaryDirectory] = []  # removed when the process ends


def _paths() -> list[str]:
    return _own.__dict__.setdefault("paths", [])


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode with the setting unset.

    On a cluster, a folder on the machine's own disk is refused: other machines would not see it.
    """
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    local = context.master.startswith("local")
    if folder:
        default = spark.conf.get("spark.hadoop.fs.defaultFS", None) or ""
        if not local and (urlparse(folder).scheme or urlparse(default).scheme or "hdfs") == "file":
            raise RuntimeError(f"{SETTING} is {folder}, which executors on other machines do not share")
        return folder
    if not local:
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    _local.append(tempfile.TemporaryDirectory(prefix="souk-staged-", ignore_cleanup_errors=True))
    context.setCheckpointDir(_local[-1].name)
    return _local[-1].name


def staged_path(spark: SparkSession) -> str:
    """A new folder name that is deleted with the staged tables."""
    path = f"{shared_folder(spark).rstrip('/')}/souk-{uuid.uuid4().hex}"
    _paths().append(path)
    return path


def stage(df: DataFrame) -> DataFrame:
    """Run ``df`` once, write it, and return the written table."""
    spark = df.sparkSession
    path = staged_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Tables written inside leave no shuffle files behind: these go as soon as a table is written, and not only when the
    driver collects its garbage."""
    before = spark.conf.get(CLEANED, None)
    spark.conf.set(CLEANED, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANED, before) if before is not None else spark.conf.unset(CLEANED)


def release(spark: SparkSession, keep: int = 0) -> None:
    """Delete the staged tables but for the first ``keep``. Nothing that reads them can run afterwards."""
    context, paths = spark.sparkContext, _paths()
    while len(paths) > keep:
        path = context._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scope(spark: SparkSession, keep_last: bool = False) -> Iterator[None]:
    """Tables staged inside are deleted at the end, so results must be written or collected inside too.

    With ``keep_last`` the table staged last stays, as the result of the steps before it.
    """
    paths = _paths()
    before = len(paths)
    try:
        yield
    finally:
        last = paths.pop() if keep_last and len(paths) > before else None
        release(spark, before)
        if last:
            paths.append(last)
