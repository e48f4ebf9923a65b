"""Where jobs may write: the shared folder that the session names, and what they leave on disk."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from uuid import uuid4

from pyspark.sql import SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"
# Half of a stored row is hex digits of surrogate keys, which this codec packs and the default one does not.
COMPRESSION = "zstd"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="hotdesk-")


def one_process(spark: SparkSession) -> bool:
    """Whether driver and executor are one process (``local``, ``local[8]``; not ``local-cluster``)."""
    return spark.conf.get("spark.master", "").split("[")[0] == "local"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach; only local runs may go without one."""
    folder = spark.conf.get(SHARED_FOLDER, None)
    if folder:
        return folder.rstrip("/")
    if one_process(spark):
        return _local_folder()
    raise ValueError(f"set {SHARED_FOLDER} to a folder that every executor can reach")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder (not yet created)."""
    return f"{shared_folder(spark)}/hotdesk/{purpose}-{uuid4().hex[:12]}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder with all that is in it, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a job go when the job has ended.

    Otherwise they stay until the driver happens to collect its garbage, so that a run of many
    jobs keeps those of all of them.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
