"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a private one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        _own_folders[app] = tempfile.mkdtemp(prefix="claimspan-")
    return _own_folders[app]


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within the ``with`` block every execution deletes its shuffle files when it ends.

    They stay until the driver happens to collect its garbage otherwise, so the disks hold
    those of all steps so far. For writes, and for results that are collected once: a
    DataFrame that is run a second time would have to shuffle again.
    """
    before = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Compute ``df`` once, store it in the shared folder and read it back.

    The copy survives lost executors and is not recomputed by later steps. Its
    stored size is known to the optimizer, so a join broadcasts it only when
    that size is under ``spark.sql.autoBroadcastJoinThreshold``, and shuffles
    (with skew splitting) otherwise.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A ``written`` whose tables are deleted at the end of the ``with`` block.

    For work that is done by then: a DataFrame that is still to be read must not
    depend on them.
    """
    root = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"

    def store(df: DataFrame, label: str) -> DataFrame:
        path = f"{root}/{label}-{uuid.uuid4().hex}"
        with shuffles_freed(spark):
            df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield store
    finally:
        where = spark._jvm.org.apache.hadoop.fs.Path(root)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
