"""Published versions of a set of tables: whole folders, and a pointer that is switched last."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

POINTER = "CURRENT"


def files_of(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file."""
    fs, where = files_of(spark, path)
    out = fs.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if it is not there."""
    fs, where = files_of(spark, path)
    if not fs.exists(where):
        return None
    return "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def current(spark: SparkSession, root: str) -> str:
    """The folder of the published version under ``root``; ``root`` itself if it has no versions."""
    fs, pointer = files_of(spark, f"{root}/{POINTER}")
    if not fs.exists(pointer):
        return root
    return f"{root}/{spark.read.text(f'{root}/{POINTER}').first()[0]}"


def new_version(root: str) -> str:
    """The folder for a version that is yet to be published."""
    return f"{root}/version={uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, version: str) -> None:
    """Make ``version`` the one that readers get, in one step, and delete those before the last one.

    The last version stays, for readers that have begun with it.
    """
    last = current(spark, root)
    fs, fresh = files_of(spark, f"{root}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(version.rsplit("/", 1)[-1].encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fresh, files_of(spark, f"{root}/{POINTER}")[1], over)
    keep = {version.rsplit("/", 1)[-1], last.rsplit("/", 1)[-1]}
    for status in fs.listStatus(files_of(spark, root)[1]):
        name = status.getPath().getName()
        if name.startswith("version=") and name not in keep:
            fs.delete(status.getPath(), True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    fs, where = files_of(spark, path)
    fs.delete(where, True)
