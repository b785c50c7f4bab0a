"""Publishing by pointer: readers see the old report or the new one, never a part of either.

A published location holds one folder per version and a pointer file that names the current one. A run writes a fresh
folder first; only when it is complete the pointer is replaced, by one rename. A run that dies before that leaves the
old content as it was, and its own folder is not looked at by anyone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Spark skips names with a leading underscore when it lists a folder.
POINTER = "_current"


def _files(spark: SparkSession, location: str):
    """The Hadoop file context and ``Path`` class of a location, whatever store it is in."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        path(location).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    return jvm, context, path


def _qualified(spark: SparkSession, location: str) -> str:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def current_version(spark: SparkSession, location: str) -> str | None:
    """The folder that the location's pointer names; None where nothing was published."""
    location = _qualified(spark, location)
    jvm, files, path = _files(spark, location)
    pointer = path(f"{location}/{POINTER}")
    if not files.util().exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        name = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return f"{location}/{name}"


def _point_to(spark: SparkSession, location: str, version: str) -> None:
    jvm, files, path = _files(spark, location)
    fresh = path(f"{location}/{POINTER}-{uuid.uuid4().hex}")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    out = fresh.getFileSystem(hadoop).create(fresh)
    try:
        out.write(bytearray(version, "utf-8"))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    files.rename(fresh, path(f"{location}/{POINTER}"), how)


def publish(df: DataFrame, location: str, write: Callable[[DataFrame, str], None], keep: int = 2) -> str:
    """Write ``df`` as a new version of ``location`` with ``write(df, folder)``, make it the current one and return
    its folder. Of the versions before, the last ``keep - 1`` that were current stay for readers that still have
    them open; the others, and what runs that died have left, are removed afterwards."""
    spark = df.sparkSession
    location = _qualified(spark, location)
    before = current_version(spark, location)
    version = f"v-{uuid.uuid4().hex}"
    folder = f"{location}/{version}"
    write(df, folder)
    _point_to(spark, location, version)
    _remove_old(spark, location, {folder, before} if keep > 1 else {folder}, keep)
    return folder


def _remove_old(spark: SparkSession, location: str, current: set[str | None], keep: int) -> None:
    """Versions besides the current ones and the latest ``keep``."""
    _, _, path = _files(spark, location)
    fs = path(location).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted(((s.getModificationTime(), s.getPath().toString()) for s in fs.listStatus(path(location))
                    if s.getPath().getName().startswith("v-")), reverse=True)
    for _, folder in found[keep:]:
        if folder not in current:
            fs.delete(path(folder), True)


def read_published(spark: SparkSession, location: str, read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """The current version of ``location``, read by ``read(spark, folder)``. The version is looked up once, so the
    frame keeps to it when another one is published meanwhile."""
    folder = current_version(spark, location)
    if folder is None:
        raise FileNotFoundError(f"nothing is published at {location}")
    return read(spark, folder)
