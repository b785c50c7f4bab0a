"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: Java / Python pattern of the white space between words.
SPACE = r"[\x20\x09-\x0D]+"
#: A word: a run of anything but that white space.
WORD = r"[^\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the executors (once per application), so that their Python workers can import it
    wherever the driver found it. Spark's file server hands it out; executors need no shared folder for it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="innsight-"), f"innsight-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, and every later reader sees the
    same rows, also after executors are lost."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released() -> None:
    """Give memory that a task has freed back to the system: Python workers outlive their tasks, and what an idle one
    holds is missing elsewhere on its executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(c: Column) -> Column:
    """Number of words (runs of non-white-space) as a long; null counts 0."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")
