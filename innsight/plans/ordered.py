"""The ordered report sink: files of bounded size that read in the order of their names as one sorted report.

Spark samples the keys, deals the rows to ranges, and sorts each range, so the sort is distributed; ``part-`` names
follow the ranges. ``file_positions`` numbers the rows as a reader of the files, one after the other, meets them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Spark removes a finished query's own shuffle files, and doesn't wait for its driver's garbage collection.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_ordered_csv(df: DataFrame, path: str, keys: Sequence[str], rows_per_file: int = 1_000_000) -> None:
    """CSV files with header, ``NA`` for NULL, sorted by ``keys`` across files, of ``rows_per_file`` rows at most."""
    (df.orderBy(*keys).write.mode("overwrite").option("header", True).option("nullValue", "NA")
     .option("maxRecordsPerFile", rows_per_file).csv(path))


def stored_rows(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once as Parquet and read back. A sort across files reads its input twice, for a sample of the keys
    and to deal the rows; over stored rows the sample costs a scan, not the joins that made them.

    The shuffles of the joins go as soon as the rows are stored, so they aren't on disk beside what is made of the rows."""
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def file_positions(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of a written report with ``position``, their place (from 0) when the files are read by name.

    Splits of files are numbered by name and offset and their rows counted; only that small table is put in one order.
    Within a split rows come in the order of the file."""
    rows = (spark.read.schema(schema).option("header", True).option("nullValue", "NA").csv(path)
            .select("*", F.col("_metadata.file_name").alias("__file"),
                    F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__id")))
    splits = rows.groupBy("__file", "__start").agg(F.min("__id").alias("__first"), F.count("*").alias("__rows"))
    # one row per split of a file
    order = Window.orderBy("__file", "__start").rowsBetween(Window.unboundedPreceding, -1)
    begun = splits.withColumn("__before", F.coalesce(F.sum("__rows").over(order), F.lit(0))).drop("__rows")
    return (rows.join(begun, ["__file", "__start"])
            .withColumn("position", F.col("__before") + F.col("__id") - F.col("__first"))
            .drop("__file", "__start", "__id", "__first", "__before"))
