"""Data checks of the report: grain duplicates, NULL merge keys and the average-daily-URN sanity figure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import money
from ..params import ReportParams


def grain_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur on more than one row, with their row count (``n_rows``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def avg_daily_urn(daily: DataFrame, p: ReportParams) -> DataFrame:
    """Sum of daily used room nights over a fixed period divided by its day count (one row)."""
    period = daily.filter(F.col("date").between(F.lit(p.check_start), F.lit(p.check_end)))
    return period.agg(money(F.coalesce(F.sum("urn"), F.lit(0)) / F.lit(p.check_days)).alias("avg_daily_urn"))


def null_key_counts(sides: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row: per named side, the number of rows with a NULL merge key (``<side>_null_keys``).

    The report merges with plain equality, which is right only while these stay 0. The sides' key columns
    are tagged and unioned, then counted in one global aggregate (map-side partial counts).
    """
    tagged = None
    for name, df in sides.items():
        t = df.select(*keys).withColumn("_side", F.lit(name))
        tagged = t if tagged is None else tagged.unionByName(t)
    any_null = None
    for k in keys:
        any_null = F.col(k).isNull() if any_null is None else any_null | F.col(k).isNull()
    return tagged.agg(*[F.sum(F.when((F.col("_side") == name) & any_null, 1).otherwise(0)).cast("bigint")
                        .alias(f"{name}_null_keys") for name in sides])
