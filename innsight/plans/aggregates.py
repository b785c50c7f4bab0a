"""First-level aggregates stored bucketed by (property, day), so that a report made again merges without an exchange.

The supply, demand and realization aggregates are the only steps that read the large facts. Stored in the same number
of buckets by (property, day), sorted by it, their second level (the contracted maximum, the pivots) and the merges
between them need no shuffle: reports with other channels, attributes or policies are joins of buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..params import ReportParams
from . import report as rp

KEYS = ("property_code", "date")
NAMES = ("supply_per_status", "demand_by_channel", "realization_by_channel")


@dataclass(frozen=True)
class Aggregates:
    """The three aggregates of one window; :func:`report.report_wide` takes them in place of the facts."""

    supply_per_status: DataFrame
    demand_by_channel: DataFrame
    realization_by_channel: DataFrame


def first_level(src, p: ReportParams) -> Aggregates:
    return Aggregates(rp.supply_per_status(src.hotel_date_summary, p), rp.demand_by_channel_for(src, p),
                      rp.realization_by_channel_for(src, p))


def store_aggregates(src, p: ReportParams, database: str, buckets: int) -> Aggregates:
    """Save the aggregates of ``src`` as tables of ``database`` (replacing earlier ones) and return readers over them."""
    spark = src.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    made = first_level(src, p)
    for name in NAMES:
        (getattr(made, name).write.mode("overwrite").format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS)
         .saveAsTable(f"{database}.{name}"))
    return stored_aggregates(spark, database)


def stored_aggregates(spark: SparkSession, database: str) -> Aggregates:
    return Aggregates(*[spark.table(f"{database}.{name}") for name in NAMES])
