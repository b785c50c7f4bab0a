"""Lodging tables stored as parquet, with the same attributes as :class:`LodgingSources`.

In production the lodging tables exist as tables. ``store_sources`` writes each table of a source object once
(bookings ``partitionBy("inserted_at")`` so the month floor prunes folders) and returns a reader over them,
so that many queries can run on stored tables instead of re-deriving them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

LODGING_TABLES = ("hotel_dim", "bookings", "bookings_base", "booking_taxes", "hotel_date_summary", "status_changes", "hotel_policies",
                  "default_policies", "hotel_restrictions", "online_travel_agents", "source_enums", "clusters",
                  "cities", "city_tz", "calendar")
PARTITION_COLUMNS = {"bookings": "inserted_at", "bookings_base": "inserted_at"}


class StoredSources:
    """Readers over ``<path>/<table>`` parquet folders, with declared schemas (no inference job)."""

    def __init__(self, spark: SparkSession, path: str, schemas: dict[str, StructType] | None = None,
                 taxes_on_bookings: bool = False):
        self.spark = spark
        self.taxes_on_bookings = taxes_on_bookings
        self.path = path.rstrip("/")
        self.schemas = schemas or {}
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            reader = self.spark.read
            if name in self.schemas:
                reader = reader.schema(self.schemas[name])
            self._frames[name] = reader.parquet(f"{self.path}/{name}")
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in LODGING_TABLES:
            return self.table(name)
        raise AttributeError(name)


def store_sources(src, path: str) -> StoredSources:
    """Write every lodging table of ``src`` under ``path`` (replacing earlier content) and return readers."""
    schemas = {}
    for name in LODGING_TABLES:
        df = getattr(src, name)
        schemas[name] = df.schema
        writer = df.write.mode("overwrite")
        if name in PARTITION_COLUMNS:
            writer = writer.partitionBy(PARTITION_COLUMNS[name])
        writer.parquet(f"{path.rstrip('/')}/{name}")
    return StoredSources(src.spark, path, schemas)


def store_by_month(bookings: DataFrame, path: str) -> DataFrame:
    """Write bookings as one folder per month (``inserted_at``) and return a reader over them."""
    bookings.write.mode("overwrite").partitionBy("inserted_at").parquet(path)
    return bookings.sparkSession.read.schema(bookings.schema).parquet(path)


class CatalogSources:
    """The lodging tables of a catalog database (``spark.table(f"{database}.{name}")``), e.g. the production
    tables; a name can be mapped to another table name with ``tables``."""

    def __init__(self, spark: SparkSession, database: str, tables: dict[str, str] | None = None,
                 taxes_on_bookings: bool = False):
        self.spark = spark
        self.taxes_on_bookings = taxes_on_bookings
        self.database = database
        self.tables = tables or {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in LODGING_TABLES:
            return self.spark.table(f"{self.database}.{self.tables.get(name, name)}")
        raise AttributeError(name)


BUCKETED_BY_ID = ("bookings", "bookings_base", "booking_taxes")


def store_tables(src, database: str, buckets: int) -> CatalogSources:
    """Save every lodging table of ``src`` as a catalog table of ``database`` and return readers over them.

    Bookings and tax documents are bucketed (and sorted) by booking ``id`` into the same number of buckets,
    so the tax look-up joins and the per-booking tax aggregate run without any shuffle; bookings are also
    partitioned by ``inserted_at`` so the month floor prunes folders. ``buckets`` should give bucket files
    of a few hundred MB at the target scale.
    """
    spark = src.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in LODGING_TABLES:
        writer = getattr(src, name).write.mode("overwrite").format("parquet")
        if name in PARTITION_COLUMNS:
            writer = writer.partitionBy(PARTITION_COLUMNS[name])
        if name in BUCKETED_BY_ID:
            writer = writer.bucketBy(buckets, "id").sortBy("id")
        writer.saveAsTable(f"{database}.{name}")
    return CatalogSources(spark, database)

