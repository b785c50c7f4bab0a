"""Supply (sellable and contracted rooms), live dates and the supply correction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import LIVE_HOTEL_STATUS, SUPPLY_HOTEL_STATUSES, ReportParams
from .dims import eligible_properties, exclude_keys, restrict_to_keys


def _in_window(df: DataFrame, p: ReportParams, column: str = "d") -> DataFrame:
    return df.filter(F.col(column).between(F.lit(p.window_start), F.lit(p.window_end)))


def supply_by_status(hotel_date_summary: DataFrame, hotel_dim: DataFrame, p: ReportParams) -> DataFrame:
    """Sellable room nights per eligible property, day and property status (statuses 1, 2, 3).

    Aggregated before the dimension join. A property-day with two statuses gives two rows (kept).
    """
    s = (_in_window(hotel_date_summary, p).filter(F.col("hotel_status").isin(*SUPPLY_HOTEL_STATUSES))
         .groupBy("property_code", "d", "hotel_status").agg(F.sum("sellable_rooms").alias("srns")))
    props = eligible_properties(hotel_dim, p).select("property_code", "product")
    return s.join(props, "property_code").select(F.col("d").alias("date"), "property_code", "product",
                                                 "hotel_status", "srns")


def supply_rows(hotel_date_summary: DataFrame, hotel_dim: DataFrame, p: ReportParams) -> DataFrame:
    """:func:`supply_by_status` without the codes of ``p.excluded_codes`` (NULL codes kept)."""
    return exclude_keys(supply_by_status(hotel_date_summary, hotel_dim, p), "property_code", p.excluded_codes)


def contracted_rooms(hotel_date_summary: DataFrame, hotel_dim: DataFrame, supply_codes: DataFrame,
                     p: ReportParams) -> DataFrame:
    """Max contracted rooms per eligible property and day (all statuses), for properties with supply rows."""
    c = (_in_window(hotel_date_summary, p).groupBy("property_code", "d")
         .agg(F.max("total_contracted_rooms").alias("total_contracted_rooms")))
    c = c.join(eligible_properties(hotel_dim, p).select("property_code"), "property_code")
    return restrict_to_keys(c, supply_codes).select(F.col("d").alias("date"), "property_code",
                                                    "total_contracted_rooms")


def latest_live_date(status_changes: DataFrame) -> DataFrame:
    """Latest change to status ``Live`` per property: ``(property_code, old_status, new_status, live_date)``.

    The largest ``old_status`` breaks ties; a property without any time keeps a row. See :func:`latest_per_key`.
    """
    latest = latest_per_key(_live_changes(status_changes).select("property_code", "changed_at", "old_status"),
                            "property_code", ["changed_at", "old_status"])
    return latest.select("property_code", "old_status", F.lit("Live").alias("new_status"),
                         F.to_date("changed_at").alias("live_date"))


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row of each key (NULL is one) that comes last by the columns of ``order``; NULLs come first in it.

    One scan and one shuffle: a limit of one row per key is planned below the exchange as well (WindowGroupLimit), so
    every map task hands on a single row per key, and a key with a huge history never lands whole in one task."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("__nth", F.row_number().over(w)).filter(F.col("__nth") == 1).drop("__nth")


def _live_changes(status_changes: DataFrame) -> DataFrame:
    return status_changes.filter(F.col("new_status") == F.lit("Live"))


def live_dates(status_changes: DataFrame) -> DataFrame:
    """``(property_code, live_date)``: the date alone of :func:`latest_live_date`, one hash aggregate."""
    return (_live_changes(status_changes).groupBy("property_code")
            .agg(F.to_date(F.max("changed_at")).alias("live_date")))


def first_booking(bookings: DataFrame, hotel_dim: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """First booking creation date per property, for the properties in ``codes`` (all of ``hotel_dim`` when
    ``codes`` is None).

    The first date per ``hotel_id`` is taken before the join: one row per hotel leaves each task, so bookings of
    all history are never shuffled by property.
    """
    props = hotel_dim.select("hotel_id", "property_code")
    if codes is not None:
        props = restrict_to_keys(props, codes)
    per_hotel = bookings.groupBy("hotel_id").agg(F.min("created_date").alias("created_date"))
    return (per_hotel.join(props, "hotel_id").groupBy("property_code")
            .agg(F.min("created_date").alias("fb_date")))


def effective_live_date(latest_live: DataFrame, first_bookings: DataFrame) -> DataFrame:
    """Full merge of live date and first booking date; ``live_date2`` is the earlier one (NULLs skipped)."""
    merged = latest_live.select("property_code", "live_date").join(first_bookings, "property_code", "full")
    return merged.withColumn("live_date2", F.least("live_date", "fb_date"))


def corrected_srns(hotel_status="hotel_status", srns="srns", urn="urn"):
    """Supply correction: a live property keeps its sellable rooms unless they are 0; everywhere else the rooms used
    count as the supply, or 0."""
    live_rooms = F.when(F.col(hotel_status) == LIVE_HOTEL_STATUS, F.col(srns))
    used = F.greatest(F.coalesce(F.col(urn), F.lit(0)), F.lit(0))
    return F.when((F.col(hotel_status) == LIVE_HOTEL_STATUS) & (live_rooms.isNull() | (live_rooms != 0)), live_rooms) \
        .otherwise(used)
