"""Room-night demand: used / booked room nights and their value per property, day and channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import per_night
from ..params import BOOKED_STATUSES, USED_STATUSES, ReportParams
from .bookings import attach_property, bookable_bookings, recent_months, stay_nights, with_value
from .channels import FULL_RULES, with_channel
from .dims import eligible_properties
from .intervals import sums_by_night
from .taxes import exclusive_tax_by_booking

TAX_WINDOWS = ("checkin", "checkout")


def demand_bookings(bookings: DataFrame, hotel_dim: DataFrame, online_travel_agents: DataFrame,
                    source_enums: DataFrame, p: ReportParams) -> DataFrame:
    """Bookable bookings of eligible properties with their (full-ladder) channel."""
    b = attach_property(bookable_bookings(bookings, p), eligible_properties(hotel_dim, p))
    return with_channel(b, online_travel_agents, source_enums, FULL_RULES)


def demand_channels_seen(demand_bookings_df: DataFrame, p: ReportParams, calendar: DataFrame | None = None
                         ) -> DataFrame:
    """Distinct channel labels of the demand rows (NULL as ``'0'``), taken from the bookings that have a night in
    the window (on a date of ``calendar``): the same set as the channels of the per-channel rows, without tax.

    Distinct (label, stay) rows come first, so each label's nights are looked at once per pair of days."""
    label = F.coalesce(F.col("booking_source"), F.lit("0")).alias("booking_source")
    stays = demand_bookings_df.select(label, "checkin", "checkout").distinct()
    return stay_nights(stays, p.window_start, p.window_end, calendar=calendar).select("booking_source").distinct()


def demand_stays(bookings: DataFrame, bookings_base: DataFrame, booking_taxes: DataFrame, hotel_dim: DataFrame,
                 online_travel_agents: DataFrame, source_enums: DataFrame, p: ReportParams,
                 taxes_on_bookings: bool = False) -> DataFrame:
    """Eligible bookings with their channel and per-night value and tax.

    All joins happen per booking, and only the columns the aggregates need are kept. Tax is looked up for both tax
    windows in one pass (``tax_checkin``, ``tax_checkout``).
    """
    b = demand_bookings(bookings, hotel_dim, online_travel_agents, source_enums, p)
    # tax of older bookings is never used here, so the month floor prunes the tax path as well
    tax = (exclusive_tax_by_booking(recent_months(bookings_base, p), booking_taxes, hotel_dim, p, TAX_WINDOWS,
                                    taxes_on_bookings)
           .withColumnsRenamed({f"tax_amount_{w}": f"tax_{w}" for w in TAX_WINDOWS}))
    b = with_value(b.join(tax, "id", "left"))
    return b.select("property_code", "booking_source", "status", "rooms", "checkin", "checkout",
                    per_night(F.col("gmv"), F.col("r")).alias("gmv_night"),
                    *[per_night(F.col(f"tax_{w}"), F.col("r")).alias(f"tax_{w}_night") for w in TAX_WINDOWS])


def demand_measures() -> dict[str, Column]:
    """What a stay adds to each night: urn, gmv_urn, brn, gmv_brn and the two taxes."""
    used = F.col("status").isin(*USED_STATUSES)
    booked = F.col("status").isin(*BOOKED_STATUSES)
    return {"urn": F.when(used, F.col("rooms")).otherwise(0), "gmv_urn": F.when(used, F.col("gmv_night")).otherwise(0),
            "brn": F.when(booked, F.col("rooms")).otherwise(0),
            "gmv_brn": F.when(booked, F.col("gmv_night")).otherwise(0),
            **{f"tax_{w}": F.col(f"tax_{w}_night") for w in TAX_WINDOWS}}


def demand_by_channel(stays: DataFrame, p: ReportParams, calendar: DataFrame | None = None) -> DataFrame:
    """Per ``(property_code, date, booking_source)``: urn, gmv_urn, brn, gmv_brn and the two tax sums of the nights of
    :func:`demand_stays` (on dates of ``calendar``, if given).

    Values and taxes stay NULL when no stay of the night has any (zero-filled by the callers).
    """
    measures = demand_measures()
    return sums_by_night(stays, ["property_code", "booking_source"], measures, p.window_start, p.window_end, calendar,
                         nullable=[m for m in measures if m not in ("urn", "brn")])


def demand_totals_aggs() -> list:
    """Aggregates of the daily totals over per-channel rows: missing values and tax (of the check-in window) count
    0 before they are added."""
    return [
        F.sum("urn").alias("urn"),
        F.sum("brn").alias("brn"),
        F.coalesce(F.sum("gmv_brn"), F.lit(0)).alias("gmv_brn"),
        (F.coalesce(F.sum("gmv_urn"), F.lit(0)) + F.coalesce(F.sum("tax_checkin"), F.lit(0))).alias("urn_gmv"),
    ]


def used_value(tax: str) -> Column:
    """Value of used nights with tax; either counts 0 where it is missing."""
    return F.coalesce(F.col("gmv_urn"), F.lit(0)) + F.coalesce(F.col(tax), F.lit(0))


def daily_demand(by_channel: DataFrame) -> DataFrame:
    """Per ``(property_code, date)``: urn, brn, gmv_brn and urn_gmv (= gmv_urn + exclusive tax)."""
    return by_channel.groupBy("property_code", "date").agg(*demand_totals_aggs())


def channel_demand(by_channel: DataFrame) -> DataFrame:
    """Per-channel measures after the zero fill: NULL channel -> ``'0'``, urn_gmv = gmv_urn + tax (checkout window)."""
    return by_channel.select(
        "property_code", "date",
        F.coalesce(F.col("booking_source"), F.lit("0")).alias("booking_source"),
        "urn", "brn", F.coalesce(F.col("gmv_brn"), F.lit(0)).alias("gmv_brn"),
        used_value("tax_checkout").alias("urn_gmv"),
    )
