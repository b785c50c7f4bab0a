"""Named queries: one per operator of the inventory.

``OPERATORS`` maps a name to ``sources -> DataFrame``, where ``sources`` is any object with the lodging tables
as attributes (derived from the driver tables, or stored tables). ``QUERIES`` wraps them as
``(spark, sf_dir) -> DataFrame`` over the driver tables of ``sf_dir``; every query runs over all of them.
Output columns are typed for comparison: room counts BIGINT, values DECIMAL(38,6), dates DATE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.exprs import count, money, zero_fill
from ..operators.bookings import attach_property, bookable_bookings, recent_months, stay_nights, with_value
from ..operators.channels import FULL_RULES, REDUCED_RULES, labelled_agents, with_channel, with_channel_inputs
from ..operators.demand import channel_demand, daily_demand
from ..operators.dims import eligible_properties, property_attributes
from ..operators.policy import (active_policies, active_restrictions, classes_by_text, classified_policies,
                                payment_class_of, payment_types, policy_rows, restriction_class_of)
from ..operators.realization import realization_bookings, realization_nights
from ..operators.reshape import measures_long
from ..operators.supply import (contracted_rooms, corrected_srns, effective_live_date, first_booking,
                                latest_live_date, supply_by_status, supply_rows)
from ..operators.taxes import exclusive_tax_by_booking
from ..params import DEFAULT_PARAMS, ReportParams
from ..session import output_path
from ..sources.fixtures import LodgingSources
from ..sources.stored import store_by_month
from . import report as rp
from .checks import avg_daily_urn, grain_duplicates, null_key_counts
from .ordered import file_positions, stored_rows, write_ordered_csv

Query = Callable[[SparkSession, str], DataFrame]
P: ReportParams = DEFAULT_PARAMS
KEY = "property_code"


def _supply(s: LodgingSources) -> DataFrame:
    return supply_rows(s.hotel_date_summary, s.hotel_dim, P)


def _daily_demand(s: LodgingSources) -> DataFrame:
    return daily_demand(rp.demand_by_channel_for(s, P))


def _typed_daily(df: DataFrame) -> DataFrame:
    return df.select("date", KEY, count("urn").alias("urn"), count("brn").alias("brn"),
                     money("gmv_brn").alias("gmv_brn"), money("urn_gmv").alias("urn_gmv"))


# -- sources --------------------------------------------------------------------------------------------
def scan_property_dim(s):
    return s.hotel_dim.select("hotel_id", KEY, "hotel_name", "product", "country_name")


def scan_recent_months(s):
    return recent_months(s.bookings, P).select("id", "hotel_id", "inserted_at")


def calendar_spine(s):
    cal = s.calendar
    return cal.filter(F.col("d").between(F.lit(P.window_start), F.lit(P.window_end))).distinct()


# -- filters --------------------------------------------------------------------------------------------
def q_eligible_properties(s):
    return eligible_properties(s.hotel_dim, P).select("hotel_id", KEY, "product", "country_name")


def q_property_attributes(s):
    return property_attributes(s.hotel_dim, _supply(s).select(KEY), P)


def exclude_codes_null_safe(s):
    return _supply(s).select("date", KEY, "hotel_status", count("srns").alias("srns"))


def q_bookable_bookings(s):
    return bookable_bookings(s.bookings, P).select(
        "id", "hotel_id", "status", "source", "rooms", "checkin", "checkout", "inserted_at")


def q_supply_by_status(s):
    return supply_by_status(s.hotel_date_summary, s.hotel_dim, P).select(
        "date", KEY, "product", "hotel_status", count("srns").alias("srns"))


def q_active_restrictions(s):
    return active_restrictions(s.hotel_restrictions, P).select(
        "hotel_id", "restriction_id", "metadata", "from_day", "to_day")


def q_active_policies(s):
    return active_policies(s.hotel_policies, P)


def q_exclusive_tax_by_booking(s):
    return exclusive_tax_by_booking(s.bookings_base, s.booking_taxes, s.hotel_dim, P).select(
        "id", money("tax_amount").alias("tax_amount"))


# -- joins ----------------------------------------------------------------------------------------------
def q_stay_nights(s):
    """Stay nights on the calendar's dates (the range join with the calendar table)."""
    b = bookable_bookings(s.bookings, P)
    return stay_nights(b, P.window_start, P.window_end, calendar=s.calendar).select(
        "id", "hotel_id", "date", "status", "rooms")


def stay_nights_by_property(s):
    b = attach_property(bookable_bookings(s.bookings, P), eligible_properties(s.hotel_dim, P))
    return stay_nights(b, P.window_start, P.window_end, calendar=s.calendar).select(
        "id", KEY, "date", "status", "rooms")


def q_contracted_rooms(s):
    return contracted_rooms(s.hotel_date_summary, s.hotel_dim, _supply(s).select(KEY), P).select(
        "date", KEY, count("total_contracted_rooms").alias("total_contracted_rooms"))


def channel_labels(s):
    b = with_channel_inputs(bookable_bookings(s.bookings, P), s.online_travel_agents, s.source_enums)
    return b.select("id", "ota_label", F.col("enum_val").alias("source_label"))


def q_local_cancel_time(s):
    b = realization_bookings(s.bookings_base, s.hotel_dim, s.online_travel_agents, s.source_enums, s.clusters,
                             s.cities, s.city_tz, P)
    return b.select("id", KEY, "offset_minutes", "local_cancel_time", "late_cancel")


def q_policy_resolution(s):
    return classified_policies(policy_rows(s.hotel_dim, s.hotel_restrictions, s.default_policies,
                                           s.hotel_policies, P))


def q_effective_live_date(s):
    return effective_live_date(latest_live_date(s.status_changes),
                               first_booking(s.bookings, s.hotel_dim, _supply(s).select(KEY)))


def supply_demand_base(s):
    merged = _daily_demand(s).join(_supply(s), [KEY, "date"], "right")
    return merged.select("date", KEY, "hotel_status", count("srns").alias("srns"), count("urn").alias("urn"),
                         count("brn").alias("brn"), money("gmv_brn").alias("gmv_brn"),
                         money("urn_gmv").alias("urn_gmv"))


def null_safe_merge(s):
    """Full merge of demand and realization per channel on (property, day, channel), NULL matching NULL."""
    d = rp.demand_by_channel_for(s, P).select(KEY, "date", "booking_source", "urn")
    r = rp.realization_by_channel_for(s, P).select(
        F.col(KEY).alias("r_key"), F.col("date").alias("r_date"), F.col("booking_source").alias("r_source"),
        "cancellations")
    cond = ((F.col(KEY) == F.col("r_key")) & (F.col("date") == F.col("r_date"))
            & F.col("booking_source").eqNullSafe(F.col("r_source")))
    m = d.join(r, cond, "full")
    return m.select(F.coalesce(KEY, "r_key").alias(KEY), F.coalesce("date", "r_date").alias("date"),
                    F.when(F.col(KEY).isNotNull(), F.col("booking_source")).otherwise(F.col("r_source"))
                    .alias("booking_source"),
                    count("urn").alias("urn"), count("cancellations").alias("cancellations"))


# -- aggregations ---------------------------------------------------------------------------------------
def room_nights_daily(s):
    return _typed_daily(_daily_demand(s))


def _channel_demand_typed(s: LodgingSources) -> DataFrame:
    return channel_demand(rp.demand_by_channel_for(s, P)).select(
        "date", KEY, "booking_source", count("urn").alias("urn"), money("urn_gmv").alias("urn_gmv"),
        count("brn").alias("brn"), money("gmv_brn").alias("gmv_brn"))


def room_nights_by_channel(s):
    return _channel_demand_typed(s)


def q_realization_by_channel(s):
    r = rp.realization_by_channel_for(s, P)
    return r.select("date", KEY, "booking_source",
                    *[count(c).alias(c) for c in ("brn", "urn", "bad_canc", "cancellations", "no_show",
                                                  "confirmed", "void")])


def q_measures_long(s):
    return measures_long(channel_demand(rp.demand_by_channel_for(s, P)), ["date", KEY, "booking_source"],
                         list(R.DEMAND_MEASURES))


def _pivot_columns(df: DataFrame, prefix_cols: list[tuple[str, str]]) -> DataFrame:
    return rp.select_typed(df, [("date", "date"), (KEY, "text"), *prefix_cols])


def channel_pivot(s):
    wide = rp.demand_daily_wide(rp.demand_by_channel_for(s, P), R.DEFAULT_CHANNELS, rollups=False)
    cols = [(f"{ch}_{m}", "money" if "gmv" in m else "count")
            for ch in rp.demand_channels() for m in R.DEMAND_MEASURES]
    return _pivot_columns(wide, cols)


def cancellation_pivot(s):
    wide = rp.cancellation_daily_wide(rp.realization_by_channel_for(s, P), rp.observed_demand_channels(s, P),
                                      R.DEFAULT_CHANNELS, rollups=False)
    cols = [(f"{ch}_{m}", "count") for ch in rp.cancellation_channels() for m in R.CANCELLATION_MEASURES]
    return _pivot_columns(wide, cols)


def channel_group_rollup(s):
    """OTA / Growth roll-ups per (property, day) over every key that has demand or realization rows."""
    d_by_ch = rp.demand_by_channel_for(s, P)
    demand = rp.demand_daily_wide(d_by_ch, R.DEFAULT_CHANNELS)
    cancels = rp.cancellation_daily_wide(rp.realization_by_channel_for(s, P), rp.observed_demand_channels(s, P),
                                         R.DEFAULT_CHANNELS)
    d_cols = [f"{g}_{sfx}" for g in ("OTA", "Growth") for sfx, _ in rp.DEMAND_ROLLUP]
    c_cols = [f"{g}_{sfx}" for g in ("OTA", "Growth") for sfx, _ in rp.CANCEL_ROLLUP]
    m = zero_fill(demand.select(KEY, "date", *d_cols).join(cancels.select(KEY, "date", *c_cols), [KEY, "date"],
                                                           "full"), text_fill=None)
    cols = [(f"{g}_{sfx}", "money" if "gmv" in sfx else "count") for g in ("OTA", "Growth")
            for sfx, _ in R.ROLLUP_MEASURES]
    return _pivot_columns(m, cols)


def observed_channels(s):
    return rp.observed_demand_channels(s, P).filter(F.col("booking_source").isin(*R.OTA_GROUP))


def q_avg_daily_urn(s):
    return avg_daily_urn(_daily_demand(s), P)


# -- windows --------------------------------------------------------------------------------------------
def q_latest_live_date(s):
    return latest_live_date(s.status_changes)


def q_first_booking(s):
    return first_booking(s.bookings, s.hotel_dim, _supply(s).select(KEY))


# -- business rules -------------------------------------------------------------------------------------
def channel_full(s):
    return with_channel(bookable_bookings(s.bookings, P), s.online_travel_agents, s.source_enums,
                        FULL_RULES).select("id", "booking_source")


def channel_reduced(s):
    return with_channel(bookable_bookings(s.bookings, P), s.online_travel_agents, s.source_enums,
                        REDUCED_RULES).select("id", "booking_source")


def ota_labels(s):
    agents = labelled_agents(s.online_travel_agents)
    b = bookable_bookings(s.bookings, P).filter(F.col("ota_id").isNotNull())
    return b.join(agents, F.col("ota_id") == F.col("ota_key"), "left").select("id", "ota_id", "ota_label")


def q_payment_policy_class(s):
    return classes_by_text(s.hotel_policies.select("hotel_id", "policy_row", "metadata"), "metadata", "payment_policy",
                           payment_class_of).drop("metadata")


def q_restriction_class(s):
    return classes_by_text(s.hotel_restrictions.select("hotel_id", "restriction_id", "metadata"), "metadata",
                           "restriction_class", restriction_class_of)


def q_effective_payment_type(s):
    return payment_types(classified_policies(policy_rows(s.hotel_dim, s.hotel_restrictions, s.default_policies,
                                                         s.hotel_policies, P)))


def booking_value(s):
    b = with_value(bookable_bookings(s.bookings, P))
    return b.select("id", F.col("gmv").cast("decimal(38,2)").alias("gmv"), F.col("r").cast("int").alias("r"))


def late_cancellations(s):
    b = realization_bookings(s.bookings_base, s.hotel_dim, s.online_travel_agents, s.source_enums, s.clusters,
                             s.cities, s.city_tz, P)
    nights = realization_nights(b, P, s.calendar)
    return nights.groupBy("date", KEY).agg(
        count(F.sum(F.when(F.col("late_cancel"), F.col("rooms")).otherwise(0))).alias("bad_canc"))


def supply_corrected(s):
    base = zero_fill(_supply(s).join(_daily_demand(s), [KEY, "date"], "left"), text_fill=None)
    return base.select("date", KEY, "hotel_status", count("urn").alias("urn"), count(corrected_srns()).alias("srns"))


def q_zero_fill(s):
    by_ch = rp.demand_by_channel_for(s, P)
    filled = zero_fill(by_ch.select("date", KEY, "booking_source", "urn", "gmv_urn", "brn", "gmv_brn",
                                    F.col("tax_checkout").alias("tax_amount")), text_fill="0")
    return filled.select("date", KEY, "booking_source", count("urn").alias("urn"), money("gmv_urn").alias("gmv_urn"),
                         count("brn").alias("brn"), money("gmv_brn").alias("gmv_brn"),
                         money("tax_amount").alias("tax_amount"))


def merge_key_nulls(s):
    """Guard of the plain-equality merges: NULL (property, day) keys on the supply and demand sides."""
    return null_key_counts({"supply": _supply(s), "demand": _daily_demand(s)}, [KEY, "date"])


def supply_grain_duplicates(s):
    return grain_duplicates(_supply(s), [KEY, "date"])


# -- report ---------------------------------------------------------------------------------------------
def report_wide(s):
    return rp.report_wide(s, P)


def report_narrow(s):
    return rp.report_narrow(rp.report_wide(s, P))


def report_csv_roundtrip(s):
    return rp.report_csv_roundtrip(s.spark, rp.report_narrow(rp.report_wide(s, P)))


def report_ordered_files(s):
    """Where each (property, day) of the narrow report stands when its ordered files are read one after the other."""
    path = output_path(s.spark, "report-ordered")
    narrow = stored_rows(rp.report_narrow(rp.report_wide(s, P)), output_path(s.spark, "report-rows"))
    write_ordered_csv(narrow, path, (KEY, "date"), rows_per_file=1000)
    placed = file_positions(s.spark, path, narrow.withColumn("live_date2", F.col("live_date2").cast("string")).schema)
    return placed.groupBy(KEY, "date").agg(F.min("position").alias("first_position"),
                                           F.max("position").alias("last_position"), F.count("*").alias("n_rows"))


def bookings_of_run_months(s):
    """Bookings per month, for the months of the run's window, read from a table partitioned by month: the months
    come from the calendar at run time and prune the folders that are read (dynamic partition pruning)."""
    return rp.bookings_of_months(store_by_month(s.bookings, output_path(s.spark, "bookings-by-month")),
                                 rp.run_months(s.calendar, P))


OPERATORS: dict[str, Callable[[LodgingSources], DataFrame]] = {
    "scan_property_dim": scan_property_dim,
    "scan_recent_months": scan_recent_months,
    "calendar_spine": calendar_spine,
    "eligible_properties": q_eligible_properties,
    "property_attributes": q_property_attributes,
    "exclude_codes_null_safe": exclude_codes_null_safe,
    "bookable_bookings": q_bookable_bookings,
    "supply_by_status": q_supply_by_status,
    "active_restrictions": q_active_restrictions,
    "active_policies": q_active_policies,
    "exclusive_tax_by_booking": q_exclusive_tax_by_booking,
    "stay_nights": q_stay_nights,
    "stay_nights_by_property": stay_nights_by_property,
    "contracted_rooms": q_contracted_rooms,
    "channel_labels": channel_labels,
    "local_cancel_time": q_local_cancel_time,
    "policy_resolution": q_policy_resolution,
    "effective_live_date": q_effective_live_date,
    "supply_demand_base": supply_demand_base,
    "null_safe_merge": null_safe_merge,
    "room_nights_daily": room_nights_daily,
    "room_nights_by_channel": room_nights_by_channel,
    "realization_by_channel": q_realization_by_channel,
    "measures_long": q_measures_long,
    "channel_pivot": channel_pivot,
    "cancellation_pivot": cancellation_pivot,
    "channel_group_rollup": channel_group_rollup,
    "observed_channels": observed_channels,
    "avg_daily_urn": q_avg_daily_urn,
    "latest_live_date": q_latest_live_date,
    "first_booking": q_first_booking,
    "channel_full": channel_full,
    "channel_reduced": channel_reduced,
    "ota_labels": ota_labels,
    "payment_policy_class": q_payment_policy_class,
    "restriction_class": q_restriction_class,
    "effective_payment_type": q_effective_payment_type,
    "booking_value": booking_value,
    "late_cancellations": late_cancellations,
    "supply_corrected": supply_corrected,
    "zero_fill": q_zero_fill,
    "supply_grain_duplicates": supply_grain_duplicates,
    "merge_key_nulls": merge_key_nulls,
    "report_wide": report_wide,
    "report_narrow": report_narrow,
    "report_csv_roundtrip": report_csv_roundtrip,
    "report_ordered_files": report_ordered_files,
    "bookings_of_run_months": bookings_of_run_months,
}


def _on_driver_tables(op: Callable[[LodgingSources], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(LodgingSources(spark, sf_dir))

    query.__name__ = op.__name__
    query.__doc__ = op.__doc__
    return query


# The driver contract: each query derives the lodging tables from the driver tables of ``sf_dir``.
QUERIES: dict[str, Query] = {name: _on_driver_tables(op) for name, op in OPERATORS.items()}
