"""Booking filters, value, and the stay-night expansion that replaces the calendar range join."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import booking_gmv, booking_nights, not_in
from ..params import BOOKED_STATUSES, EXCLUDED_SOURCES, ReportParams


def recent_months(df: DataFrame, p: ReportParams, column: str = "inserted_at") -> DataFrame:
    """Rows of months strictly after ``p.booking_month_floor`` (``yyyymm`` text compared as text).

    When the table is written ``partitionBy(column)`` this filter prunes whole folders.
    """
    return df.filter(F.col(column) > F.lit(p.booking_month_floor))


def bookable_bookings(bookings: DataFrame, p: ReportParams) -> DataFrame:
    """Bookings of countable sources and statuses, from recent months."""
    return recent_months(bookings, p).filter(not_in("source", EXCLUDED_SOURCES)
                                             & F.col("status").isin(*BOOKED_STATUSES))


def with_value(bookings: DataFrame) -> DataFrame:
    """Add ``gmv`` (net booking value) and ``r`` (nights)."""
    return bookings.withColumns({"gmv": booking_gmv(), "r": booking_nights()})


def stay_nights(bookings: DataFrame, start: dt.date, end: dt.date, date_col: str = "date",
                calendar: DataFrame | None = None) -> DataFrame:
    """One row per night ``d`` with ``checkin <= d < checkout`` and ``start <= d <= end``.

    This is the half-open calendar range join written as a generator: only stays that overlap the window
    are kept (zero-night stays drop out, as in the join), and the night sequence is clipped to the window,
    so a long stay never expands past it. No nested-loop or cartesian join is planned.

    The generator stands for a complete date spine. When a ``calendar`` (column ``d``) may leave days out,
    pass it: nights are then kept only on its dates, through a broadcast semi join with its distinct dates
    inside the window (at most one row per window day).
    """
    lo, hi = F.lit(start), F.lit(end)
    overlapping = bookings.filter((F.col("checkin") < F.col("checkout"))
                                  & (F.col("checkin") <= hi) & (F.col("checkout") > lo))
    nights = F.sequence(F.greatest(F.col("checkin"), lo), F.least(F.date_sub(F.col("checkout"), 1), hi))
    out = overlapping.withColumn(date_col, F.explode(nights))
    if calendar is None:
        return out
    return out.join(F.broadcast(calendar_days(calendar, start, end, date_col)), date_col, "left_semi")


def calendar_days(calendar: DataFrame, start: dt.date, end: dt.date, date_col: str = "date") -> DataFrame:
    """The distinct dates of a calendar inside the window: at most one row per window day."""
    return (calendar.filter(F.col("d").between(F.lit(start), F.lit(end)))
            .select(F.col("d").alias(date_col)).distinct())


def attach_property(bookings: DataFrame, properties: DataFrame, columns: tuple[str, ...] = ("property_code",)
                    ) -> DataFrame:
    """Inner join of bookings to the (filtered) property dimension on ``hotel_id``.

    The dimension side is not hinted: Spark broadcasts it when its measured size is under
    ``autoBroadcastJoinThreshold`` (AQE re-checks at runtime) and sort-merge joins it otherwise.
    """
    return bookings.join(properties.select("hotel_id", *columns), "hotel_id")
