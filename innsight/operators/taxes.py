"""Exclusive tax per booking from the JSON tax break-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import VALUE_TYPE, not_in
from ..params import EXCLUDED_SOURCES, USED_STATUSES, ReportParams

TAX_SCHEMA = "struct<tax_breakup: array<map<string,string>>>"


def _window(on: str, p: ReportParams) -> Column:
    """Tax window: the stay must end after the window start (``checkout``) or start after it (``checkin``),
    and start no later than the window end."""
    if on not in ("checkin", "checkout"):
        raise ValueError(f"window_on must be 'checkin' or 'checkout', got {on!r}")
    return (F.col(on) > F.lit(p.window_start)) & (F.col("checkin") <= F.lit(p.window_end))


def tax_entries(booking_taxes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per tax entry: ``(id, *keep, entry map<string,string>)``.

    NULL, empty or malformed JSON gives no row (``CROSS JOIN UNNEST`` semantics).
    """
    breakup = F.from_json(F.col("taxes"), TAX_SCHEMA).getField("tax_breakup")
    return booking_taxes.select("id", *keep, F.explode(breakup).alias("entry"))


def exclusive_tax_by_booking(bookings_base: DataFrame, booking_taxes: DataFrame | None, hotel_dim: DataFrame,
                             p: ReportParams, windows: Sequence[str] = ("checkin",),
                             taxes_on_bookings: bool = False) -> DataFrame:
    """Sum of exclusive tax amounts per used booking in the report countries.

    Returns ``id`` and one ``tax_amount_<window>`` column per entry of ``windows`` (or ``tax_amount`` when a
    single window is asked for). Each booking's entries are filtered first (only bookings in some window),
    then aggregated per id, so the result has one row per booking and joins back by id.

    With ``taxes_on_bookings`` the booking rows carry the tax document themselves (a ``taxes`` column) and it is
    read from the same filtered scan; otherwise the documents of ``booking_taxes`` are joined by id.
    """
    in_any = None
    for w in windows:
        in_any = _window(w, p) if in_any is None else in_any | _window(w, p)
    base = (bookings_base
            .filter(F.col("status").isin(*USED_STATUSES) & not_in("source", EXCLUDED_SOURCES) & in_any)
            .join(hotel_dim.filter(F.col("country_name").isin(*p.countries)).select("hotel_id"), "hotel_id"))
    if taxes_on_bookings:
        docs = base.select("id", "checkin", "checkout", "taxes")
    else:
        docs = booking_taxes.join(base.select("id", "checkin", "checkout"), "id")
    taxed = tax_entries(docs, keep=("checkin", "checkout"))
    clusivity = F.element_at(F.col("entry"), F.lit("clusivity"))
    exclusive = taxed.filter(clusivity.isNotNull() & (clusivity == F.lit("Exclusive")))
    amount = F.element_at(F.col("entry"), F.lit("tax_amount")).try_cast(VALUE_TYPE)
    if len(windows) == 1:
        aggs = [F.sum(amount).alias("tax_amount")]
    else:
        aggs = [F.sum(F.when(_window(w, p), amount)).alias(f"tax_amount_{w}") for w in windows]
    return exclusive.groupBy("id").agg(*aggs)
