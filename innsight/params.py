"""Report parameters: the run date, the derived report window and the filter lists.

Everything the original job hard-coded (dates taken from the clock, country and product lists, code
prefixes) is an argument here, so that a run is repeatable and tests can pin the date.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Booking status codes (fixed values).
USED_STATUSES = (1, 2)
BOOKED_STATUSES = (0, 1, 2, 3, 4, 13)
CANCELLED_STATUS = 3
NO_SHOW_STATUS = 4
CONFIRMED_STATUS = 0
VOID_STATUS = 13
EXCLUDED_SOURCES = (13, 14)

# Property statuses kept in the supply fact (fixed values).
SUPPLY_HOTEL_STATUSES = (1, 2, 3)
LIVE_HOTEL_STATUS = 2
# The report's countries, by id.
COUNTRY_IDS = (1, 2, 4, 6, 8, 10, 12, 14, 16, 18, 20, 22, 23, 24)


def first_of_month(d: dt.date) -> dt.date:
    return d.replace(day=1)


@dataclass(frozen=True)
class ReportParams:
    """Arguments of one report run.

    ``as_of`` replaces the wall clock. The window is ``[first day of month of as_of - 62 days,
    as_of - 2 days]``; bookings are read from months strictly after the month of ``as_of - 300``.
    """

    as_of: dt.date = dt.date(1998, 6, 15)
    countries: tuple[str, ...] = tuple(f"NATION_{i}" for i in COUNTRY_IDS)
    # Country ids of the same countries, used by the payment-policy resolution.
    policy_country_ids: tuple[int, ...] = COUNTRY_IDS
    excluded_products: tuple[str, ...] = ("MACHINERY",)
    # Lower-cased substrings of hotel names that mark non-commercial properties.
    excluded_name_terms: tuple[str, ...] = ("training", "test")
    # An extra name term that the demand / supply filters use but the attribute filter does not.
    extra_name_terms: tuple[str, ...] = ("long stay",)
    excluded_code_prefix: str = "P00001"
    # Codes dropped from the supply list with null-safe "not in".
    excluded_codes: tuple[str, ...] = ("P000003", "P000042", "P000101", "P001234")
    # Status of properties considered by the payment-policy resolution.
    policy_property_status: int = 2
    # ``yyyymm`` text: policy, default-policy and restriction rows inserted from this month on are read.
    policy_month_floor: str = "201807"
    restriction_id: int = 12
    policy_id: int = 3
    # Fixed period of the average-daily-URN sanity figure.
    check_start: dt.date = dt.date(1998, 5, 1)
    check_end: dt.date = dt.date(1998, 5, 24)
    check_days: int = 24

    @property
    def window_start(self) -> dt.date:
        return first_of_month(self.as_of - dt.timedelta(days=62))

    @property
    def window_end(self) -> dt.date:
        return self.as_of - dt.timedelta(days=2)

    @property
    def booking_month_floor(self) -> str:
        """``yyyymm`` text; bookings with ``inserted_at`` strictly greater are read."""
        d = self.as_of - dt.timedelta(days=300)
        return f"{d.year * 100 + d.month}"

    @property
    def all_name_terms(self) -> tuple[str, ...]:
        return self.excluded_name_terms + self.extra_name_terms


DEFAULT_PARAMS = ReportParams()
