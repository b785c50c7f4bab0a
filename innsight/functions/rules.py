"""Lookup values and rule lists of the report.

The values below must equal the original report's for its results to match; they are kept as plain data
so that the operators read them instead of hard-coding them.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------------------------------
# Travel-agent name -> channel label (case-sensitive match; anything else is other_ota).
# ---------------------------------------------------------------------------------------------------
OTA_NAME_LABELS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Booking", ("Booking.com", "Axis_Booking.com", "Rategain_Booking.com")),
    ("Expedia", ("Axis_Expedia", "Expedia", "Rategain_Expedia")),
    ("Traveloka", ("TraveLoka", "Axis_TraveLoka", "Traveloka_Direct")),
    ("Agoda", ("Agoda", "Axis_Agoda")),
    ("GIMMT", ("GoIbibo", "Axis_Go-MMT", "GoMMT", "Rategain_GoIbibo", "Axis_MakeMyTrip", "MakeMyTrip")),
    ("Rakuten", ("Rakuten",)),
    ("Jalan", ("Jalan",)),
    ("Hotel Beds", ("Hotel Beds",)),
    ("HotelTonight", ("HotelTonight",)),
    ("RateGain", ("RateGain",)),
    ("Hotwire", ("RateGain_Hotwire", "Hotwire")),
    ("GetARoom", ("RG_GetARoom",)),
)
OTHER_OTA = "other_ota"

# ---------------------------------------------------------------------------------------------------
# Channel rule constants.
# ---------------------------------------------------------------------------------------------------
OTA_SOURCES = (1, 10)
MIGRATION_SOURCE = 64
META_SOURCE = 71
BOG_SUB_SOURCE = 22
TRIVAGO_SUB_SOURCE = 23
GDS_OTA_IDS = (90, 91, 92, 93, 94)
NON_MM_MICRO_MARKETS = (306, 126, 256, 99)
# Labels the rules give.
MIGRATION_OTA = "migration_ota"
MICRO_MARKET = "MM"
BOG = "BoG"
TRIVAGO = "Trivago"
GDS = "GDS"

# ---------------------------------------------------------------------------------------------------
# Channel groups of the roll-up columns.
# ---------------------------------------------------------------------------------------------------
OTA_GROUP = ("Agoda", "Booking", "Expedia", "GetARoom", "Hotel Beds", "Hotwire", "HotelTonight", "RateGain",
             "other_ota")
GROWTH_GROUP = ("Android App", "IOS App", "Mobile Web Booking", "Web Booking", "Direct")

# ---------------------------------------------------------------------------------------------------
# Property status code -> label (unknown codes give NULL).
# ---------------------------------------------------------------------------------------------------
HOTEL_STATUS_LABELS = (
    (0, "On Hold"),
    (1, "Active"),
    (2, "Live"),
    (3, "Blocked"),
    (4, "In Progress"),
    (5, "Training"),
)

# Channel labels the pivots give a column to. The rule outputs above plus the source-enum labels of the
# fixture tables; a label outside the list is summed into UNLISTED_CHANNEL so that no row is lost.
SOURCE_ENUM_LABELS = ("OTA", "OTA Direct", "Migration", "Meta", "Android App", "IOS App", "Mobile Web Booking",
                      "Web Booking", "Walk In", "Direct")
RULE_LABELS = tuple(label for label, _ in OTA_NAME_LABELS) + (OTHER_OTA, MIGRATION_OTA, MICRO_MARKET, BOG, TRIVAGO, GDS)
UNLISTED_CHANNEL = "unlisted"
DEFAULT_CHANNELS = RULE_LABELS + SOURCE_ENUM_LABELS + (UNLISTED_CHANNEL,)

# Label given to a NULL channel: the demand pivot is zero-filled before reshaping (text "0"), the
# cancellation pivot is not (R prints NA).
DEMAND_NULL_CHANNEL = "0"
REALIZATION_NULL_CHANNEL = "NA"

# Measures of the two pivots, in column order.
DEMAND_MEASURES = ("urn", "urn_gmv", "brn", "gmv_brn")
CANCELLATION_MEASURES = ("cancellations", "no_show")

# Roll-up output names per group: (output suffix, demand or realization measure).
ROLLUP_MEASURES = (
    ("urn", "urn"),
    ("brn", "brn"),
    ("gmv_urn", "urn_gmv"),
    ("gmv_brn", "gmv_brn"),
    ("noshows", "no_show"),
    ("cancellations", "cancellations"),
)
REALIZATION_ROLLUP = ("no_show", "cancellations")
