"""Lodging sources.

Every operator reads its inputs from a *sources* object: anything with ``spark`` and the lodging tables as
DataFrame attributes. ``REQUIRED_COLUMNS`` lists the tables and the columns the operators read; ``check_sources``
verifies a sources object against it (schemas only) and names everything missing.

Implementations: :class:`fixtures.LodgingSources` (derived from the driver's test tables),
:class:`stored.StoredSources` (parquet folders) and :class:`stored.CatalogSources` (catalog tables).
"""

from __future__ import annotations

# Columns each lodging table must provide (the operators read nothing else).
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "hotel_dim": ("hotel_id", "property_code", "hotel_name", "product", "country_id", "country_name", "city_name",
                  "zone_name", "cluster_id", "status_id"),
    "bookings": ("id", "hotel_id", "status", "source", "sub_source", "ota_id", "micro_market_id", "rooms", "amount",
                 "selling_amount", "discount", "checkin", "checkout", "created_date", "inserted_at"),
    "bookings_base": ("id", "hotel_id", "status", "source", "sub_source", "ota_id", "micro_market_id", "rooms",
                      "checkin", "checkout", "cancellation_time", "updated_at", "inserted_at"),
    "booking_taxes": ("id", "taxes"),
    "hotel_date_summary": ("property_code", "d", "hotel_status", "sellable_rooms", "total_contracted_rooms"),
    "status_changes": ("property_code", "old_status", "new_status", "changed_at"),
    "hotel_policies": ("hotel_id", "policy_row", "policy_id", "status", "metadata", "start_day", "end_day",
                       "updated_at", "inserted_at"),
    "default_policies": ("country_id", "policy_id", "status", "metadata", "inserted_at"),
    "hotel_restrictions": ("hotel_id", "restriction_id", "status", "metadata", "from_day", "to_day", "inserted_at"),
    "calendar": ("d",),
    "online_travel_agents": ("id", "name"),
    "source_enums": ("enum_key", "enum_val"),
    "clusters": ("id", "city_id"),
    "cities": ("id", "time_zone"),
    "city_tz": ("name", "utc_offset"),
}


def missing_columns(sources) -> dict[str, list[str]]:
    """``{table: [missing columns]}`` for a sources object (empty when it satisfies the contract).

    Only schemas are read (no job runs). A source whose raw bookings carry the tax documents says so
    (``taxes_on_bookings``) and needs no ``booking_taxes`` table but a ``taxes`` column there.
    """
    missing = {}
    for table, cols in REQUIRED_COLUMNS.items():
        if getattr(sources, "taxes_on_bookings", False):
            if table == "booking_taxes":
                continue
            if table == "bookings_base":
                cols = (*cols, "taxes")
        try:
            have = set(getattr(sources, table).columns)
        except Exception as e:  # noqa: BLE001 - report any unreadable table as missing entirely
            missing[table] = [f"<unreadable: {type(e).__name__}>"]
            continue
        gone = [c for c in cols if c not in have]
        if gone:
            missing[table] = gone
    return missing


def check_sources(sources) -> None:
    """Raise ``ValueError`` naming every missing table column before any query is planned."""
    missing = missing_columns(sources)
    if missing:
        raise ValueError("lodging sources miss columns: " + "; ".join(f"{t}: {', '.join(c)}" for t, c in missing.items()))
