"""

The queries share a few relations, each built another way than in Spark: stays are unnested into nights and checked
against the calendar; a booking's channel is the matching rule of the smallest rank; late cancellations compare one
timestamp with check-in plus 18 hours; the latest rows are maxima of structs; per-night values are whole numbers of
1e-10 with integer arithmetic, so sums are exact; tax comes from ``lineitem`` without the JSON text. The fixture
tables are derived here again. Only parameters, label lists and column lists are shared with the Spark code.
"""

from __future__ import annotations

from ..functions import rules as R
from ..params import DEFAULT_PARAMS as P

FIRST = f"DATE '{P.window_start.isoformat()}'"
LAST = f"DATE '{P.window_end.isoformat()}'"
TODAY = f"DATE '{P.as_of.isoformat()}'"


def texts(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def whole(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def half_up(number: str, by: str) -> str:
    """``number / by`` as the nearest integer, halves away from zero (integers, ``by`` positive)."""
    return f"(sign({number}) * ((abs({number}) * 2 + {by}) // (2 * {by})))"


def money(units: str) -> str:
    """Whole numbers of 1e-10 as DECIMAL(38,6)."""
    n = f"CAST({units} AS HUGEINT)"
    return f"CAST(CAST({half_up(n, '10000')} AS DECIMAL(32,0)) * CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(38,6))"


def spread(key: str, salt: int, n: int) -> str:
    """The fixture's number below ``n`` for a key and salt."""
    return f"CAST(({key} % 100003 * {31337 + 1009 * salt} % 100003) % {n} AS INTEGER)"


def nth(index: str, values) -> str:
    return f"([{texts(values)}])[{index} + 1]"


def code(key: str) -> str:
    return f"'P' || lpad(CAST({key} AS VARCHAR), 6, '0')"


def o(salt: int, n: int) -> str:
    return spread("o_orderkey", salt, n)


def ln(salt: int, n: int) -> str:
    return spread("l_orderkey", salt, n)


POLICY_TEXTS = ('{"prepaid":{"advance":100.0}}', '{"prepaid":{"advance":50.5}}', '{"prepaid":{"advance":null}}',
                '{"prepaid":{"advance":100}}', '{"prepaid":{"advance":40}}', '{"cash_at_hotel":true}',
                '{"pay_before_free_cancellation_ends":true}', '{"pay_after_free_cancellation_ends":true}',
                '{"prepaid":{"advance":0}}', "{}")
RESTRICTION_TEXTS = ('{"bulk_booking_advance":null,"advance":"100%"}', "{}", '{"advance":""}',
                     '{"bulk_booking_advance":"100%"}', '{"bulk_booking_advance":"50%","advance":"100%"}',
                     '{"advance":"30%"}')

TABLES = f"""
hotel_dim AS (
  SELECT c_custkey AS hotel_id, {code("c_custkey")} AS property_code,
    (CASE c_custkey % 40 WHEN 0 THEN 'Training ' WHEN 1 THEN 'QA Test ' ELSE '' END) || c_name AS hotel_name,
    c_mktsegment AS product, CAST(c_nationkey AS INTEGER) AS country_id, n_name AS country_name,
    r_name AS city_name, 'Z' || (c_custkey % 5) AS zone_name, CAST(c_custkey % 7 AS INTEGER) AS cluster_id,
    if(c_custkey % 9 = 0, 1, 2) AS status_id
  FROM customer, nation, region WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey),
bookings AS (
  SELECT o_orderkey AS id, o_custkey AS hotel_id, {nth(o(1, 8), (0, 1, 2, 3, 4, 13, 1, 5))} AS status,
    {nth(o(2, 20), (1, 10, 64, 71, 13, 14, 2, 3, 4, 5, 6, 1, 7, 8, 9, 71, 1, 1, 10, 71))} AS source,
    22 + {o(3, 3)} AS sub_source,
    CASE WHEN {o(4, 17)} = 0 THEN 90 WHEN {o(4, 7)} <> 4 THEN {o(5, 14)} END AS ota_id,
    CASE WHEN {o(6, 5)} = 0 THEN 306 WHEN {o(6, 13)} = 0 THEN 7 END AS micro_market_id, 1 + {o(7, 3)} AS rooms,
    CASE WHEN {o(8, 20)} <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS amount,
    CASE WHEN {o(8, 5)} <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) - 10 END AS selling_amount,
    CASE WHEN {o(9, 4)} <> 0 THEN 5.25 END AS discount,
    DATE '1998-03-20' + {o(10, 90)} AS checkin, checkin + {o(11, 6)} AS checkout,
    checkin - {o(12, 30)} AS created_date,
    CASE WHEN {o(13, 7)} = 0 THEN 'null' WHEN {o(13, 7)} > 1
      THEN CAST(checkin + {o(14, 3)} - 1 AS VARCHAR) || ' ' || lpad(CAST({o(15, 24)} AS VARCHAR), 2, '0') || ':30:00.000'
      END AS cancellation_time,
    CAST(checkin AS VARCHAR) || ' 20:00:00' AS updated_at,
    if({o(16, 23)} = 0, '199701', strftime(checkin, '%Y%m')) AS inserted_at
  FROM orders),
bookings_base AS (SELECT * FROM bookings WHERE {spread("id", 17, 10)} <> 0),
hotel_date_summary AS (
  SELECT CASE WHEN {o(20, 97)} <> 0 THEN {code("o_custkey")} END AS property_code,
    DATE '1998-03-28' + {o(18, 80)} + CAST(l_linenumber % 4 AS INTEGER) AS d,
    CAST(l_linenumber % 6 AS INTEGER) AS hotel_status, CAST(l_quantity AS INTEGER) AS sellable_rooms,
    sellable_rooms + 5 AS total_contracted_rooms
  FROM lineitem, orders WHERE l_orderkey = o_orderkey),
status_changes AS (
  SELECT {code("user_id")} AS property_code, if(event_id % 2 = 0, 'Blocked', 'On Hold') AS old_status,
    coalesce(map {{'signup': 'Live', 'error': 'Blocked', 'view': 'On Hold', 'click': 'Active'}}[event_type],
      'In Progress') AS new_status, ts AS changed_at
  FROM events),
hotel_policies AS (
  SELECT o_custkey AS hotel_id, o_orderkey AS policy_row, CAST(2 + o_orderkey % 3 AS INTEGER) AS policy_id,
    CAST(o_orderkey % 2 AS INTEGER) AS status, {nth(o(22, 10), POLICY_TEXTS)} AS metadata,
    DATE '1998-03-01' + {o(21, 120)} AS starts, starts + 90 AS ends, o_orderdate AS updated_at,
    if({o(19, 10)} = 0, '201806', '201808') AS inserted_at
  FROM orders),
default_policies AS (
  SELECT CAST(n_nationkey AS INTEGER) AS country_id,
    if(n_nationkey % 2 = 0, '{{"cash_at_hotel":true}}', '{{"pay_before_free_cancellation_ends":true}}') AS metadata,
    if(n_nationkey % 10 = 2, '201806', '201808') AS inserted_at
  FROM nation),
hotel_restrictions AS (
  SELECT l_suppkey AS hotel_id, CAST(11 + l_linenumber % 2 AS INTEGER) AS restriction_id,
    if(l_linenumber % 4 = 3, 0, 1) AS status, {nth(ln(24, 6), RESTRICTION_TEXTS)} AS metadata,
    DATE '1998-01-01' + {ln(23, 240)} AS starts, starts + 120 AS ends,
    if({ln(25, 10)} = 0, '201806', '201808') AS inserted_at
  FROM lineitem),
online_travel_agents(id, name) AS (VALUES (0, 'Agoda'), (1, 'Booking.com'), (2, 'Axis_Expedia'), (3, 'Hotel Beds'),
  (4, 'HotelTonight'), (5, 'RG_GetARoom'), (6, 'RateGain'), (7, 'Hotwire'), (8, 'Some Other Agent'),
  (10, 'TraveLoka'), (11, 'GoIbibo'), (12, 'Rakuten'), (13, 'Jalan'), (90, 'GDS One')),
source_enums(enum_key, enum_val) AS (VALUES (1, 'OTA'), (10, 'OTA Direct'), (64, 'Migration'), (71, 'Meta'),
  (2, 'Android App'), (3, 'IOS App'), (4, 'Mobile Web Booking'), (5, 'Web Booking'), (6, 'Walk In'), (7, 'Direct'),
  (8, 'Partner Desk')),
zones(cluster_id, utc_offset) AS (VALUES (0, '+00:00'), (1, '+05:30'), (2, '-03:30'), (3, '+00:00'), (4, '+05:30'),
  (5, '-03:30')),
calendar AS (
  SELECT CAST(t AS DATE) AS d
  FROM (SELECT unnest(generate_series(min(checkin), max(checkout), INTERVAL 1 DAY)) AS t FROM bookings)
  WHERE date_diff('day', DATE '1970-01-01', CAST(t AS DATE)) % 11 <> 5)"""

AGENT_LABELS = ", ".join(f"('{name}', '{label}')" for label, names in R.OTA_NAME_LABELS for name in names)
GDS = texts(R.GDS_OTA_IDS)

RELATIONS = f"""
property AS (
  SELECT *, coalesce(product NOT IN ({texts(P.excluded_products)}) AND country_name IN ({texts(P.countries)})
      AND NOT starts_with(property_code, '{P.excluded_code_prefix}')
      AND NOT regexp_matches(lower(hotel_name), '{"|".join(P.excluded_name_terms)}'), false) AS described,
    described AND NOT regexp_matches(lower(hotel_name), '{"|".join(P.extra_name_terms)}') AS commercial
  FROM hotel_dim),
open_days AS (SELECT DISTINCT d AS date FROM calendar WHERE d BETWEEN {FIRST} AND {LAST}),
rooms_offered AS (
  SELECT property_code, d AS date, hotel_status, sum(sellable_rooms) AS srns, max(total_contracted_rooms) AS most
  FROM hotel_date_summary WHERE d BETWEEN {FIRST} AND {LAST} GROUP BY ALL),
supply_all AS (
  SELECT date, property_code, product, hotel_status, srns FROM rooms_offered JOIN property USING (property_code)
  WHERE commercial AND hotel_status IN (1, 2, 3)),
supply AS (SELECT * FROM supply_all WHERE property_code NOT IN ({texts(P.excluded_codes)})),
contracted AS (
  SELECT date, property_code, max(most) AS total_contracted_rooms
  FROM rooms_offered SEMI JOIN (SELECT property_code FROM property WHERE commercial) USING (property_code)
  WHERE property_code IN (SELECT property_code FROM supply) GROUP BY ALL),
agent_names(name, label) AS (VALUES {AGENT_LABELS}),
agents AS (
  SELECT id AS ota_id, coalesce(label, '{R.OTHER_OTA}') AS ota_label
  FROM online_travel_agents LEFT JOIN agent_names USING (name)),
labelled AS (
  SELECT b.*, ota_label, enum_val FROM bookings b LEFT JOIN agents USING (ota_id)
    LEFT JOIN source_enums ON enum_key = source),
matches(id, place, full_too, reduced_too, label) AS (
  SELECT id, 1, ota_id NOT IN ({GDS}), true, coalesce(ota_label, '{R.OTHER_OTA}')
  FROM labelled WHERE source IN ({texts(R.OTA_SOURCES)}) AND micro_market_id IS NULL
  UNION ALL SELECT id, 2, true, true, '{R.MIGRATION_OTA}'
  FROM labelled WHERE source = {R.MIGRATION_SOURCE} AND micro_market_id IS NULL
  UNION ALL SELECT id, 3, true, true, '{R.MICRO_MARKET}'
  FROM labelled WHERE micro_market_id > 0 AND micro_market_id NOT IN ({texts(R.NON_MM_MICRO_MARKETS)})
  UNION ALL SELECT id, 4, true, sub_source = {R.BOG_SUB_SOURCE},
    map {{{R.BOG_SUB_SOURCE}: '{R.BOG}', {R.TRIVAGO_SUB_SOURCE}: '{R.TRIVAGO}'}}[sub_source]
  FROM labelled WHERE source = {R.META_SOURCE} AND sub_source IN ({R.BOG_SUB_SOURCE}, {R.TRIVAGO_SUB_SOURCE})
  UNION ALL SELECT id, 5, true, false, '{R.GDS}' FROM labelled WHERE ota_id IN ({GDS})
  UNION ALL SELECT id, 6, true, true, enum_val FROM labelled),
channels AS (
  SELECT id, arg_min(label, place) FILTER (full_too) AS full_label,
    arg_min(label, place) FILTER (reduced_too) AS reduced_label
  FROM matches GROUP BY id),
countable AS (
  SELECT * FROM labelled WHERE source NOT IN (13, 14) AND status IN (0, 1, 2, 3, 4, 13)
    AND inserted_at > '{P.booking_month_floor}'),
priced AS (
  SELECT *, coalesce(selling_amount, amount) - coalesce(discount, 0) AS gmv, checkout - checkin AS r FROM countable),
taxed AS (
  SELECT id, any_value(checkin > {FIRST}) AS by_checkin, any_value(checkout > {FIRST}) AS by_checkout,
    sum(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) * 10000 AS HUGEINT)) * 1000000 AS tax
  FROM bookings_base JOIN property USING (hotel_id) JOIN lineitem ON l_orderkey = id
  WHERE status IN (1, 2) AND source NOT IN (13, 14) AND country_name IN ({texts(P.countries)}) AND checkin <= {LAST}
    AND l_linenumber % 5 <> 0 AND l_linenumber % 7 <> 6 AND l_returnflag IS DISTINCT FROM 'A'
  GROUP BY id),
valued AS (
  SELECT p.*, CAST(gmv * 100 AS HUGEINT) * 100000000 AS value_units,
    CASE WHEN by_checkin THEN tax END AS in_units, CASE WHEN by_checkout THEN tax END AS out_units
  FROM priced p LEFT JOIN taxed USING (id)),
nights AS (
  SELECT * FROM (SELECT *, CAST(unnest(range(checkin, checkout, INTERVAL 1 DAY)) AS DATE) AS date FROM valued)
  SEMI JOIN open_days USING (date)),
demand AS (
  SELECT property_code, date, full_label AS booking_source,
    coalesce(sum(rooms) FILTER (status IN (1, 2)), 0) AS urn, sum(rooms) AS brn,
    coalesce(sum({half_up("value_units", "r")}), 0) AS gmv_brn,
    coalesce(sum({half_up("value_units", "r")}) FILTER (status IN (1, 2)), 0) AS gmv_urn,
    coalesce(sum({half_up("in_units", "r")}), 0) AS tax_in, coalesce(sum({half_up("out_units", "r")}), 0) AS tax_out,
    coalesce(booking_source, '{R.DEMAND_NULL_CHANNEL}') AS shown, gmv_urn + tax_out AS urn_gmv
  FROM nights JOIN channels USING (id) JOIN property USING (hotel_id) WHERE commercial
  GROUP BY property_code, date, full_label),
daily AS (
  SELECT date, property_code, sum(urn) AS urn, sum(brn) AS brn, sum(gmv_brn) AS gmv_brn,
    sum(gmv_urn) + sum(tax_in) AS urn_gmv
  FROM demand GROUP BY ALL),
cancel_times AS (
  SELECT b.*, property_code, commercial,
    CAST(utc_offset[1] || '1' AS INTEGER) * (CAST(utc_offset[2:3] AS INTEGER) * 60 + CAST(utc_offset[5:6] AS INTEGER))
      AS offset_minutes,
    CAST(left(coalesce(nullif(coalesce(cancellation_time, updated_at), 'null'), '2000-01-01 01:01:01'), 19) AS TIMESTAMP)
      + offset_minutes * INTERVAL 1 MINUTE AS local_cancel_time,
    coalesce(status = 3 AND local_cancel_time >= checkin + INTERVAL 18 HOUR, false) AS late_cancel
  FROM countable b SEMI JOIN (SELECT id FROM bookings_base) USING (id) JOIN property USING (hotel_id)
    LEFT JOIN zones USING (cluster_id)),
realized AS (
  SELECT date, property_code, reduced_label AS booking_source, sum(rooms) AS brn,
    {", ".join(f"coalesce(sum(rooms) FILTER ({cond}), 0) AS {name}" for name, cond in (
        ("urn", "status IN (1, 2)"), ("bad_canc", "late_cancel"), ("cancellations", "status = 3"),
        ("no_show", "status = 4"), ("confirmed", "status = 0"), ("void", "status = 13")))},
    coalesce(booking_source, '{R.REALIZATION_NULL_CHANNEL}') AS shown
  FROM (SELECT *, CAST(unnest(range(checkin, checkout, INTERVAL 1 DAY)) AS DATE) AS date FROM cancel_times
        WHERE commercial)
    SEMI JOIN open_days USING (date) JOIN channels USING (id)
  GROUP BY date, property_code, reduced_label),
live AS (
  SELECT *, CAST(last.t AS DATE) AS live_date
  FROM (SELECT property_code, max(struct_pack(t := changed_at, was := old_status)) AS last
        FROM status_changes WHERE new_status = 'Live' GROUP BY property_code)),
booked_first AS (
  SELECT property_code, min(created_date) AS fb_date FROM bookings JOIN hotel_dim USING (hotel_id)
  WHERE property_code IN (SELECT property_code FROM supply) GROUP BY property_code),
live_since AS (
  SELECT property_code, live_date, fb_date, least(live_date, fb_date) AS live_date2
  FROM live FULL JOIN booked_first USING (property_code)),
policies AS (
  SELECT hotel_id, max(struct_pack(u := updated_at, n := policy_row, m := metadata)) AS last FROM hotel_policies
  WHERE policy_id = {P.policy_id} AND status = 1 AND {TODAY} BETWEEN starts AND ends
    AND inserted_at >= '{P.policy_month_floor}'
  GROUP BY hotel_id),
restrictions AS (
  SELECT * FROM hotel_restrictions WHERE restriction_id = {P.restriction_id} AND status = 1
    AND {TODAY} BETWEEN starts AND ends AND inserted_at >= '{P.policy_month_floor}'),
classed AS (
  SELECT DISTINCT h.hotel_id, property_code, hotel_name, r.metadata AS restriction, r.hotel_id IS NULL AS free,
    coalesce(last.m, d.metadata) AS policy
  FROM hotel_dim h LEFT JOIN restrictions r ON r.hotel_id = h.hotel_id
    LEFT JOIN (SELECT * FROM default_policies WHERE inserted_at >= '{P.policy_month_floor}') d USING (country_id)
    LEFT JOIN policies p ON p.hotel_id = h.hotel_id
  WHERE status_id = {P.policy_property_status} AND country_id IN ({texts(P.policy_country_ids)})),
resolved AS (
  SELECT hotel_id, property_code, hotel_name, free, <policy_class> AS payment_policy,
    <restriction_class> AS prepaid_restrictions
  FROM classed),
payment AS (
  SELECT property_code, hotel_name, CASE WHEN free AND payment_policy IN ('Pay Later', 'Rest')
      THEN prepaid_restrictions WHEN payment_policy = 'Pay Later' OR free AND payment_policy = 'Postpaid'
      THEN payment_policy ELSE 'Prepaid' END AS payment_type_when_policy_applied
  FROM resolved),
attributes AS (SELECT property_code, hotel_name, city_name, zone_name FROM property WHERE described)"""


def policy_class(doc: str) -> str:
    advance = f"round(TRY_CAST({doc} ->> '$.prepaid.advance' AS DOUBLE))"
    later = " OR ".join(f"coalesce({doc} ->> '$.pay_{when}_free_cancellation_ends' = 'true', false)"
                        for when in ("before", "after"))
    return (f"CASE WHEN {advance} = 100 THEN 'Prepaid' WHEN {advance} BETWEEN 1 AND 99 THEN 'Partial Prepaid' "
            f"WHEN {doc} ->> '$.cash_at_hotel' = 'true' THEN 'Postpaid' WHEN {later} THEN 'Pay Later' ELSE 'Rest' END")


def restriction_class(doc: str) -> str:
    key = f"if(json_exists({doc}, '$.bulk_booking_advance'), '$.bulk_booking_advance', '$.advance')"
    percent = f"""regexp_replace(regexp_replace({doc} ->> {key}, '[%"]', '', 'g'), '^$', '0')"""
    return (f"CASE WHEN coalesce({doc}, '{{}}') = '{{}}' THEN 'Postpaid' "
            f"WHEN TRY_CAST({percent} AS INTEGER) < 100 THEN 'Partial_Prepaid' ELSE 'Prepaid' END")


RELATIONS = RELATIONS.replace("<policy_class>", policy_class("policy")).replace(
    "<restriction_class>", restriction_class("restriction"))


def query(body: str, more: str = "") -> str:
    return f"WITH {TABLES},{RELATIONS}{',' + more if more else ''}\n{body}"


# -- pivots, roll-ups and the report ---------------------------------------------------------------------
LISTED = tuple(dict.fromkeys([*R.DEFAULT_CHANNELS, R.UNLISTED_CHANNEL]))
PIVOTS = (("demand", LISTED + (R.DEMAND_NULL_CHANNEL,), R.DEMAND_MEASURES),
          ("realized", LISTED + (R.REALIZATION_NULL_CHANNEL,), R.CANCELLATION_MEASURES))
GROUPS = (("OTA", R.OTA_GROUP), ("Growth", R.GROWTH_GROUP))


def shape(name: str, expr: str) -> str:
    return f"{money(expr) if 'gmv' in name else whole(expr)} AS {quoted(name)}"


def pivot_cells(relation: str, channels, measures) -> list[tuple[str, str]]:
    """(column, sum) for each channel and measure; labels without a column of their own go to the unlisted one."""
    out = []
    for c in channels:
        here = f"shown NOT IN ({texts(channels)}) OR shown = '{c}'" if c == R.UNLISTED_CHANNEL else f"shown = '{c}'"
        out += [(f"{c}_{m}", f"coalesce(sum({m}) FILTER ({here}), 0)") for m in measures]
    return out


def rollup_cells(measures) -> list[tuple[str, str]]:
    """(column, sum) over the labels of a group; OTA cancellations count for labels that have demand."""
    out = []
    for group, members in GROUPS:
        for suffix, m in R.ROLLUP_MEASURES:
            if m in measures:
                seen = " AND booking_source IN (SELECT booking_source FROM demand)" \
                    if group == "OTA" and m in R.REALIZATION_ROLLUP else ""
                out.append((f"{group}_{suffix}", f"coalesce(sum({m}) FILTER (booking_source IN ({texts(members)}){seen}), 0)"))
    return out


def cells(relation: str, found: list[tuple[str, str]]) -> str:
    return (f"SELECT property_code, date, {', '.join(f'{e} AS {quoted(n)}' for n, e in found)} "
            f"FROM {relation} GROUP BY property_code, date")


def pivot(relation: str) -> str:
    _, channels, measures = next(p for p in PIVOTS if p[0] == relation)
    found = pivot_cells(relation, channels, measures)
    return query(f"SELECT date, property_code, {', '.join(shape(n, quoted(n)) for n, _ in found)} "
                 f"FROM ({cells(relation, found)})")


def rollups() -> str:
    found = {relation: rollup_cells(measures) for relation, _, measures in PIVOTS}
    names = [f"{g}_{s}" for g, _ in GROUPS for s, _ in R.ROLLUP_MEASURES]
    return query(f"SELECT date, property_code, {', '.join(shape(n, f'coalesce({quoted(n)}, 0)') for n in names)} "
                 f"FROM d FULL JOIN c USING (property_code, date)",
                 f"d AS ({cells('demand', found['demand'])}), c AS ({cells('realized', found['realized'])})")


def report() -> str:
    """The wide report. A roll-up replaces the channel column of the same name."""
    parts, order = {}, []
    for relation, channels, measures in PIVOTS:
        rolled = rollup_cells(measures)
        names = {n for n, _ in rolled}
        parts[relation] = [x for x in pivot_cells(relation, channels, measures) if x[0] not in names] + rolled
        order += [n for n, _ in parts[relation]]
    totals = ("urn", "brn", "gmv_brn", "urn_gmv")
    columns = ["s.property_code", "s.date", *(shape(n, f"coalesce(t.{n}, 0)") for n in totals),
               f"{whole('CASE WHEN hotel_status = 2 AND srns <> 0 THEN srns ELSE coalesce(t.urn, 0) END')} AS srns",
               *(shape(n, f"coalesce({quoted(n)}, 0)") for n in order),
               f"{whole('coalesce(total_contracted_rooms, 0)')} AS total_contracted_rooms",
               *(f"coalesce(a.{n}, '0') AS {n}" for n in ("hotel_name", "city_name", "zone_name")),
               "payment_type_when_policy_applied", "live_date2",
               f"map {{{', '.join(f'{k}: {chr(39)}{v}{chr(39)}' for k, v in R.HOTEL_STATUS_LABELS)}}}[hotel_status] "
               "AS current_crs_status"]
    return query(f"""SELECT {', '.join(columns)}
FROM supply s LEFT JOIN daily t USING (property_code, date) LEFT JOIN d USING (property_code, date)
  LEFT JOIN c USING (property_code, date) LEFT JOIN contracted USING (property_code, date)
  LEFT JOIN attributes a USING (property_code) LEFT JOIN payment USING (property_code)
  LEFT JOIN live_since USING (property_code)""",
                 f"d AS ({cells('demand', parts['demand'])}), c AS ({cells('realized', parts['realized'])})")


def narrow(published: bool = False, channel: str = "Walk In") -> str:
    names = ["property_code", "date", "urn", "brn", "gmv_brn", "urn_gmv", "srns",
             *(f"{channel}_{m}" for m in (*R.DEMAND_MEASURES, *R.CANCELLATION_MEASURES)), "total_contracted_rooms",
             "hotel_name", "city_name", "zone_name", "payment_type_when_policy_applied", "live_date2",
             "current_crs_status"]
    filled = {"payment_type_when_policy_applied": "payment_type_when_policy_applied",
              "live_date2": "CAST(live_date2 AS VARCHAR)"} if published else {}
    return (f"SELECT {', '.join(f'coalesce({filled[n]}, {chr(39)}0{chr(39)}) AS {n}' if n in filled else quoted(n) for n in names)} "
            f"FROM ({report()})")


BASE = ("supply s LEFT JOIN daily t USING (property_code, date)")
LATE_COLUMNS = ("brn", "urn", "bad_canc", "cancellations", "no_show", "confirmed", "void")
COMMERCIAL_NIGHT = "nights JOIN property USING (hotel_id) WHERE commercial"

ORACLE_SQL: dict[str, str] = {
    "scan_property_dim": query("SELECT hotel_id, property_code, hotel_name, product, country_name FROM hotel_dim"),
    "scan_recent_months": query(
        f"SELECT id, hotel_id, inserted_at FROM bookings WHERE inserted_at > '{P.booking_month_floor}'"),
    "calendar_spine": query("SELECT date AS d FROM open_days"),
    "eligible_properties": query("SELECT hotel_id, property_code, product, country_name FROM property WHERE commercial"),
    "property_attributes": query("FROM attributes SEMI JOIN supply USING (property_code)"),
    "exclude_codes_null_safe": query(f"SELECT date, property_code, hotel_status, {whole('srns')} AS srns FROM supply"),
    "bookable_bookings": query(
        "SELECT id, hotel_id, status, source, rooms, checkin, checkout, inserted_at FROM countable"),
    "supply_by_status": query(
        f"SELECT date, property_code, product, hotel_status, {whole('srns')} AS srns FROM supply_all"),
    "active_restrictions": query("""SELECT hotel_id, restriction_id, metadata, starts - DATE '1970-01-01' AS from_day,
  ends - DATE '1970-01-01' AS to_day FROM restrictions"""),
    "active_policies": query(
        "SELECT hotel_id, last.n AS policy_row, last.m AS metadata, last.u AS updated_at FROM policies"),
    "exclusive_tax_by_booking": query(f"SELECT id, {money('tax')} AS tax_amount FROM taxed WHERE by_checkin"),
    "stay_nights": query("SELECT id, hotel_id, date, status, rooms FROM nights"),
    "stay_nights_by_property": query(f"SELECT id, property_code, date, status, rooms FROM {COMMERCIAL_NIGHT}"),
    "contracted_rooms": query(f"""SELECT date, property_code, {whole('total_contracted_rooms')} AS total_contracted_rooms
FROM contracted"""),
    "channel_labels": query("SELECT id, ota_label, enum_val AS source_label FROM countable"),
    "local_cancel_time": query("""SELECT id, property_code, offset_minutes, local_cancel_time, late_cancel
FROM cancel_times WHERE commercial"""),
    "policy_resolution": query("""SELECT hotel_id, property_code, hotel_name, payment_policy, prepaid_restrictions,
  if(free, 'NA', 'Yes') AS no_postpaid_restriction FROM resolved"""),
    "effective_live_date": query("FROM live_since"),
    "supply_demand_base": query(f"""SELECT date, property_code, hotel_status, {whole('srns')} AS srns,
  {shape('urn', 't.urn')}, {shape('brn', 't.brn')}, {shape('gmv_brn', 't.gmv_brn')}, {shape('urn_gmv', 't.urn_gmv')}
FROM {BASE}"""),
    "null_safe_merge": query(f"""SELECT property_code, date, booking_source, {whole('sum(urn)')} AS urn,
  {whole('sum(cancellations)')} AS cancellations
FROM (SELECT property_code, date, booking_source, urn, NULL AS cancellations FROM demand
  UNION ALL SELECT property_code, date, booking_source, NULL, cancellations FROM realized) GROUP BY ALL"""),
    "room_nights_daily": query(f"""SELECT date, property_code, {shape('urn', 'urn')}, {shape('brn', 'brn')},
  {shape('gmv_brn', 'gmv_brn')}, {shape('urn_gmv', 'urn_gmv')} FROM daily"""),
    "room_nights_by_channel": query(f"""SELECT date, property_code, shown AS booking_source, {shape('urn', 'urn')},
  {shape('urn_gmv', 'urn_gmv')}, {shape('brn', 'brn')}, {shape('gmv_brn', 'gmv_brn')} FROM demand"""),
    "realization_by_channel": query(f"""SELECT date, property_code, booking_source,
  {', '.join(shape(n, n) for n in LATE_COLUMNS)} FROM realized"""),
    "measures_long": query(" UNION ALL ".join(
        f"SELECT date, property_code, shown AS booking_source, '{m}' AS variable, "
        f"{money(m if 'gmv' in m else f'{m} * 10000000000')} AS value FROM demand" for m in R.DEMAND_MEASURES)),
    "channel_pivot": pivot("demand"),
    "cancellation_pivot": pivot("realized"),
    "channel_group_rollup": rollups(),
    "observed_channels": query(f"SELECT DISTINCT booking_source FROM demand WHERE booking_source IN ({texts(R.OTA_GROUP)})"),
    "avg_daily_urn": query(f"""SELECT CAST(round(coalesce(sum(urn), 0) / {P.check_days}, 6) AS DECIMAL(38,6)) AS avg_daily_urn
FROM daily WHERE date BETWEEN DATE '{P.check_start.isoformat()}' AND DATE '{P.check_end.isoformat()}'"""),
    "latest_live_date": query("""SELECT property_code, last.was AS old_status, 'Live' AS new_status, live_date
FROM live"""),
    "first_booking": query("FROM booked_first"),
    "channel_full": query("SELECT id, full_label AS booking_source FROM countable JOIN channels USING (id)"),
    "channel_reduced": query("SELECT id, reduced_label AS booking_source FROM countable JOIN channels USING (id)"),
    "ota_labels": query("SELECT id, ota_id, ota_label FROM countable WHERE ota_id IS NOT NULL"),
    "payment_policy_class": query(
        f"SELECT hotel_id, policy_row, {policy_class('metadata')} AS payment_policy FROM hotel_policies"),
    "restriction_class": query(f"""SELECT hotel_id, restriction_id, metadata,
  {restriction_class('metadata')} AS restriction_class FROM hotel_restrictions"""),
    "effective_payment_type": query("FROM payment"),
    "booking_value": query("SELECT id, CAST(gmv AS DECIMAL(38,2)) AS gmv, CAST(r AS INTEGER) AS r FROM priced"),
    "late_cancellations": query(
        f"SELECT date, property_code, {whole('sum(bad_canc)')} AS bad_canc FROM realized GROUP BY ALL"),
    "supply_corrected": query(f"""SELECT date, property_code, hotel_status, {whole('coalesce(t.urn, 0)')} AS urn,
  {whole('CASE WHEN hotel_status = 2 AND srns <> 0 THEN srns ELSE coalesce(t.urn, 0) END')} AS srns FROM {BASE}"""),
    "zero_fill": query(f"""SELECT date, property_code, shown AS booking_source, {shape('urn', 'urn')},
  {shape('gmv_urn', 'gmv_urn')}, {shape('brn', 'brn')}, {shape('gmv_brn', 'gmv_brn')}, {money('tax_out')} AS tax_amount
FROM demand"""),
    "supply_grain_duplicates": query("""SELECT property_code, date, count(*) AS n_rows FROM supply
GROUP BY ALL HAVING n_rows > 1"""),
    "merge_key_nulls": query("""SELECT count(*) FILTER (side = 's') AS supply_null_keys,
  count(*) FILTER (side = 'd') AS demand_null_keys
FROM (SELECT 's' AS side, property_code, date FROM supply UNION ALL SELECT 'd', property_code, date FROM daily)
WHERE property_code IS NULL OR date IS NULL"""),
    "report_wide": report(),
    "report_narrow": narrow(),
    "report_csv_roundtrip": narrow(published=True),
    "report_ordered_files": f"""SELECT property_code, date,
  CAST(sum(count(*)) OVER (ORDER BY property_code, date) - count(*) AS BIGINT) AS first_position,
  CAST(sum(count(*)) OVER (ORDER BY property_code, date) - 1 AS BIGINT) AS last_position, count(*) AS n_rows
FROM ({narrow()}) GROUP BY property_code, date""",
    "bookings_of_run_months": query("""SELECT inserted_at, count(*) AS n_bookings, CAST(sum(rooms) AS BIGINT) AS n_rooms
FROM bookings WHERE inserted_at IN (SELECT strftime(date, '%Y%m') FROM open_days) GROUP BY inserted_at"""),
}
