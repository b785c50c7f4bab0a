
import dataclasses
import datetime as dt

import pytest

from innsight.functions import rules as R
from innsight.functions.exprs import local_cancel_time, is_late_cancellation, utc_offset_minutes, zero_fill
from innsight.operators.bookings import stay_nights
from innsight.operators.channels import FULL_RULES, REDUCED_RULES, classify, ota_label, pivot_columns, pivot_state
from innsight.operators.dims import eligible_properties, exclude_keys
from innsight.operators.policy import effective_payment_type, payment_policy_class, restriction_class
from innsight.operators.supply import corrected_srns, latest_live_date
from innsight.operators.taxes import exclusive_tax_by_booking
from innsight.params import ReportParams

P = ReportParams()
D = dt.date


def test_window_parameters():
    assert P.window_start == D(1998, 4, 1)
    assert P.window_end == D(1998, 6, 13)
    assert P.booking_month_floor == "199708"
    assert ReportParams(as_of=D(2020, 3, 3)).window_start == D(2020, 1, 1)


# -- stay-night expansion ----------------------------------------------------------------------------------
STAYS = [
    (1, D(1998, 5, 1), D(1998, 5, 4)),     # inside: 3 nights
    (2, D(1998, 5, 1), D(1998, 5, 1)),     # zero nights
    (3, D(1998, 3, 20), D(1998, 4, 3)),    # starts before the window
    (4, D(1998, 6, 10), D(1998, 7, 2)),    # ends after the window
    (5, D(1998, 1, 1), D(1999, 1, 1)),     # covers the window
    (6, D(1998, 3, 1), D(1998, 4, 1)),     # checks out on the first window day: no night inside
    (7, D(1998, 6, 13), D(1998, 6, 14)),   # last window day
    (8, D(1998, 5, 9), D(1998, 5, 2)),     # checkout before checkin
]


def brute_force_nights(rows, lo, hi):
    out = set()
    for i, ci, co in rows:
        d = lo
        while d <= hi:
            if ci <= d < co:
                out.add((i, d))
            d += dt.timedelta(days=1)
    return out


def test_stay_nights_matches_range_join(spark):
    df = spark.createDataFrame(STAYS, "id int, checkin date, checkout date")
    got = {(r.id, r.date) for r in stay_nights(df, P.window_start, P.window_end).collect()}
    assert got == brute_force_nights(STAYS, P.window_start, P.window_end)
    assert not any(i in (2, 6, 8) for i, _ in got)
    assert len([1 for i, _ in got if i == 5]) == (P.window_end - P.window_start).days + 1


def test_stay_nights_plan_is_a_generator_not_a_join(spark):
    df = spark.createDataFrame(STAYS, "id int, checkin date, checkout date")
    plan = stay_nights(df, P.window_start, P.window_end)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan
    assert "NestedLoopJoin" not in plan and "Cartesian" not in plan


# -- channels ------------------------------------------------------------------------------------------
CH_SCHEMA = "source int, sub_source int, ota_id int, micro_market_id int, ota_label string, enum_val string"


@pytest.mark.parametrize("row, full, reduced", [
    ((1, 22, 3, None, "Hotel Beds", "OTA"), "Hotel Beds", "Hotel Beds"),
    ((1, 22, 9, None, None, "OTA"), "other_ota", "other_ota"),
    ((1, 22, None, None, None, "OTA"), "OTA", "other_ota"),           # NULL ota_id: unknown in the full ladder
    ((10, 22, 90, None, "other_ota", "OTA Direct"), "GDS", "other_ota"),
    ((64, 22, 1, None, "Booking", "Migration"), "migration_ota", "migration_ota"),
    ((64, 22, 1, 306, "Booking", "Migration"), "Migration", "Migration"),
    ((2, 22, 1, 7, "Booking", "Android App"), "MM", "MM"),
    ((71, 22, 1, None, "Booking", "Meta"), "BoG", "BoG"),
    ((71, 23, 1, None, "Booking", "Meta"), "Trivago", "Meta"),
    ((5, 22, 91, None, None, "Web Booking"), "GDS", "Web Booking"),
    ((99, 22, 1, None, "Booking", None), None, None),                 # unknown source: NULL channel
])
def test_channel_ladders(spark, row, full, reduced):
    df = spark.createDataFrame([row], CH_SCHEMA)
    r = df.select(classify(FULL_RULES).alias("f"), classify(REDUCED_RULES).alias("r")).first()
    assert (r.f, r.r) == (full, reduced)


@pytest.mark.parametrize("name, label", [
    ("Booking.com", "Booking"), ("Rategain_Expedia", "Expedia"), ("Axis_Go-MMT", "GIMMT"),
    ("RG_GetARoom", "GetARoom"), ("booking.com", "other_ota"), (None, "other_ota"), ("Jalan", "Jalan"),
])
def test_ota_label_map(spark, name, label):
    df = spark.createDataFrame([(name,)], "name string")
    assert df.select(ota_label("name").alias("l")).first().l == label


def test_pivot_keeps_every_row(spark):
    """One row per key and label, as the aggregates give them; a label that reads like the NULL label joins it."""
    rows = [("Agoda", 3), (None, 4), ("Brand New Channel", 8), ("Another", 16), ("0", 32), (R.UNLISTED_CHANNEL, 64)]
    df = spark.createDataFrame(rows, "booking_source string, urn int")
    chans = ("Agoda", R.UNLISTED_CHANNEL, "0")
    state = df.groupBy().agg(*pivot_state("booking_source", chans, ("urn",), "0"))
    out = pivot_columns(state, chans, ("urn",), "0").first().asDict()
    assert out == {"Agoda_urn": 3, f"{R.UNLISTED_CHANNEL}_urn": 88, "0_urn": 36}
    assert sum(out.values()) == sum(u for _, u in rows)
    bare = df.groupBy().agg(*pivot_state("booking_source", (R.UNLISTED_CHANNEL,), ("urn",), "0"))
    assert pivot_columns(bare, (R.UNLISTED_CHANNEL,), ("urn",), "0").first().asDict() == {f"{R.UNLISTED_CHANNEL}_urn": 127}


# -- dimension filters -------------------------------------------------------------------------------------
def test_eligible_properties_null_and_text_rules(spark):
    rows = [
        (1, "P000100", "Plain Hotel", "BUILDING", "NATION_1"),
        (2, "P000101", "TRAINING centre", "BUILDING", "NATION_1"),
        (3, "P000102", "My qa TEST inn", "BUILDING", "NATION_1"),
        (4, "P000103", "Plain Hotel", None, "NATION_1"),          # NULL product: dropped
        (5, "P000104", None, "BUILDING", "NATION_1"),             # NULL name: dropped
        (6, "P000015", "Plain Hotel", "BUILDING", "NATION_1"),    # excluded code prefix
        (7, "P000106", "Plain Hotel", "MACHINERY", "NATION_1"),   # excluded product
        (8, "P000107", "Plain Hotel", "BUILDING", "NATION_3"),    # other country
        (9, "P000108", "Long Stay Suites", "BUILDING", "NATION_6"),
    ]
    df = spark.createDataFrame(rows, "hotel_id int, property_code string, hotel_name string, product string, "
                                     "country_name string")
    assert sorted(r.hotel_id for r in eligible_properties(df, P).collect()) == [1]
    attrs = eligible_properties(df, P, name_terms=P.excluded_name_terms)
    assert sorted(r.hotel_id for r in attrs.collect()) == [1, 9]
    # an empty prefix excludes nothing, and a prefix is literal text
    free = dataclasses.replace(P, excluded_code_prefix="")
    assert sorted(r.hotel_id for r in eligible_properties(df, free).collect()) == [1, 6]
    literal = dataclasses.replace(P, excluded_code_prefix="P0000_")
    assert sorted(r.hotel_id for r in eligible_properties(df, literal).collect()) == [1, 6]


def test_exclude_keys_keeps_null_keys(spark):
    df = spark.createDataFrame([("P000003",), ("P000004",), (None,)], "property_code string")
    kept = sorted((r.property_code or "") for r in exclude_keys(df, "property_code", ["P000003"]).collect())
    assert kept == ["", "P000004"]
    keys = spark.createDataFrame([("P000003",)], "k string")
    kept_df = sorted((r.property_code or "") for r in exclude_keys(df, "property_code", keys).collect())
    assert kept_df == kept


# -- JSON rules ----------------------------------------------------------------------------------------
@pytest.mark.parametrize("meta, expected", [
    (None, "Postpaid"),
    ("{}", "Postpaid"),
    ('{"advance":""}', "Partial_Prepaid"),
    ('{"advance":"30%"}', "Partial_Prepaid"),
    ('{"advance":50}', "Partial_Prepaid"),
    ('{"advance":"100%"}', "Prepaid"),
    ('{"bulk_booking_advance":"100%"}', "Prepaid"),
    ('{"bulk_booking_advance":"50%","advance":"100%"}', "Partial_Prepaid"),
    ('{"bulk_booking_advance":"\\"80\\"%"}', "Partial_Prepaid"),
    ('{"bulk_booking_advance":null,"advance":"30%"}', "Prepaid"),   # key present with JSON null
    ('{"advance":"50.5"}', "Prepaid"),                              # not an integer: NULL, not an error
    ("not json", "Prepaid"),
    ('{"other":1}', "Prepaid"),
])
def test_restriction_class(spark, meta, expected):
    df = spark.createDataFrame([(meta,)], "m string")
    assert df.select(restriction_class("m").alias("c")).first().c == expected


@pytest.mark.parametrize("meta, expected", [
    ('{"prepaid":{"advance":100}}', "Prepaid"),
    ('{"prepaid":{"advance":"100"}}', "Prepaid"),
    ('{"prepaid":{"advance":40}}', "Partial Prepaid"),
    ('{"prepaid":{"advance":0},"cash_at_hotel":true}', "Postpaid"),
    ('{"pay_before_free_cancellation_ends":true}', "Pay Later"),
    ('{"pay_after_free_cancellation_ends":"true"}', "Pay Later"),
    ('{"cash_at_hotel":false}', "Rest"),
    ("{}", "Rest"),
    (None, "Rest"),
    ("{broken", "Rest"),
])
def test_payment_policy_class(spark, meta, expected):
    df = spark.createDataFrame([(meta,)], "m string")
    assert df.select(payment_policy_class("m").alias("c")).first().c == expected


@pytest.mark.parametrize("policy, flag, restriction, expected", [
    ("Pay Later", "Yes", "Partial_Prepaid", "Pay Later"),
    ("Pay Later", "NA", "Partial_Prepaid", "Partial_Prepaid"),
    ("Postpaid", "Yes", "Postpaid", "Prepaid"),
    ("Postpaid", "NA", "Prepaid", "Postpaid"),
    ("Rest", "NA", "Postpaid", "Postpaid"),
    ("Rest", "Yes", "Postpaid", "Prepaid"),
    ("Partial Prepaid", "NA", "Postpaid", "Prepaid"),
])
def test_effective_payment_type(spark, policy, flag, restriction, expected):
    df = spark.createDataFrame([(policy, flag, restriction)], "p string, f string, r string")
    assert df.select(effective_payment_type("p", "f", "r").alias("t")).first().t == expected


def test_exclusive_tax_edge_documents(spark):
    bookings = spark.createDataFrame(
        [(1, 10, 1, 2, D(1998, 5, 1), D(1998, 5, 3)), (2, 10, 2, 2, D(1998, 5, 1), D(1998, 5, 3)),
         (3, 10, 1, 2, D(1998, 5, 1), D(1998, 5, 3)), (4, 10, 1, 2, D(1998, 5, 1), D(1998, 5, 3)),
         (5, 10, 3, 2, D(1998, 5, 1), D(1998, 5, 3)), (6, 10, 1, 2, D(1998, 3, 1), D(1998, 3, 3))],
        "id int, hotel_id int, status int, source int, checkin date, checkout date")
    dim = spark.createDataFrame([(10, "NATION_1")], "hotel_id int, country_name string")
    taxes = spark.createDataFrame([
        (1, '{"tax_breakup":[{"clusivity":"Exclusive","tax_amount":"1.25"},{"clusivity":"Inclusive","tax_amount":"9"},'
            '{"tax_amount":"7"},{"clusivity":"Exclusive","tax_amount":2}]}'),
        (2, "not json"),
        (3, None),
        (4, '{"tax_breakup":[]}'),
        (5, '{"tax_breakup":[{"clusivity":"Exclusive","tax_amount":"5"}]}'),   # cancelled: not used
        (6, '{"tax_breakup":[{"clusivity":"Exclusive","tax_amount":"5"}]}'),   # outside the window
    ], "id int, taxes string")
    got = {r.id: r.tax_amount for r in exclusive_tax_by_booking(bookings, taxes, dim, P).collect()}
    assert got == {1: 3.25}


# -- local time and late cancellations ------------------------------------------------------------------------
@pytest.mark.parametrize("offset, minutes", [("+05:30", 330), ("-03:30", -210), ("+00:00", 0), (None, None)])
def test_utc_offset(spark, offset, minutes):
    df = spark.createDataFrame([(offset,)], "o string")
    assert df.select(utc_offset_minutes("o").alias("m")).first().m == minutes


@pytest.mark.parametrize("cancel, updated, offset, status, checkin, local, late", [
    ("1998-05-01 17:30:00.000", "x", 0, 3, D(1998, 5, 1), dt.datetime(1998, 5, 1, 17, 30), False),
    ("1998-05-01 17:30:00.000", "x", 30, 3, D(1998, 5, 1), dt.datetime(1998, 5, 1, 18, 0), True),
    ("1998-05-02 01:00:00", "x", -210, 3, D(1998, 5, 1), dt.datetime(1998, 5, 1, 21, 30), True),
    ("1998-05-02 05:00:00", "x", -210, 3, D(1998, 5, 1), dt.datetime(1998, 5, 2, 1, 30), True),
    ("1998-05-02 05:00:00", "x", 0, 4, D(1998, 5, 1), dt.datetime(1998, 5, 2, 5, 0), False),
    ("null", "1998-05-09 20:00:00", 0, 3, D(1998, 5, 1), dt.datetime(2000, 1, 1, 1, 1, 1), True),
    (None, "1998-04-30 20:00:00", 0, 3, D(1998, 5, 1), dt.datetime(1998, 4, 30, 20, 0), False),
    (None, None, 60, 3, D(1998, 5, 1), dt.datetime(2000, 1, 1, 2, 1, 1), True),
    ("1998-05-01 19:00:00", "x", None, 3, D(1998, 5, 1), None, None),
])
def test_local_cancel_time_and_late_flag(spark, cancel, updated, offset, status, checkin, local, late):
    df = spark.createDataFrame([(cancel, updated, offset, status, checkin)],
                               "c string, u string, o int, status int, checkin date")
    r = (df.withColumn("lt", local_cancel_time("c", "u", "o"))
         .select("lt", is_late_cancellation("status", "lt", "checkin").alias("late")).first())
    assert r.lt == local
    assert r.late == late


# -- supply and windows -----------------------------------------------------------------------------------
@pytest.mark.parametrize("status, srns, urn, expected", [
    (2, 10, 3, 10), (2, 0, 3, 3), (1, 10, 3, 3), (1, 10, 0, 0), (3, 0, 0, 0), (2, 0, 0, 0),
])
def test_supply_correction(spark, status, srns, urn, expected):
    df = spark.createDataFrame([(status, srns, urn)], "hotel_status int, srns bigint, urn bigint")
    assert df.select(corrected_srns().alias("s")).first().s == expected


def test_latest_live_date_tie_is_deterministic(spark):
    t = dt.datetime(2024, 1, 5, 10, 0)
    rows = [("P1", "Blocked", "Live", t), ("P1", "On Hold", "Live", t), ("P1", "Active", "Live", t - dt.timedelta(1)),
            ("P1", "On Hold", "Blocked", t + dt.timedelta(1)), ("P2", "On Hold", "Active", t)]
    df = spark.createDataFrame(rows, "property_code string, old_status string, new_status string, "
                                     "changed_at timestamp_ntz")
    out = [tuple(r) for r in latest_live_date(df).collect()]
    assert out == [("P1", "On Hold", "Live", D(2024, 1, 5))]


def test_latest_rows_with_null_times_are_kept(spark):
    from innsight.operators.policy import active_policies

    t = dt.datetime(2024, 1, 5, 10, 0)
    rows = [("P1", "Blocked", "Live", None), ("P1", "On Hold", "Live", None), ("P2", "Active", "Live", t),
            ("P2", "Blocked", "Live", None), (None, "Active", "Live", None)]
    df = spark.createDataFrame(rows, "property_code string, old_status string, new_status string, "
                                     "changed_at timestamp_ntz")
    out = {r.property_code: (r.old_status, r.live_date) for r in latest_live_date(df).collect()}
    assert out == {"P1": ("On Hold", None), "P2": ("Active", D(2024, 1, 5)), None: ("Active", None)}
    rows = [(1, None, 1, "a"), (1, None, 2, "b"), (2, t, 1, "c"), (2, None, 2, "d"), (None, None, 1, "e")]
    df = spark.createDataFrame([(*r, P.policy_id, 1, 0, 99_999_999, "209901") for r in rows],
                               "hotel_id int, updated_at timestamp_ntz, policy_row int, metadata string, "
                               "policy_id int, status int, start_day int, end_day int, inserted_at string")
    out = {r.hotel_id: (r.policy_row, r.metadata, r.updated_at) for r in active_policies(df, P).collect()}
    assert out == {1: (2, "b", None), 2: (1, "c", t), None: (1, "e", None)}


def test_zero_fill_numbers_and_text(spark):
    df = spark.createDataFrame([(None, None, None, D(2020, 1, 1))], "a bigint, b double, s string, d date")
    r = zero_fill(df).first()
    assert (r.a, r.b, r.s, r.d) == (0, 0.0, "0", D(2020, 1, 1))
    assert zero_fill(df, text_fill=None).first().s is None


def test_rule_lists_are_consistent():
    labels = [label for label, _ in R.OTA_NAME_LABELS]
    assert len(set(labels)) == len(labels)
    assert set(R.OTA_GROUP) - {R.OTHER_OTA} <= set(labels)
    assert set(R.GROWTH_GROUP) <= set(R.DEFAULT_CHANNELS)
    assert len(set(R.DEFAULT_CHANNELS)) == len(R.DEFAULT_CHANNELS)


def test_policy_month_floor(spark):
    from innsight.operators.policy import active_restrictions, default_policies_active

    rows = [(1, 12, 1, "{}", 0, 20000, "201806"), (2, 12, 1, "{}", 0, 20000, "201807"), (3, 12, 1, "{}", 0, 20000, None)]
    df = spark.createDataFrame(rows, "hotel_id int, restriction_id int, status int, metadata string, from_day int, "
                                     "to_day int, inserted_at string")
    assert [r.hotel_id for r in active_restrictions(df, P).collect()] == [2]
    d = spark.createDataFrame([(1, 3, 1, "{}", "201701"), (2, 3, 1, "{}", "202001")],
                              "country_id int, policy_id int, status int, metadata string, inserted_at string")
    assert [r.country_id for r in default_policies_active(d, P).collect()] == [2]


def test_per_night_value_never_raises_on_zero_nights(spark):
    from innsight.functions.exprs import per_night

    df = spark.createDataFrame([(10.0, 0), (10.0, 4)], "v double, r int")
    assert [r.x for r in df.select(per_night(df.v, df.r).alias("x")).collect()] == [None, 2.5]


def test_exclusive_tax_reads_documents_from_the_booking_rows_when_told(spark):
    from innsight.sources.fixtures import LodgingSources

    src = LodgingSources(spark, "/root/testdata/sf0.01")
    split = exclusive_tax_by_booking(src.bookings, src.booking_taxes, src.hotel_dim, P, ("checkin", "checkout"))
    # The same documents carried on the booking rows (one row per tax line, as the fixture keeps them).
    inline = src.bookings.join(src.booking_taxes, "id")
    merged = exclusive_tax_by_booking(inline, None, src.hotel_dim, P, ("checkin", "checkout"), taxes_on_bookings=True)

    assert sorted(map(str, split.collect())) == sorted(map(str, merged.collect())) != []


def test_stay_nights_follow_a_calendar_with_gaps(spark):
    df = spark.createDataFrame(STAYS, "id int, checkin date, checkout date")
    cal = spark.createDataFrame([(D(1998, 5, 2),), (D(1998, 5, 3),), (D(1998, 5, 3),), (D(1998, 7, 1),)], "d date")
    got = sorted((r.id, r.date) for r in stay_nights(df, P.window_start, P.window_end, calendar=cal).collect())
    assert got == sorted((i, d) for i, d in brute_force_nights(STAYS, P.window_start, P.window_end)
                         if d in (D(1998, 5, 2), D(1998, 5, 3)))


def _one_booking(**changes):
    """One used booking of channel Agoda with one night in the window."""
    row = dict(id=1, hotel_id=7, status=1, source=1, sub_source=None, ota_id=0, micro_market_id=None, rooms=2,
               amount=None, selling_amount=None, discount=None, checkin=D(1998, 5, 1), checkout=D(1998, 5, 2),
               created_date=D(1998, 4, 1), cancellation_time=None, updated_at="1998-05-01 20:00:00", inserted_at="199805")
    return {**row, **changes}


BOOKING_SCHEMA = ("id long, hotel_id long, status int, source int, sub_source int, ota_id int, micro_market_id int, "
                  "rooms int, amount decimal(18,2), selling_amount decimal(18,2), discount decimal(18,2), checkin date, "
                  "checkout date, created_date date, cancellation_time string, updated_at string, inserted_at string")


def _source(spark, bookings, tax="7", calendar=(D(1998, 5, 1),)):
    from types import SimpleNamespace

    frame = spark.createDataFrame([tuple(b.values()) for b in bookings], BOOKING_SCHEMA)
    dim = spark.createDataFrame([(7, "P000100", "Plain", "BUILDING", 1, "NATION_1", "C", "Z", 0, 2)],
                                "hotel_id long, property_code string, hotel_name string, product string, country_id int, "
                                "country_name string, city_name string, zone_name string, cluster_id int, status_id int")
    doc = f'{{"tax_breakup":[{{"clusivity":"Exclusive","tax_amount":"{tax}"}}]}}'
    return SimpleNamespace(
        spark=spark, bookings=frame, bookings_base=frame, hotel_dim=dim,
        booking_taxes=spark.createDataFrame([(1, doc)], "id long, taxes string"),
        online_travel_agents=spark.createDataFrame([(0, "Agoda")], "id int, name string"),
        source_enums=spark.createDataFrame([(8, "Partner Desk"), (6, "Walk In")], "enum_key int, enum_val string"),
        calendar=spark.createDataFrame([(d,) for d in calendar], "d date"),
        clusters=spark.createDataFrame([], "id int, city_id int"),
        cities=spark.createDataFrame([], "id int, time_zone string"),
        city_tz=spark.createDataFrame([], "name string, utc_offset string"))


def test_tax_counts_where_the_value_is_missing(spark):
    from innsight.operators.demand import channel_demand, daily_demand
    from innsight.plans.report import demand_by_channel_for, demand_daily_wide

    by_channel = demand_by_channel_for(_source(spark, [_one_booking()]), P)
    for r in (daily_demand(by_channel).first(), channel_demand(by_channel).first(),
              demand_daily_wide(by_channel, ("Agoda",)).first()):
        assert float(r["urn_gmv"]) == 7 and float(r["gmv_brn"]) == 0 and r["urn"] == 2
    wide = demand_daily_wide(by_channel, ("Agoda",)).first()
    assert float(wide["Agoda_urn_gmv"]) == 7 == float(wide["OTA_gmv_urn"])


def test_no_channel_is_lost_whatever_columns_are_asked_for(spark):
    from innsight.operators.channels import known_channels
    from innsight.plans.report import demand_by_channel_for, demand_channels, demand_daily_wide

    src = _source(spark, [_one_booking(), _one_booking(id=2, source=8, ota_id=None), _one_booking(id=3, source=99, ota_id=None),
                          _one_booking(id=4, source=6, ota_id=None, rooms=1)])
    by_channel = demand_by_channel_for(src, P)
    for channels in ((), ("Walk In",), ("Agoda", "Partner Desk"), known_channels(src.source_enums)):
        r = demand_daily_wide(by_channel, channels).first()
        assert sum(r[f"{c}_urn"] for c in demand_channels(channels) if c != "OTA") == r["urn"] == 7
        assert r["OTA_urn"] == 2 and r["Growth_urn"] == 0
    assert "Partner Desk" in known_channels(src.source_enums)


def test_the_report_path_follows_the_calendar(spark):
    from innsight.plans.report import demand_by_channel_for, realization_by_channel_for

    two_nights = [_one_booking(checkout=D(1998, 5, 3))]
    for days, n in (((D(1998, 5, 1), D(1998, 5, 2)), 2), ((D(1998, 5, 2),), 1), ((D(1998, 6, 1),), 0)):
        src = _source(spark, two_nights, calendar=days)
        assert demand_by_channel_for(src, P).count() == realization_by_channel_for(src, P).count() == n


def test_decimal_advances_are_rounded(spark):
    docs = ['{"prepaid":{"advance":100.0}}', '{"prepaid":{"advance":50.5}}', '{"prepaid":{"advance":"x"}}',
            '{"prepaid":{"advance":null}}', '{"prepaid":{"advance":99.6}}']
    df = spark.createDataFrame([(i, m) for i, m in enumerate(docs)], "i int, m string")
    got = [r[0] for r in df.orderBy("i").select(payment_policy_class("m")).collect()]
    assert got == ["Prepaid", "Partial Prepaid", "Rest", "Rest", "Prepaid"]


def test_sums_do_not_depend_on_partitioning(spark):
    from innsight.plans.report import demand_by_channel_for
    from innsight.sources.fixtures import LodgingSources

    src = LodgingSources(spark, "/root/testdata/sf0.001")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(map(str, demand_by_channel_for(src, P).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] != []
