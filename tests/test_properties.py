"""Property tests: operators against small pure-Python models on random inputs (NULLs included)."""

import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from innsight.functions import rules as R
from innsight.operators.bookings import stay_nights
from innsight.operators.channels import FULL_RULES, REDUCED_RULES, classify
from innsight.operators.policy import restriction_class
from innsight.params import ReportParams

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
BASE = dt.date(1998, 4, 1)


# -- stay nights --------------------------------------------------------------------------------------------
stays = st.lists(st.tuples(st.integers(-150, 150), st.integers(-5, 40)), min_size=1, max_size=40)


@SETTINGS
@given(stays=stays, as_of_shift=st.integers(-40, 40))
def test_stay_nights_equal_brute_force(spark, stays, as_of_shift):
    p = ReportParams(as_of=dt.date(1998, 6, 15) + dt.timedelta(days=as_of_shift))
    rows = [(i, BASE + dt.timedelta(days=a), BASE + dt.timedelta(days=a + n)) for i, (a, n) in enumerate(stays)]
    df = spark.createDataFrame(rows, "id int, checkin date, checkout date")
    got = sorted((r.id, r.date) for r in stay_nights(df, p.window_start, p.window_end).collect())
    expected = []
    for i, ci, co in rows:
        d = p.window_start
        while d <= p.window_end:
            if ci <= d < co:
                expected.append((i, d))
            d += dt.timedelta(days=1)
    assert got == sorted(expected)


# -- channel ladders ------------------------------------------------------------------------------------------
def _and(*xs):
    if any(x is False for x in xs):
        return False
    return None if any(x is None for x in xs) else True


def _not(x):
    return None if x is None else not x


def _isin(x, xs):
    return None if x is None else x in xs


def _eq(x, v):
    return None if x is None else x == v


def channel_model(row, full: bool):
    source, sub, ota_id, mm, label, enum = row
    ota_src = _and(_isin(source, R.OTA_SOURCES), mm is None)
    not_gds = _not(_isin(ota_id, R.GDS_OTA_IDS)) if full else True
    rules = [
        (_and(ota_src, label is None, not_gds), R.OTHER_OTA),
        (_and(ota_src, not_gds), label),
        (_and(_eq(source, R.MIGRATION_SOURCE), mm is None), R.MIGRATION_OTA),
        (_and(mm is not None, None if mm is None else mm > 0, _not(_isin(mm, R.NON_MM_MICRO_MARKETS))),
         R.MICRO_MARKET),
        (_and(_eq(source, R.META_SOURCE), _eq(sub, R.BOG_SUB_SOURCE)), R.BOG),
    ]
    if full:
        rules += [(_and(_eq(source, R.META_SOURCE), _eq(sub, R.TRIVAGO_SUB_SOURCE)), R.TRIVAGO),
                  (_isin(ota_id, R.GDS_OTA_IDS), R.GDS)]
    for cond, out in rules:
        if cond is True:
            return out
    return enum


channel_rows = st.lists(st.tuples(
    st.sampled_from([None, 1, 10, 64, 71, 2, 5, 13]),
    st.sampled_from([None, 22, 23, 24]),
    st.sampled_from([None, 0, 3, 9, 90, 94, 95]),
    st.sampled_from([None, 0, -1, 7, 306, 99]),
    st.sampled_from([None, "Agoda", "other_ota"]),
    st.sampled_from([None, "OTA", "Web Booking"]),
), min_size=1, max_size=60)


@SETTINGS
@given(rows=channel_rows)
def test_channel_ladders_follow_three_valued_case(spark, rows):
    df = spark.createDataFrame(rows, "source int, sub_source int, ota_id int, micro_market_id int, "
                                     "ota_label string, enum_val string")
    got = [(r.f, r.r) for r in df.select(classify(FULL_RULES).alias("f"), classify(REDUCED_RULES).alias("r"))
           .collect()]
    assert got == [(channel_model(row, True), channel_model(row, False)) for row in rows]


# -- restriction class ----------------------------------------------------------------------------------------
def restriction_model(meta):
    if meta is None or meta == "{}":
        return "Postpaid"
    try:
        doc = json.loads(meta)
    except ValueError:
        doc = None

    def text(key):
        if not isinstance(doc, dict) or doc.get(key) is None:
            return None
        v = doc[key]
        return v if isinstance(v, str) else json.dumps(v)

    def percent(key):
        t = text(key)
        if t is None:
            return None
        t = t.replace("%", "").replace('"', "") or "0"
        return int(t) if t.isdigit() else None

    bulk_present = isinstance(doc, dict) and "bulk_booking_advance" in doc
    value = percent("bulk_booking_advance") if bulk_present else percent("advance")
    return "Partial_Prepaid" if value is not None and value < 100 else "Prepaid"


advance_values = st.one_of(st.none(), st.integers(0, 250), st.integers(0, 250).map(lambda i: f"{i}%"),
                           st.integers(0, 250).map(lambda i: f'"{i}"%'), st.integers(0, 250).map(str),
                           st.sampled_from(["", "abc", "50.5", "%"]), st.booleans())
documents = st.one_of(
    st.none(), st.sampled_from(["{}", "not json", "[1,2]"]),
    st.fixed_dictionaries({}, optional={"bulk_booking_advance": advance_values, "advance": advance_values,
                                        "other": st.integers()}).map(json.dumps))


@SETTINGS
@given(metas=st.lists(documents, min_size=1, max_size=40))
def test_restriction_class_matches_model(spark, metas):
    df = spark.createDataFrame([(m,) for m in metas], "m string")
    got = [r.c for r in df.select(restriction_class("m").alias("c")).collect()]
    assert got == [restriction_model(m) for m in metas]


# -- payment-policy class ----------------------------------------------------------------------------------
def payment_model(meta):
    try:
        doc = json.loads(meta) if meta is not None else None
    except ValueError:
        doc = None

    def text(*path):
        cur = doc
        for key in path:
            if not isinstance(cur, dict) or key not in cur:
                return None
            cur = cur[key]
        return None if cur is None else (cur if isinstance(cur, str) else json.dumps(cur))

    t = text("prepaid", "advance")
    advance = int(t) if t is not None and t.lstrip("-").isdigit() and t.count("-") <= 1 and not t.endswith("-") \
        else None
    if advance == 100:
        return "Prepaid"
    if advance is not None and 0 < advance < 100:
        return "Partial Prepaid"
    if text("cash_at_hotel") == "true":
        return "Postpaid"
    if "true" in (text("pay_before_free_cancellation_ends"), text("pay_after_free_cancellation_ends")):
        return "Pay Later"
    return "Rest"


flags = st.one_of(st.none(), st.booleans(), st.sampled_from(["true", "false", "yes", 1]))
policies = st.one_of(
    st.none(), st.sampled_from(["{}", "{broken", "[]"]),
    st.fixed_dictionaries({}, optional={
        "prepaid": st.one_of(st.none(), st.fixed_dictionaries({}, optional={"advance": st.one_of(
            st.none(), st.integers(-20, 150), st.integers(-20, 150).map(str), st.sampled_from(["abc", "50.5"]),
            st.booleans(), st.floats(0, 150, allow_nan=False).map(lambda f: round(f, 1)))})),
        "cash_at_hotel": flags,
        "pay_before_free_cancellation_ends": flags,
        "pay_after_free_cancellation_ends": flags,
    }).map(json.dumps))


@SETTINGS
@given(metas=st.lists(policies, min_size=1, max_size=40))
def test_payment_policy_class_matches_model(spark, metas):
    from innsight.operators.policy import payment_policy_class

    df = spark.createDataFrame([(m,) for m in metas], "m string")
    got = [r.c for r in df.select(payment_policy_class("m").alias("c")).collect()]
    assert got == [payment_model(m) for m in metas]


# -- local cancellation time and late flag ------------------------------------------------------------------
def local_time_model(cancel, updated, offset):
    raw = cancel if cancel is not None else updated
    text = raw if raw is not None and raw != "null" else "2000-01-01 01:01:01"
    try:
        ts = dt.datetime.strptime(text[:19], "%Y-%m-%d %H:%M:%S")
    except ValueError:
        ts = None
    return None if ts is None or offset is None else ts + dt.timedelta(minutes=offset)


def late_model(status, local, checkin):
    if status != 3:
        return False
    if local is None:
        return None
    return (local.date() == checkin and local.hour >= 18) or local.date() > checkin


stamps = st.one_of(
    st.none(), st.just("null"), st.just("garbage"),
    st.datetimes(min_value=dt.datetime(1998, 4, 1), max_value=dt.datetime(1998, 5, 10)).map(
        lambda d: d.strftime("%Y-%m-%d %H:%M:%S") + ".000"))
cancel_rows = st.lists(st.tuples(stamps, stamps, st.one_of(st.none(), st.integers(-600, 600)),
                                 st.sampled_from([0, 3, 4]),
                                 st.dates(min_value=dt.date(1998, 4, 1), max_value=dt.date(1998, 5, 10))),
                       min_size=1, max_size=40)


@SETTINGS
@given(rows=cancel_rows)
def test_local_cancel_time_and_late_flag_match_model(spark, rows):
    from innsight.functions.exprs import is_late_cancellation, local_cancel_time

    df = spark.createDataFrame(rows, "c string, u string, o int, status int, checkin date")
    out = (df.withColumn("lt", local_cancel_time("c", "u", "o"))
           .select("lt", is_late_cancellation("status", "lt", "checkin").alias("late")).collect())
    expected = []
    for c, u, o, status, checkin in rows:
        local = local_time_model(c, u, o)
        expected.append((local, late_model(status, local, checkin)))
    assert [(r.lt, r.late) for r in out] == expected
