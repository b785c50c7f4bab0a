"""Sums by night from difference arrays against the stays expanded night by night."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from innsight.operators.bookings import stay_nights
from innsight.operators.demand import demand_by_channel, demand_measures, demand_stays
from innsight.operators.intervals import changes, sums_by_night
from innsight.operators.realization import realization_by_channel, realization_measures
from innsight.params import DEFAULT_PARAMS as P
from innsight.sources.fixtures import LodgingSources

from conftest import SF_SMOKE

START, END = dt.date(2024, 1, 10), dt.date(2024, 2, 20)
SCHEMA = "k string, c string, checkin date, checkout date, n int, v decimal(28,10)"


def brute(rows, days=None):
    out = {}
    for k, c, a, b, n, v in rows:
        for i in range((b - a).days):
            d = a + dt.timedelta(i)
            if START <= d <= END and (days is None or d in days):
                was = out.get((k, c, d), (0, None))
                out[k, c, d] = (was[0] + (n or 0), was[1] if v is None else (was[1] or 0) + v)
    return {x: (n, None if v is None else Decimal(v)) for x, (n, v) in out.items()}


def got(spark, rows, calendar=None):
    df = spark.createDataFrame(rows, SCHEMA)
    sums = sums_by_night(df, ["k", "c"], {"n": F.col("n"), "v": F.col("v")}, START, END, calendar, nullable=["v"])
    found = sums.collect()
    out = {(r.k, r.c, r.date): (r.n, r.v) for r in found}
    assert len(out) == len(found)
    return out


def day(i):
    return START + dt.timedelta(i)


STAYS = [("a", "x", day(0), day(3), 2, Decimal("1.5")), ("a", "x", day(2), day(4), 1, None),
         ("a", "x", day(6), day(6), 9, Decimal(9)), ("a", "x", day(8), day(7), 9, Decimal(9)),
         ("a", None, day(-200), day(100), 1, Decimal("0.0000000001")), (None, "x", day(-5), day(1), None, None),
         ("b", "x", day(41), day(42), 4, Decimal(3)), ("b", "x", day(42), day(44), 4, Decimal(3)),
         ("b", "x", day(40), day(41), 1, Decimal(-3)), ("c", "x", day(5), day(7), 1, Decimal(1)),
         ("c", "x", day(7), day(9), 2, Decimal(2)), ("c", "x", day(5), day(7), 1, Decimal(1))]


def test_edges_equal_the_expanded_stays(spark):
    assert got(spark, STAYS) == brute(STAYS)
    days = [day(1), day(6), day(7), day(41), day(60)]
    calendar = spark.createDataFrame([(d,) for d in days] * 2, "d date")
    assert got(spark, STAYS, calendar) == brute(STAYS, days)
    assert got(spark, []) == {}


def test_long_stays_cost_two_rows(spark):
    rows = [(f"k{i % 3}", "x", day(i % 30 - 150), day(i % 30 + 150), i, Decimal(i)) for i in range(60)]
    assert got(spark, rows) == brute(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    # all stays cover the whole window: one change per key, on its first day, and none to take off in it
    assert changes(df, ["k", "c"], ["n"], [], START, END).count() == 3


stays = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", None]), st.integers(-20, 60),
                           st.integers(-1, 300), st.one_of(st.none(), st.integers(0, 5)),
                           st.one_of(st.none(), st.integers(-900, 900))), min_size=1, max_size=30)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=stays)
def test_any_stays_equal_the_expanded_ones(spark, rows):
    rows = [(k, c, day(a), day(a + n), m, None if v is None else Decimal(v) / 8) for k, c, a, n, m, v in rows]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("which", ["demand", "realization"])
def test_report_aggregates_equal_the_expanded_stays(spark, which):
    """The report's own measures, summed over nights that a generator made."""
    src = LodgingSources(spark, SF_SMOKE)
    if which == "demand":
        stays = demand_stays(src.bookings, src.bookings_base, src.booking_taxes, src.hotel_dim,
                             src.online_travel_agents, src.source_enums, P)
        measures, sums = demand_measures(), demand_by_channel(stays, P, src.calendar)
    else:
        from innsight.operators.realization import realization_bookings

        stays = realization_bookings(src.bookings_base, src.hotel_dim, src.online_travel_agents, src.source_enums,
                                     src.clusters, src.cities, src.city_tz, P)
        measures, sums = realization_measures(), realization_by_channel(stays, P, src.calendar)
    nights = stay_nights(stays, P.window_start, P.window_end, calendar=src.calendar)
    expanded = nights.groupBy("property_code", "booking_source", "date").agg(
        *[F.sum(c).alias(m) for m, c in measures.items()])
    names = ["property_code", "booking_source", "date", *measures]
    assert sorted(map(str, sums.select(names).collect())) == sorted(map(str, expanded.select(names).collect())) != []
