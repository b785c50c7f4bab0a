"""Lodging source tables derived from the driver's TPC-H-like tables.

The report reads about a dozen operational tables (property dimension, bookings, booking taxes, daily
supply, status history, policies, restrictions and small lookups). The test data has none of them, so
each one is derived here from the driver tables with plain DataFrame expressions; the derivation rules
are those of FIXTURES.md section B. Every table is a lazy plan over the parquet scans, so its size grows
with the input scale factor and Catalyst prunes the columns a query does not use.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def _pick(key_mod: Column, values: tuple) -> Column:
    """``values[key_mod]`` for a 0-based integer ``key_mod``."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key_mod + 1).cast("int"))


def _code(key: Column) -> Column:
    """Property code text ``P`` + six-digit zero-padded key."""
    return F.concat(F.lit("P"), F.lpad(key.cast("string"), 6, "0"))


def _spread(key: str, salt: int, n: int) -> Column:
    """A number below ``n`` that varies with the key, differently for each salt."""
    return F.expr(f"({key} % 100003 * {31337 + 1009 * salt} % 100003) % {n}").cast("int")


# Small lookup tables of the fixture (fixed values). Agent 9 and source 9 have no row; "Partner Desk" is a label
# outside the default channel list.
ONLINE_TRAVEL_AGENTS = [(0, "Agoda"), (1, "Booking.com"), (2, "Axis_Expedia"), (3, "Hotel Beds"), (4, "HotelTonight"),
                        (5, "RG_GetARoom"), (6, "RateGain"), (7, "Hotwire"), (8, "Some Other Agent"),
                        (10, "TraveLoka"), (11, "GoIbibo"), (12, "Rakuten"), (13, "Jalan"), (90, "GDS One")]
SOURCE_ENUMS = [(1, "OTA"), (10, "OTA Direct"), (64, "Migration"), (71, "Meta"), (2, "Android App"), (3, "IOS App"),
                (4, "Mobile Web Booking"), (5, "Web Booking"), (6, "Walk In"), (7, "Direct"), (8, "Partner Desk")]
CLUSTERS = [(0, 0), (1, 1), (2, 2), (3, 0), (4, 1), (5, 2)]
CITIES = [(0, "Zone A"), (1, "Zone B"), (2, "Zone C")]
CITY_TZ = [("Zone A", "+00:00"), ("Zone B", "+05:30"), ("Zone C", "-03:30")]


class LodgingSources:
    """The lodging tables of one scale-factor folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _read(self, name: str, columns: list[str]) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, columns)

    # -- dimension ------------------------------------------------------------------------------------
    @cached_property
    def hotel_dim(self) -> DataFrame:
        """One row per property: ids, code, name, product, country, city, zone, cluster, status."""
        c = self._read("customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
        # nation (25 rows) and region (5 rows) have a fixed size at every scale factor.
        n = self._read("nation", ["n_nationkey", "n_name", "n_regionkey"])
        r = self._read("region", ["r_regionkey", "r_name"])
        k = F.col("c_custkey")
        name_prefix = F.when(k % 40 == 0, "Training ").when(k % 40 == 1, "QA Test ").otherwise("")
        return (c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
                .join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
                .select(k.alias("hotel_id"),
                        _code(k).alias("property_code"),
                        F.concat(name_prefix, F.col("c_name")).alias("hotel_name"),
                        F.col("c_mktsegment").alias("product"),
                        F.col("c_nationkey").cast("int").alias("country_id"),
                        F.col("n_name").alias("country_name"),
                        F.col("r_name").alias("city_name"),
                        F.concat(F.lit("Z"), (k % 5).cast("string")).alias("zone_name"),
                        (k % 7).cast("int").alias("cluster_id"),
                        F.when(k % 9 == 0, 1).otherwise(2).alias("status_id")))

    # -- facts ----------------------------------------------------------------------------------------
    @cached_property
    def bookings(self) -> DataFrame:
        """One row per booking (from orders)."""
        o = self._read("orders", ["o_orderkey", "o_custkey", "o_totalprice"])

        def of(salt: int, n: int) -> Column:
            return _spread("o_orderkey", salt, n)

        checkin = F.date_add(F.lit("1998-03-20").cast("date"), of(10, 90))
        amount = F.col("o_totalprice").cast("decimal(18,2)")
        cancel_day = F.date_add(checkin, of(14, 3) - 1).cast("string")
        return o.select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("hotel_id"),
            _pick(of(1, 8), (0, 1, 2, 3, 4, 13, 1, 5)).alias("status"),
            _pick(of(2, 20), (1, 10, 64, 71, 13, 14, 2, 3, 4, 5, 6, 1, 7, 8, 9, 71, 1, 1, 10, 71)).alias("source"),
            (22 + of(3, 3)).cast("int").alias("sub_source"),
            F.when(of(4, 17) == 0, 90).when(of(4, 7) != 4, of(5, 14)).cast("int").alias("ota_id"),
            F.when(of(6, 5) == 0, 306).when(of(6, 13) == 0, 7).cast("int").alias("micro_market_id"),
            (1 + of(7, 3)).cast("int").alias("rooms"),
            F.when(of(8, 20) != 0, amount).alias("amount"),
            F.when(of(8, 5) != 0, amount - 10).cast("decimal(18,2)").alias("selling_amount"),
            F.when(of(9, 4) != 0, F.lit(5.25).cast("decimal(18,2)")).alias("discount"),
            checkin.alias("checkin"),
            F.date_add(checkin, of(11, 6)).alias("checkout"),
            F.date_sub(checkin, of(12, 30)).alias("created_date"),
            F.when(of(13, 7) == 0, F.lit("null"))
             .when(of(13, 7) != 1, F.concat(cancel_day, F.lit(" "), F.lpad(of(15, 24).cast("string"), 2, "0"),
                                            F.lit(":30:00.000"))).alias("cancellation_time"),
            F.concat(checkin.cast("string"), F.lit(" 20:00:00")).alias("updated_at"),
            F.when(of(16, 23) == 0, "199701").otherwise(F.date_format(checkin, "yyyyMM")).alias("inserted_at"),
        )

    @cached_property
    def bookings_base(self) -> DataFrame:
        """The raw booking table of the tax and realization operators: not every booking is in it."""
        return self.bookings.filter(_spread("id", 17, 10) != 0)

    @cached_property
    def booking_taxes(self) -> DataFrame:
        """Tax documents ``{"tax_breakup":[{"clusivity":..,"tax_amount":..}]}`` keyed by booking id.

        One document per tax line (order line), so an id can have several documents. Tax is summed per id
        downstream, so the totals equal those of one combined document per booking, and no group of lines is
        ever gathered into one row (the number of lines per order is not bounded by the data).
        """
        li = self._read("lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_tax", "l_returnflag"])
        amount = (F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)")).cast("string")
        clusivity = F.when(F.col("l_returnflag") == "A", "Inclusive").otherwise("Exclusive")
        entry = (F.when(F.col("l_linenumber") % 5 == 0, F.lit('{"tax_amount":"1.00"}'))
                 .otherwise(F.concat(F.lit('{"clusivity":"'), clusivity, F.lit('","tax_amount":"'), amount,
                                     F.lit('"}'))))
        document = F.concat(F.lit('{"tax_breakup":['), entry, F.lit("]}"))
        return li.select(F.col("l_orderkey").alias("id"),
                         F.when(F.col("l_linenumber") % 7 == 6, "not json").otherwise(document).alias("taxes"))

    @cached_property
    def hotel_date_summary(self) -> DataFrame:
        """Daily supply per property and status (several statuses per property-day occur)."""
        li = self._read("lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
        o = self._read("orders", ["o_orderkey", "o_custkey"])
        rooms = F.col("l_quantity").cast("int")
        day = F.date_add(F.lit("1998-03-28").cast("date"), _spread("o_orderkey", 18, 80))
        return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
                .select(F.when(_spread("o_orderkey", 20, 97) != 0, _code(F.col("o_custkey"))).alias("property_code"),
                        F.date_add(day, (F.col("l_linenumber") % 4).cast("int")).alias("d"),
                        (F.col("l_linenumber") % 6).cast("int").alias("hotel_status"),
                        rooms.alias("sellable_rooms"),
                        (rooms + 5).alias("total_contracted_rooms")))

    @cached_property
    def status_changes(self) -> DataFrame:
        """Property status history (from events)."""
        e = self._read("events", ["event_id", "ts", "user_id", "event_type"])
        et = F.col("event_type")
        new_status = (F.when(et == "signup", "Live").when(et == "error", "Blocked").when(et == "view", "On Hold")
                      .when(et == "click", "Active").otherwise("In Progress"))
        return e.select(_code(F.col("user_id")).alias("property_code"),
                        F.when(F.col("event_id") % 2 == 0, "Blocked").otherwise("On Hold").alias("old_status"),
                        new_status.alias("new_status"),
                        F.col("ts").alias("changed_at"))

    @cached_property
    def hotel_policies(self) -> DataFrame:
        """Payment policies per property with validity days (epoch days) and update time (from orders)."""
        o = self._read("orders", ["o_orderkey", "o_custkey", "o_orderdate"])
        k = F.col("o_orderkey")
        start = F.unix_date(F.lit("1998-03-01").cast("date")) + _spread("o_orderkey", 21, 120)
        metadata = _pick(_spread("o_orderkey", 22, 10), ('{"prepaid":{"advance":100.0}}', '{"prepaid":{"advance":50.5}}',
                                 '{"prepaid":{"advance":null}}', '{"prepaid":{"advance":100}}', '{"prepaid":{"advance":40}}', '{"cash_at_hotel":true}',
                                 '{"pay_before_free_cancellation_ends":true}',
                                 '{"pay_after_free_cancellation_ends":true}', '{"prepaid":{"advance":0}}', "{}"))
        return o.select(F.col("o_custkey").alias("hotel_id"), k.alias("policy_row"),
                        (2 + k % 3).cast("int").alias("policy_id"), (k % 2).cast("int").alias("status"),
                        metadata.alias("metadata"), start.alias("start_day"), (start + 90).alias("end_day"),
                        F.col("o_orderdate").alias("updated_at"),
                        F.when(_spread("o_orderkey", 19, 10) == 0, "201806").otherwise("201808").alias("inserted_at"))

    @cached_property
    def default_policies(self) -> DataFrame:
        """Country default payment policy (from nation)."""
        n = self._read("nation", ["n_nationkey"])
        return n.select(F.col("n_nationkey").cast("int").alias("country_id"), F.lit(3).alias("policy_id"),
                        F.lit(1).alias("status"),
                        F.when(F.col("n_nationkey") % 2 == 0, '{"cash_at_hotel":true}')
                         .otherwise('{"pay_before_free_cancellation_ends":true}').alias("metadata"),
                        F.when(F.col("n_nationkey") % 10 == 2, "201806").otherwise("201808").alias("inserted_at"))

    @cached_property
    def hotel_restrictions(self) -> DataFrame:
        """Prepaid restrictions per property with validity days (from lineitem)."""
        li = self._read("lineitem", ["l_orderkey", "l_suppkey", "l_linenumber"])
        start = F.unix_date(F.lit("1998-01-01").cast("date")) + _spread("l_orderkey", 23, 240)
        metadata = _pick(_spread("l_orderkey", 24, 6), ('{"bulk_booking_advance":null,"advance":"100%"}',
                                                  "{}", '{"advance":""}', '{"bulk_booking_advance":"100%"}',
                                                  '{"bulk_booking_advance":"50%","advance":"100%"}',
                                                  '{"advance":"30%"}'))
        ln = F.col("l_linenumber")
        return li.select(F.col("l_suppkey").alias("hotel_id"), (11 + ln % 2).cast("int").alias("restriction_id"),
                         F.when(ln % 4 == 3, 0).otherwise(1).alias("status"), metadata.alias("metadata"),
                         start.alias("from_day"), (start + 120).alias("to_day"),
                         F.when(_spread("l_orderkey", 25, 10) == 0, "201806").otherwise("201808").alias("inserted_at"))

    @cached_property
    def calendar(self) -> DataFrame:
        """Date spine over the days that bookings can have, four to a nation; every eleventh day is missing, and so
        are its nights. A calendar is a small table of its own, so it is never derived from the bookings."""
        first = F.date_add(F.lit("1998-03-20").cast("date"), (4 * F.col("n_nationkey")).cast("int"))
        days = self._read("nation", ["n_nationkey"]).select(F.explode(F.sequence(first, F.date_add(first, 3))).alias("d"))
        return days.where(F.unix_date("d") % 11 != 5)

    # -- lookups --------------------------------------------------------------------------------------
    def _values(self, rows, schema: str) -> DataFrame:
        """Inline rows as a ``VALUES`` relation. Unlike ``createDataFrame`` (an RDD scan without statistics),
        it has an exact size, so the planner can see a lookup is small and broadcast it."""
        def lit(v):
            return "NULL" if v is None else (str(v) if isinstance(v, int) else "'" + v.replace("'", "\\'") + "'")
        cols = [c.strip().split() for c in schema.split(",")]
        values = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
        rel = self.spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(n for n, _ in cols)})")
        return rel.selectExpr(*[f"CAST({n} AS {t}) AS {n}" for n, t in cols])

    @cached_property
    def online_travel_agents(self) -> DataFrame:
        return self._values(ONLINE_TRAVEL_AGENTS, "id int, name string")

    @cached_property
    def source_enums(self) -> DataFrame:
        return self._values(SOURCE_ENUMS, "enum_key int, enum_val string")

    @cached_property
    def clusters(self) -> DataFrame:
        return self._values(CLUSTERS, "id int, city_id int")

    @cached_property
    def cities(self) -> DataFrame:
        return self._values(CITIES, "id int, time_zone string")

    @cached_property
    def city_tz(self) -> DataFrame:
        return self._values(CITY_TZ, "name string, utc_offset string")
