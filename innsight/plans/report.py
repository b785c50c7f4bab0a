"""The wide property x day report and its narrow cut, plus the CSV sink / re-read.

Shuffle plan (see README "Plan at scale"):

1. Three first-level aggregations read the large facts once each: supply per (property, day) with a sum per
   status, demand per (property, day, channel), realization per (property, day, channel). Each is a hash
   aggregate with map-side partial aggregation on its full key, so a property holding a third of all
   bookings is spread over its days and channels and pre-combined before the shuffle.
2. Second-level results are all hash-partitioned on (property, day): the narrow per-channel rows by one
   repartition each before they are gathered to channel maps. The (property, day) joins between them need no
   further exchange.
3. Per-property columns (attributes, payment type, live date) are joined onto the narrow supply rows
   before those joins, by measured size (broadcast when small). The joins carry the channel maps; the 200 columns
   are made of them once, above the last join, and wide rows are neither joined nor shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions import rules as R
from ..functions.exprs import label_lookup, zero_fill
from ..operators.channels import (CHANNEL_MAP, group_aggs, group_names, known_channels, pivot_cells, pivot_columns,
                                  pivot_lookups, pivot_state, sql_name, with_unlisted)
from ..operators.demand import (demand_bookings, demand_by_channel, demand_channels_seen, demand_stays,
                                demand_totals_aggs, used_value)
from ..operators.dims import attribute_rows, eligible_properties, exclude_keys
from ..operators.policy import classified_policies, payment_types, policy_rows
from ..operators.realization import realization_bookings, realization_by_channel
from ..operators.supply import corrected_srns, effective_live_date, first_booking, live_dates
from ..params import SUPPLY_HOTEL_STATUSES, ReportParams
from ..session import output_path, shared_dir
from .ordered import write_ordered_csv
from .publish import publish, read_published

KEY = "property_code"

DEMAND_ROLLUP = tuple((s, m) for s, m in R.ROLLUP_MEASURES if m not in R.REALIZATION_ROLLUP)
CANCEL_ROLLUP = tuple((s, m) for s, m in R.ROLLUP_MEASURES if m in R.REALIZATION_ROLLUP)


def demand_channels(channels: Sequence[str] = R.DEFAULT_CHANNELS) -> tuple[str, ...]:
    return with_unlisted(channels) + (R.DEMAND_NULL_CHANNEL,)


def cancellation_channels(channels: Sequence[str] = R.DEFAULT_CHANNELS) -> tuple[str, ...]:
    return with_unlisted(channels) + (R.REALIZATION_NULL_CHANNEL,)


# -- building blocks ----------------------------------------------------------------------------------
def supply_per_status(hotel_date_summary: DataFrame, p: ReportParams) -> DataFrame:
    """One pass over the daily supply fact: per (property, day, status) sellable-room sum and contracted max,
    partitioned on (property, day) for the joins that follow."""
    return (hotel_date_summary.filter(F.col("d").between(F.lit(p.window_start), F.lit(p.window_end)))
            .groupBy(KEY, "d", "hotel_status")
            .agg(F.sum("sellable_rooms").alias("srns"), F.max("total_contracted_rooms").alias("contracted"))
            .withColumnRenamed("d", "date")
            .repartition(KEY, "date"))


def supply_with_contracted(hotel_date_summary: DataFrame, p: ReportParams) -> DataFrame:
    """(property, day, status, srns, total_contracted_rooms) of the supply statuses, in one aggregation by (property,
    day): a sum for each supply status, and the contracted maximum over all statuses.

    The statuses are a fixed few, so neither a shuffle by status nor a window over the sums is needed."""
    status = F.col("hotel_status")
    days = (hotel_date_summary.filter(F.col("d").between(F.lit(p.window_start), F.lit(p.window_end)))
            .groupBy(KEY, F.col("d").alias("date"))
            .agg(F.max("total_contracted_rooms").alias("total_contracted_rooms"),
                 *[F.sum(F.when(status == s, F.col("sellable_rooms"))).alias(f"__srns_{s}") for s in SUPPLY_HOTEL_STATUSES],
                 *[F.max(status == s).alias(f"__has_{s}") for s in SUPPLY_HOTEL_STATUSES]))
    rows = F.array(*[F.struct(F.lit(s).alias("hotel_status"), F.col(f"__srns_{s}").alias("srns"),
                              F.col(f"__has_{s}").alias("__has")) for s in SUPPLY_HOTEL_STATUSES])
    return (days.select(KEY, "date", "total_contracted_rooms", F.inline(rows)).filter("__has")
            .select(KEY, "date", "hotel_status", "srns", "total_contracted_rooms"))


def demand_by_channel_for(src, p: ReportParams) -> DataFrame:
    stays = demand_stays(src.bookings, src.bookings_base, src.booking_taxes, src.hotel_dim, src.online_travel_agents,
                         src.source_enums, p, getattr(src, "taxes_on_bookings", False))
    return demand_by_channel(stays, p, src.calendar)


def realization_by_channel_for(src, p: ReportParams) -> DataFrame:
    b = realization_bookings(src.bookings_base, src.hotel_dim, src.online_travel_agents, src.source_enums,
                             src.clusters, src.cities, src.city_tz, p)
    return realization_by_channel(b, p, src.calendar)


def run_months(calendar: DataFrame, p: ReportParams) -> DataFrame:
    """(inserted_at): the months (``yyyymm`` text) that the run's window has days in, a handful of rows."""
    days = calendar.filter(F.col("d").between(F.lit(p.window_start), F.lit(p.window_end)))
    return days.select(F.date_format("d", "yyyyMM").alias("inserted_at")).distinct()


def bookings_of_months(bookings: DataFrame, months: DataFrame) -> DataFrame:
    """(inserted_at, n_bookings, n_rooms) of the bookings of ``months``. On a table partitioned by month Spark prunes the
    folders by the months that it finds when the query runs."""
    return (bookings.join(F.broadcast(months), "inserted_at").groupBy("inserted_at")  # months of a window
            .agg(F.count("*").alias("n_bookings"), F.sum("rooms").alias("n_rooms")))


def _rollup_names(measures) -> frozenset[str]:
    """Roll-up column names. A pivot column of the same name (a channel labelled ``OTA`` gives ``OTA_urn``)
    is replaced by the roll-up, as assigning a column of that name does in the original report."""
    return group_names("OTA", measures) | group_names("Growth", measures)


MONEY = DecimalType(38, 6)


def _shaped(measure: str, value: str) -> str:
    """Output form of a pivot's value: money as ``typed_sql`` gives it, counts as they are."""
    return f"CAST(round({value}, 6) AS {MONEY.simpleString()})" if "gmv" in measure else value


def pivot_after_shuffle(rows: DataFrame, placed: bool = False) -> DataFrame:
    """Hash the narrow per-channel rows on (property, day) before pivoting them, unless they are ``placed`` so already.

    The group-by on the same keys then needs no exchange of its own, and only the narrow rows cross the network,
    neither maps of them nor the pivot's columns. The number of partitions is given, so that AQE doesn't merge them by
    the size of the narrow rows: what a task makes of them is many times wider.
    """
    if placed:
        return rows
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), KEY, "date")


def demand_daily_wide(by_channel: DataFrame, channels: Sequence[str], rollups: bool = True,
                      placed: bool = False) -> DataFrame:
    """Per (property, day): totals, the channel pivot (``<channel>_<measure>``) and, with ``rollups``, the
    OTA / Growth demand roll-ups, in one aggregation over the per-channel rows. Roll-ups go by the booking's own
    label, whatever columns ``channels`` asks for."""
    chans = demand_channels(channels)
    return pivot_columns(demand_daily_state(by_channel, chans, rollups, placed), chans, R.DEMAND_MEASURES,
                         R.DEMAND_NULL_CHANNEL, _rollup_names(DEMAND_ROLLUP) if rollups else frozenset(), _shaped)


def demand_daily_state(by_channel: DataFrame, chans: Sequence[str], rollups: bool, placed: bool) -> DataFrame:
    """:func:`demand_daily_wide` with the map of ``chans`` in place of the pivot's columns."""
    rows = by_channel.withColumns({
        "urn_gmv": used_value("tax_checkout"),
        "gmv_brn": F.coalesce(F.col("gmv_brn"), F.lit(0)),
    })
    groups = []
    if rollups:
        groups = (group_aggs("booking_source", "OTA", R.OTA_GROUP, DEMAND_ROLLUP)
                  + group_aggs("booking_source", "Growth", R.GROWTH_GROUP, DEMAND_ROLLUP))
    return pivot_after_shuffle(rows, placed).groupBy(KEY, "date").agg(
        *demand_totals_aggs(), *pivot_state("booking_source", chans, R.DEMAND_MEASURES, R.DEMAND_NULL_CHANNEL), *groups)


def observed_demand_channels(src, p: ReportParams) -> DataFrame:
    """Distinct channel labels of the demand rows (NULL shown as the demand's null label).

    Read from the demand bookings that have a night in the window, not from the per-channel aggregate: a
    second consumer of that aggregate would be pruned differently and re-run the whole night expansion.
    """
    return demand_channels_seen(demand_bookings(src.bookings, src.hotel_dim, src.online_travel_agents,
                                                src.source_enums, p), p, src.calendar)


def cancellation_daily_wide(real_by_channel: DataFrame, observed_channels: DataFrame, channels: Sequence[str],
                            rollups: bool = True, placed: bool = False) -> DataFrame:
    """Per (property, day): cancellation / no-show pivot and the OTA / Growth roll-ups of them.

    OTA roll-ups count only channels that also occur in the demand rows (the report sums the columns of
    observed demand channels); the observed set is a distinct of channel labels, i.e. bounded by the label
    vocabulary, and is broadcast.
    """
    chans = cancellation_channels(channels)
    return pivot_columns(cancellation_daily_state(real_by_channel, observed_channels, chans, rollups, placed), chans,
                         R.CANCELLATION_MEASURES, R.REALIZATION_NULL_CHANNEL,
                         _rollup_names(CANCEL_ROLLUP) if rollups else frozenset(), _shaped)


def cancellation_daily_state(real_by_channel: DataFrame, observed_channels: DataFrame, chans: Sequence[str],
                             rollups: bool, placed: bool) -> DataFrame:
    """:func:`cancellation_daily_wide` with the map of ``chans`` in place of the pivot's columns."""
    # Distinct channel labels: bounded by the rule labels plus the source-enum table, whatever the data size.
    # Broadcast so the per-channel rows are never hashed on a ~30-value key.
    observed = F.broadcast(observed_channels.select(F.col("booking_source").alias("_obs"),
                                                    F.lit(True).alias("_observed")))
    rows = real_by_channel.join(observed, F.col("booking_source") == F.col("_obs"), "left")
    groups = []
    if rollups:
        groups = (group_aggs("booking_source", "OTA", R.OTA_GROUP, CANCEL_ROLLUP, extra_cond="_observed")
                  + group_aggs("booking_source", "Growth", R.GROWTH_GROUP, CANCEL_ROLLUP))
    return pivot_after_shuffle(rows, placed).groupBy(KEY, "date").agg(
        *pivot_state("booking_source", chans, R.CANCELLATION_MEASURES, R.REALIZATION_NULL_CHANNEL), *groups)


def report_column_kinds(channels: Sequence[str] = R.DEFAULT_CHANNELS) -> list[tuple[str, str]]:
    """Ordered ``(column, kind)`` of the wide report; kind is key / date / count / money / text."""
    cols = [(KEY, "text"), ("date", "date"), ("urn", "count"), ("brn", "count"), ("gmv_brn", "money"),
            ("urn_gmv", "money"), ("srns", "count")]
    for ch in demand_channels(channels):
        for m in R.DEMAND_MEASURES:
            cols.append((f"{ch}_{m}", "money" if "gmv" in m else "count"))
    for ch in cancellation_channels(channels):
        for m in R.CANCELLATION_MEASURES:
            cols.append((f"{ch}_{m}", "count"))
    seen = {c for c, _ in cols}
    for group in ("OTA", "Growth"):
        for suffix, _ in R.ROLLUP_MEASURES:
            if f"{group}_{suffix}" not in seen:  # a same-named channel column holds the roll-up
                cols.append((f"{group}_{suffix}", "money" if "gmv" in suffix else "count"))
    cols += [("total_contracted_rooms", "count"), ("hotel_name", "text"), ("city_name", "text"),
             ("zone_name", "text"), ("payment_type_when_policy_applied", "text"), ("live_date2", "date"),
             ("current_crs_status", "text")]
    return cols


def typed_sql(name: str, kind: str) -> str:
    """Output form of a report column as SQL text (values DECIMAL(38,6), counts BIGINT)."""
    c = sql_name(name)
    if kind == "money":
        return f"CAST(round({c}, 6) AS DECIMAL(38,6)) AS {c}"
    if kind == "count":
        return f"CAST({c} AS BIGINT) AS {c}"
    return c


def select_typed(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Project and type ``(column, kind)`` pairs in one ``selectExpr``; values that are rounded already stay as they are."""
    done = {f.name for f in df.schema.fields if f.dataType == MONEY}
    return df.selectExpr(*[sql_name(c) if c in done else typed_sql(c, k) for c, k in columns])


#: What the properties and policies of a code give a row: see :func:`code_rows`.
CODE_TIMES, CODE_ATTRIBUTES, CODE_PAYMENTS = "__times", "__attributes", "__payments"
ATTRIBUTES, PAYMENT_TYPE = ("hotel_name", "city_name", "zone_name"), "payment_type_when_policy_applied"


def code_rows(props: DataFrame, attributes: DataFrame, payment: DataFrame, live: DataFrame) -> DataFrame:
    """One row per code of ``props``: live date, number of its properties, and what the joins with ``attributes`` and
    ``payment`` would repeat its rows for, as lists of distinct values with their counts.

    The lists are of the property dimension (its rows of one code) and of payment types (a handful); the report has their
    product in rows for each day of the code, so a list is never its largest part."""
    n = F.count("*")
    times = props.groupBy(KEY).agg(n.alias(CODE_TIMES))
    named = (attributes.groupBy(KEY, *ATTRIBUTES).agg(n.alias("n")).groupBy(KEY)
             .agg(F.collect_list(F.struct(*ATTRIBUTES, "n")).alias(CODE_ATTRIBUTES)))
    paid = (payment.groupBy(KEY, PAYMENT_TYPE).agg(n.alias("n")).groupBy(KEY)
            .agg(F.collect_list(F.struct(PAYMENT_TYPE, "n")).alias(CODE_PAYMENTS)))
    return (times.join(named, KEY, "left").join(paid, KEY, "left").join(live.select(KEY, "live_date2"), KEY, "left"))


def with_attributes(rows: DataFrame) -> DataFrame:
    """``rows`` with :func:`code_rows` columns, once for every distinct attribute row of their code (NULLs without any);
    ``CODE_TIMES`` counts the others."""
    none = ", ".join(f"'{c}', CAST(NULL AS STRING)" for c in ATTRIBUTES)
    keep = [sql_name(c) for c in rows.columns if c not in (CODE_TIMES, CODE_ATTRIBUTES)]
    return (rows.selectExpr(*keep, CODE_TIMES, f"explode(coalesce({CODE_ATTRIBUTES}, array(named_struct({none}, 'n', 1L)))) "
                                               "AS __named")
            .selectExpr(*keep, *[f"__named.{c} AS {c}" for c in ATTRIBUTES], f"{CODE_TIMES} * __named.n AS {CODE_TIMES}"))


def repeated(rows: DataFrame, tail: Sequence[str]) -> DataFrame:
    """``rows`` of :func:`with_attributes` once for every payment row of their code (one NULL without any) and as often as
    ``CODE_TIMES`` says: the rows that plain joins would give.

    ``tail`` names the columns that come last, the payment type among them. They come out of the generator in their order,
    so no projection copies the wide rows once more."""
    none = f"array(named_struct('{PAYMENT_TYPE}', CAST(NULL AS STRING), 'n', 1L))"
    last = ", ".join(f"'{c}', {f'p.{c}' if c == PAYMENT_TYPE else sql_name(c)}" for c in tail)
    each = (f"transform(coalesce({CODE_PAYMENTS}, {none}), "
            f"p -> array_repeat(named_struct({last}), CAST(p.n * {CODE_TIMES} AS INT)))")
    return rows.selectExpr(*[sql_name(c) for c in rows.columns if c not in (CODE_TIMES, CODE_PAYMENTS, *tail)],
                           f"inline(flatten({each}))")


# -- the report ---------------------------------------------------------------------------------------
def cut(df: DataFrame, enabled: bool) -> DataFrame:
    """Reliable checkpoint into the cluster's shared ``spark.checkpoint.dir`` (read from the session; a scratch
    folder is set only when none is configured). Later stages then recompute from it, never from the facts."""
    if not enabled:
        return df
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def report_wide(src, p: ReportParams, channels: Sequence[str] | None = R.DEFAULT_CHANNELS,
                cut_lineage: bool = False, aggregates=None) -> DataFrame:
    """One row per eligible property x day x property status with supply, demand, channel split,
    cancellations, roll-ups, contracted rooms, attributes, payment type, live date and status label.

    ``channels`` names the labels that get columns of their own (None: all that the rules and the source lookup
    know); every other label is summed into the unlisted columns.

    With ``cut_lineage`` the three first-level aggregates (the only steps that read the large facts) are
    checkpointed first: they are small, and an executor lost afterwards then costs a re-read of them instead
    of a re-scan of the bookings. With ``aggregates`` (:class:`aggregates.Aggregates`, stored bucketed by property and
    day) those are read in place of the facts, and the merges by (property, day) need no exchange.
    """
    channels = known_channels(src.source_enums) if channels is None else with_unlisted(channels)
    placed = aggregates is not None
    props = eligible_properties(src.hotel_dim, p).select(KEY)
    if placed:
        # Contracted rooms are the maximum over all statuses of a property-day: a window on the stored buckets.
        supply = (aggregates.supply_per_status
                  .withColumn("total_contracted_rooms", F.max("contracted").over(Window.partitionBy(KEY, "date")))
                  .filter(F.col("hotel_status").isin(*SUPPLY_HOTEL_STATUSES)))
    else:
        supply = cut(supply_with_contracted(src.hotel_date_summary, p), cut_lineage)
    supply = exclude_keys(supply, KEY, p.excluded_codes).select(
        KEY, "date", "hotel_status", "srns", "total_contracted_rooms")

    by_channel = aggregates.demand_by_channel if placed else cut(demand_by_channel_for(src, p), cut_lineage)
    d_chans, c_chans = demand_channels(channels), cancellation_channels(channels)
    d_map, c_map = f"{CHANNEL_MAP}_demand", f"{CHANNEL_MAP}_cancelled"
    demand = demand_daily_state(by_channel, d_chans, True, placed).withColumnRenamed(CHANNEL_MAP, d_map)
    # once the per-channel rows are stored, the labels are read from them
    observed = (by_channel.select(F.coalesce("booking_source", F.lit(R.DEMAND_NULL_CHANNEL)).alias("booking_source"))
                .distinct() if cut_lineage or placed else observed_demand_channels(src, p))
    realized = aggregates.realization_by_channel if placed else cut(realization_by_channel_for(src, p), cut_lineage)
    cancels = (cancellation_daily_state(realized, observed, c_chans, True, placed)
               .withColumnRenamed(CHANNEL_MAP, c_map))

    # Per-property columns. Everything below is left-joined onto the supply rows, so restricting these
    # sides to the supply codes first (as the standalone operators do) would only re-derive the supply fact:
    # the eligible-property filter is the cheaper superset that gives the same report.
    attributes = attribute_rows(src.hotel_dim, p)
    payment = payment_types(classified_policies(policy_rows(src.hotel_dim, src.hotel_restrictions,
                                                            src.default_policies, src.hotel_policies, p)))
    live = effective_live_date(live_dates(src.status_changes),
                               first_booking(src.bookings, eligible_properties(src.hotel_dim, p)))

    keys = [KEY, "date"]
    # What a code gives its rows first, onto the narrow supply rows. No join multiplies them.
    base = supply.join(code_rows(props, attributes, payment, live), KEY)
    merged = with_attributes(base.join(demand, keys, "left").join(cancels, keys, "left"))
    # Missing measures count 0 and missing attribute text reads "0"; payment type and live date stay NULL.
    merged = zero_fill(merged, text_fill=None).na.fill("0", subset=list(ATTRIBUTES))
    merged = merged.withColumns({
        "srns": corrected_srns(),
        "current_crs_status": label_lookup("hotel_status", R.HOTEL_STATUS_LABELS),
    })
    # The pivots' columns last: the joins move one map per side, and the wide row is made once.
    keep = [sql_name(c) for c in merged.columns if c not in (d_map, c_map)]
    wide = (merged.selectExpr("*", *pivot_lookups(d_chans, d_map), *pivot_lookups(c_chans, c_map))
            .selectExpr(*keep, *pivot_cells(d_chans, R.DEMAND_MEASURES, R.DEMAND_NULL_CHANNEL,
                                            _rollup_names(DEMAND_ROLLUP), _shaped, d_map),
                        *pivot_cells(c_chans, R.CANCELLATION_MEASURES, R.REALIZATION_NULL_CHANNEL,
                                     _rollup_names(CANCEL_ROLLUP), _shaped, c_map)))
    columns = report_column_kinds(channels)
    names = [c for c, _ in columns]
    # A row is repeated last. The columns from the attributes on, text and the live date, come from the generator.
    typed = select_typed(wide, [c for c in columns if c[0] != PAYMENT_TYPE] + [(CODE_TIMES, "count"), (CODE_PAYMENTS, "text")])
    return repeated(typed, names[names.index(ATTRIBUTES[0]):])


def narrow_columns(channel: str = "Walk In") -> list[str]:
    """Columns of the narrow report: totals, one channel's demand and cancellation measures, the tail."""
    return [KEY, "date", "urn", "brn", "gmv_brn", "urn_gmv", "srns",
            *[f"{channel}_{m}" for m in R.DEMAND_MEASURES],
            *[f"{channel}_{m}" for m in R.CANCELLATION_MEASURES],
            "total_contracted_rooms", "hotel_name", "city_name", "zone_name", "payment_type_when_policy_applied",
            "live_date2", "current_crs_status"]


def report_narrow(wide: DataFrame, channel: str = "Walk In") -> DataFrame:
    """The narrow cut of the wide report, selected by name."""
    return wide.select(*narrow_columns(channel))


# -- sink and re-read ---------------------------------------------------------------------------------
def write_report_csv(df: DataFrame, path: str, ordered: bool = False) -> None:
    """CSV with header, ``NA`` for NULL, replacing earlier content.

    Files are sorted by (property, day) one by one. ``ordered`` sorts across files, as the original report file
    is, at the price of a range shuffle of the output rows (:mod:`ordered`).
    """
    if ordered:
        return write_ordered_csv(df, path, (KEY, "date"))
    out = df.sortWithinPartitions(KEY, "date")
    out.write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(path)


def read_report_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Re-read a written report with an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "NA").csv(path)


def publishable(df: DataFrame) -> DataFrame:
    """What the publishing step pastes: every missing value replaced by 0 (text columns by ``'0'``)."""
    return zero_fill(df, text_fill="0")


def publish_report(spark: SparkSession, written_path: str, schema, publish_path: str) -> DataFrame:
    """The publishing step: re-read a written report, zero-fill it and make it the current version of
    ``publish_path`` in one step (:mod:`publish`); :func:`read_published_report` reads it."""
    published = publishable(read_report_csv(spark, written_path, schema))
    publish(published, publish_path, write_report_csv)
    return read_published_report(spark, publish_path, published.schema)


def read_published_report(spark: SparkSession, publish_path: str, schema) -> DataFrame:
    """The current version of a published report."""
    return read_published(spark, publish_path, lambda s, folder: read_report_csv(s, folder, schema))


def report_csv_roundtrip(spark: SparkSession, narrow: DataFrame, path: str | None = None) -> DataFrame:
    """Write the narrow report, read it back with dates as text, and zero-fill it for publishing. The write is an
    action: it runs when this is called."""
    path = path or output_path(spark, "report-narrow-csv")
    write_report_csv(narrow, path)
    schema = narrow.withColumn("live_date2", F.col("live_date2").cast("string")).schema  # as text
    return publishable(read_report_csv(spark, path, schema))
