"""Physical-plan checks: no nested-loop joins, generator instead of range join, pruned and pushed scans,
"""

import contextlib
import io
import re

import pytest

from innsight.plans.queries import QUERIES

from conftest import SF_CHECK, SF_SMOKE


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["report_wide", "room_nights_daily", "realization_by_channel", "stay_nights"])
def test_no_nested_loop_or_cartesian_join(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_CHECK))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_stay_nights_expand_with_a_generator(spark):
    plan = plan_text(QUERIES["stay_nights"](spark, SF_CHECK))
    assert "Generate explode(sequence(" in plan


def test_first_level_aggregates_combine_map_side(spark):
    plan = plan_text(QUERIES["room_nights_by_channel"](spark, SF_CHECK))
    assert re.search(r"HashAggregate\(keys=\[property_code.*partial_sum", plan)


@pytest.mark.parametrize("name", ["room_nights_daily", "room_nights_by_channel", "realization_by_channel"])
def test_stays_are_not_expanded_to_nights(spark, name):
    """A stay is two rows (Expand) into the aggregate of changes; the only sequence is of the days between the changes
    of a key, above the running sums."""
    lines = plan_text(QUERIES[name](spark, SF_CHECK)).splitlines()
    # the calendar table of the test data is made from the nations' keys
    sequences = [i for i, line in enumerate(lines) if "Generate explode(sequence(" in line and "n_nationkey" not in line]
    assert len(sequences) == 1
    fill = sequences[0]
    window = next(i for i, line in enumerate(lines) if "Window [" in line)
    expand = next(i for i, line in enumerate(lines) if "Expand [" in line)
    assert fill < window < expand  # children come below


@pytest.mark.parametrize("name", ["channel_pivot", "cancellation_pivot", "channel_group_rollup", "report_wide"])
def test_pivots_keep_few_aggregates(spark, name):
    df = QUERIES[name](spark, SF_CHECK)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in plan.splitlines() if re.search(r"(?:^|[-+: ])Aggregate \[", line)]
    # the roll-up query reads no channel's column, so no map is kept for it
    assert ("map_from_entries(collect_list(" in plan) == (name != "channel_group_rollup") and aggregates
    for line in aggregates:
        assert len(re.findall(r"\b(?:sum|max|min|count|collect_list)\(", line)) <= 20, line


def test_scans_are_pruned_and_filtered(spark):
    df = QUERIES["room_nights_daily"](spark, SF_CHECK)
    plan = plan_text(df)
    orders_schemas = re.findall(r"ReadSchema: struct<(o_[^>]*)>", plan) or re.findall(r"ReadSchema: (struct<o_[^>]*>)",
                                                                                         plan)
    assert orders_schemas, plan
    assert all("o_orderpriority" not in s and "o_orderstatus" not in s for s in orders_schemas)


def test_live_date_of_the_report_is_a_hash_aggregate(spark):
    from innsight.operators.supply import live_dates
    from innsight.sources.fixtures import LodgingSources

    plan = plan_text(live_dates(LodgingSources(spark, SF_CHECK).status_changes))
    assert "Window" not in plan and "SortAggregate" not in plan and re.search(r"HashAggregate.*partial_max", plan)


@pytest.mark.parametrize("name", ["latest_live_date", "active_policies"])
def test_latest_rows_take_one_scan_and_one_row_per_key_and_task(spark, name):
    """The history is read once and not joined; a limit of one row per key stands below the exchange too."""
    plan = plan_text(QUERIES[name](spark, SF_CHECK))
    assert plan.count("FileScan") == 1 and "Join" not in plan
    limits = [m.start() for m in re.finditer(r"WindowGroupLimit .*row_number\(\), 1, (?:Partial|Final)", plan)]
    exchange = plan.index("Exchange hashpartitioning")
    assert len(limits) == 2 and limits[0] < exchange < limits[1]


@pytest.mark.parametrize("name", ["payment_policy_class", "restriction_class"])
def test_classes_come_from_one_parse_per_distinct_text(spark, name):
    """One parse, over distinct texts; the rows get their class by a join."""
    plan = QUERIES[name](spark, SF_CHECK)._jdf.queryExecution().optimizedPlan().toString()
    parses = [line for line in plan.splitlines() if re.search(r"parse_?json", line, re.I)]
    assert len(parses) == 1 and len(re.findall(r"parse_?json", parses[0], re.I)) == 1
    assert re.search(r"Aggregate \[.*__text#\d+\]", parses[0]) and "get_json_object" not in plan and "Join" in plan


def test_months_of_the_run_prune_the_folders_that_are_read(spark):
    plan = plan_text(QUERIES["bookings_of_run_months"](spark, SF_CHECK))
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan), plan


def test_the_calendar_reads_no_fact(spark):
    plan = plan_text(QUERIES["calendar_spine"](spark, SF_CHECK))
    assert "orders" not in plan and "lineitem" not in plan


def test_first_booking_is_reduced_below_the_join(spark):
    plan = plan_text(QUERIES["first_booking"](spark, SF_CHECK))
    assert re.search(r"HashAggregate\(keys=\[(o_custkey|hotel_id)#\d+L?\], functions=\[partial_min", plan)


def formatted_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def exchange_widths(plan: str) -> list[int]:
    """Number of input columns of every Exchange in a formatted plan."""
    widths = []
    for block in re.split(r"\n(?=\(\d+\) )", plan):
        if re.match(r"\(\d+\) (Exchange|ShuffleExchange)", block):
            m = re.search(r"Input \[(\d+)\]", block)
            if m:
                widths.append(int(m.group(1)))
    return widths


def test_report_never_shuffles_the_wide_rows(spark):
    """Only narrow rows cross the network: the pivot columns are produced after the last exchange."""
    df = QUERIES["report_wide"](spark, SF_CHECK)
    widths = exchange_widths(formatted_plan(df))
    assert widths, "no exchange found"
    assert max(widths) < 40 < len(df.columns)


def test_report_makes_the_wide_columns_once_above_the_joins(spark):
    """The joins carry the channel maps; labels are looked up in them above the last join."""
    lines = QUERIES["report_wide"](spark, SF_CHECK)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    last_join = next(i for i, line in enumerate(lines) if re.search(r"(?:^|[-+: ])Join ", line))  # children come below
    more = [(i, int(n)) for i, line in enumerate(lines) for n in re.findall(r"\.\.\. (\d+) more fields", line)]
    assert max(n for i, n in more if i < last_join) > 150 and all(n < 40 for i, n in more if i >= last_join)


def test_codes_rows_repeat_rows_as_plain_joins_do(spark):
    """Codes with several properties, names and payment types, equal ones too, and codes without some of them."""
    from innsight.plans.report import code_rows, repeated, with_attributes

    def of(rows, schema):
        return spark.createDataFrame(rows, f"property_code string, {schema}")

    props = spark.createDataFrame([(c,) for c in ("A", "A", "B", "C", "C", "C", "D")], "property_code string")
    attributes = of([("A", "x", "c", "z"), ("A", "x", "c", "z"), ("A", "y", None, "z"), ("B", "x", "c", "z"), (None, "q", "c", "z")],
                    "hotel_name string, city_name string, zone_name string")
    payment = of([("A", "Prepaid"), ("A", "Postpaid"), ("A", "Prepaid"), ("C", None), ("C", "Rest"), (None, "Rest")],
                 "payment_type_when_policy_applied string")
    live = of([("A", "2"), ("C", None), (None, "3")], "live_date2 string")
    days = of([("A", 1), ("A", 2), ("A", 2), ("B", 3), ("C", 4), ("D", 5), ("E", 6), (None, 7)], "v int")
    plain = (days.join(props, "property_code").join(attributes, "property_code", "left")
             .join(payment, "property_code", "left").join(live, "property_code", "left"))
    got = repeated(with_attributes(days.join(code_rows(props, attributes, payment, live), "property_code")), plain.columns[2:])
    assert got.columns == plain.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_rows_of_shared_codes_are_multiplied_after_the_last_shuffle(spark):
    """Five properties to a code give a code's days 25 rows and more: none of them is shuffled or joined on."""
    from pyspark.sql import functions as F

    from innsight.params import DEFAULT_PARAMS
    from innsight.plans.report import report_wide
    from innsight.sources.fixtures import LodgingSources

    class Shared(LodgingSources):
        @property
        def hotel_dim(self):
            return LodgingSources.hotel_dim.func(self).withColumn("__n", F.explode(F.sequence(F.lit(1), F.lit(5)))).select(
                "*", F.concat("hotel_name", F.col("__n").cast("string")).alias("__name"),
                (F.col("hotel_id") + (F.col("__n") - 1) * 1_000_000).alias("__id")).drop("hotel_name", "hotel_id", "__n") \
                .withColumnsRenamed({"__name": "hotel_name", "__id": "hotel_id"})

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as tables too large for it
        df = report_wide(Shared(spark, SF_SMOKE), DEFAULT_PARAMS)
        rows = len(df.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows >= 25 * QUERIES["report_wide"](spark, SF_SMOKE).count() > 0
    shuffled, todo = [], [df._jdf.queryExecution().executedPlan().finalPhysicalPlan()]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        if node.nodeName() == "Exchange":
            shuffled.append(node.metrics().apply("shuffleRecordsWritten").value())
    assert shuffled and max(shuffled) < rows / 2


def test_report_pivots_in_the_sessions_partitions(spark):
    """AQE sees narrow rows, so it must not merge the partitions that the wide rows are made in."""
    plan = plan_text(QUERIES["report_wide"](spark, SF_CHECK))
    assert len(re.findall(r"hashpartitioning\(property_code#\d+, date#\d+, 8\), REPARTITION_BY_NUM", plan)) == 2


def test_supply_is_one_aggregation_by_property_and_day(spark):
    """Sums by status, the maximum over all statuses (0 and NULL too), NULL rooms and codes, a day out of the window."""
    import datetime as dt

    from innsight.params import DEFAULT_PARAMS
    from innsight.plans.report import supply_with_contracted

    day = dt.date(1998, 5, 1)
    rows = [("A", day, 1, 3, 8), ("A", day, 1, 4, 9), ("A", day, 2, None, 5), ("A", day, 0, 7, 99), ("A", day, None, 7, 98),
            ("B", day, 5, 1, 2), (None, day, 3, 2, None), ("A", dt.date(1997, 5, 1), 1, 1, 1)]
    df = supply_with_contracted(spark.createDataFrame(
        rows, "property_code string, d date, hotel_status int, sellable_rooms int, total_contracted_rooms int"), DEFAULT_PARAMS)
    plan = plan_text(df)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [("A", day, 1, 7, 99), ("A", day, 2, None, 99), (None, day, 3, 2, None)], key=str)
    assert plan.count("Exchange") == 1 and "Window" not in plan


def test_report_partitions_second_level_on_property_and_day(spark):
    plan = plan_text(QUERIES["report_wide"](spark, SF_CHECK))
    keyed = re.findall(r"Exchange hashpartitioning\(property_code#\d+, date#\d+, \d+\)", plan)
    assert 2 <= len(keyed) <= 6


@pytest.mark.parametrize("name", ["report_wide", "room_nights_by_channel", "realization_by_channel"])
def test_facts_are_never_hashed_on_low_cardinality_keys(spark, name):
    """Lookups by source, agent, cluster or zone must be broadcast, never shuffle the bookings on a ~10-value
    key (a source or city may hold a third of all bookings)."""
    plan = plan_text(QUERIES[name](spark, SF_CHECK))
    for key in ("source", "_enum_key", "ota_id", "ota_key", "cluster_id", "city_id", "time_zone"):
        assert not re.search(rf"hashpartitioning\({key}#\d+", plan), key
