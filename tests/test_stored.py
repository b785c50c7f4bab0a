"""The operators give the same rows on stored lodging tables as on derived ones; bookings prune by month."""

import re
import tempfile

import pytest

from innsight.oracle.compare import row_lines
from innsight.plans.queries import OPERATORS
from innsight.sources.fixtures import LodgingSources
from innsight.sources.stored import store_sources

from conftest import SF_SMOKE


@pytest.fixture(scope="module")
def both(spark):
    derived = LodgingSources(spark, SF_SMOKE)
    stored = store_sources(LodgingSources(spark, SF_SMOKE), tempfile.mkdtemp(prefix="innsight-stored-"))
    return derived, stored


def lines(df):
    return row_lines(df.columns, [tuple(r) for r in df.collect()])


@pytest.mark.parametrize("name", ["report_wide", "room_nights_by_channel", "policy_resolution", "first_booking"])
def test_stored_tables_give_the_same_rows(both, name):
    derived, stored = both
    assert lines(OPERATORS[name](stored)) == lines(OPERATORS[name](derived))


def test_month_floor_prunes_booking_partitions(both):
    _, stored = both
    df = OPERATORS["scan_recent_months"](stored)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*inserted_at", plan), plan


def test_report_job_writes_wide_and_narrow_csv(spark, both):
    from innsight.job import run_report
    from innsight.params import DEFAULT_PARAMS

    derived, _ = both
    out = tempfile.mkdtemp(prefix="innsight-job-")
    wide_path, narrow_path, published_path = run_report(derived, DEFAULT_PARAMS, out, publish=out + "/published")
    wide = spark.read.option("header", True).csv(wide_path)
    narrow = spark.read.option("header", True).csv(narrow_path)
    from innsight.plans.publish import current_version

    published = spark.read.option("header", True).csv(current_version(spark, published_path))
    assert wide.count() == narrow.count() == published.count() == OPERATORS["report_wide"](derived).count() > 0
    assert len(narrow.columns) == 20 and len(wide.columns) > 200
    # Publishing replaces every missing value (written as NA) by 0 and changes nothing else.
    filled = sorted(tuple("0" if v == "NA" else v for v in r) for r in narrow.collect())
    assert sorted(tuple(r) for r in published.select(*narrow.columns).collect()) == filled


def test_source_contract_is_checked(spark, both):
    from innsight.sources import check_sources, missing_columns

    derived, _ = both
    assert missing_columns(derived) == {}

    class Broken:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            df = getattr(self.inner, name)
            return df.drop("rooms") if name in ("bookings", "bookings_base") else df

    with pytest.raises(ValueError, match="bookings: rooms"):
        check_sources(Broken(derived))


def test_bucketed_tables_make_the_tax_path_shuffle_free(spark, both):
    from innsight.sources.stored import store_tables

    derived, _ = both
    tables = store_tables(LodgingSources(spark, SF_SMOKE), "innsight_bucketed", buckets=8)
    for name in ("room_nights_daily", "exclusive_tax_by_booking"):
        df = OPERATORS[name](tables)
        assert lines(df) == lines(OPERATORS[name](derived))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"hashpartitioning\(id#\d+", plan), plan


def test_stored_tables_read_without_recorded_schemas(spark, both):
    """As the job's --stored option reads them: parquet schemas inferred, inserted_at discovered as a partition."""
    from innsight.sources.stored import StoredSources

    derived, stored = both
    inferred = StoredSources(spark, stored.path)
    for name in ("report_wide", "room_nights_daily", "first_booking"):
        assert lines(OPERATORS[name](inferred)) == lines(OPERATORS[name](derived))


def test_stored_aggregates_merge_without_an_exchange(spark, both):
    """A report made again from the bucketed first-level aggregates: equal rows, no hashing by (property, day)."""
    from innsight.params import DEFAULT_PARAMS as P
    from innsight.plans.aggregates import store_aggregates, stored_aggregates
    from innsight.plans.report import report_wide

    derived, stored = both
    store_aggregates(LodgingSources(spark, SF_SMOKE), P, "innsight_aggregates", buckets=4)
    again = report_wide(stored, P, aggregates=stored_aggregates(spark, "innsight_aggregates"))
    assert lines(again) == lines(report_wide(derived, P))
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(property_code#\d+, date#\d+", plan), plan
    assert plan.count("SelectedBucketsCount: 4 out of 4") >= 3


def test_runtime_filter_drops_tax_documents_before_they_are_shuffled(spark, both):
    """With the cluster's settings (thresholds lowered to this table) a Bloom filter of the window's booking ids stands
    on the scan of the tax documents; results stay the same, and fewer documents are shuffled."""
    from pyspark.sql import functions as F

    from innsight.operators.bookings import recent_months
    from innsight.operators.taxes import exclusive_tax_by_booking
    from innsight.params import ReportParams
    from innsight.session import runtime_filter_conf
    import datetime as dt

    _, stored = both
    p = ReportParams(as_of=dt.date(1998, 5, 3))  # a window that leaves most bookings out

    def tax():
        base = recent_months(stored.bookings_base, p).filter(F.col("checkin") < F.lit(dt.date(1998, 3, 25)))
        return exclusive_tax_by_booking(base, stored.booking_taxes, stored.hotel_dim, p)

    def shuffled(df) -> int:
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()
        found, todo = [], [plan]
        while todo:
            node = todo.pop()
            todo += [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName().endswith("QueryStage"):
                todo.append(node.plan())
            if node.nodeName() == "Exchange" and "taxes#" in node.output().toString():
                found.append(node.metrics().apply("shuffleRecordsWritten").value())
        return max(found)

    settings = {**runtime_filter_conf(scan_bytes=0, items=100_000), "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
        plain = tax()
        rows, without = lines(plain), shuffled(plain)
        for k, v in settings.items():
            spark.conf.set(k, v)
        filtered = tax()
        assert "might_contain" in filtered._jdf.queryExecution().optimizedPlan().toString()
        assert lines(filtered) == rows != []
        assert shuffled(filtered) < 0.5 * without
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
