"""Driver contract: entry() on sf0.001 and the shape of queries() / oracle_sql()."""

from __spark_entry__ import entry, oracle_sql, queries
from innsight.plans.report import report_column_kinds


def test_entry_runs_with_stable_schema(spark):
    df = entry(spark)
    assert df.columns == [c for c, _ in report_column_kinds()]
    rows = df.select("urn", "urn_gmv").collect()
    assert rows and sum(r.urn for r in rows) > 0 and sum(r.urn_gmv for r in rows) > 0
    assert entry(spark).schema == df.schema


def test_queries_are_callables_with_oracles():
    qs = queries()
    assert len(qs) >= 40
    assert all(callable(f) for f in qs.values())
    assert set(oracle_sql()) <= set(qs)


def test_job_parameter_overrides():
    import datetime as dt

    import pytest

    from innsight.job import parse_overrides
    from innsight.params import ReportParams

    p = parse_overrides(["countries=NATION_2,NATION_3", "check_days=30", "check_start=1998-05-02",
                         "excluded_code_prefix=P0002", "policy_country_ids=2,3"], ReportParams())
    assert p.countries == ("NATION_2", "NATION_3") and p.policy_country_ids == (2, 3)
    assert p.check_days == 30 and p.check_start == dt.date(1998, 5, 2) and p.excluded_code_prefix == "P0002"
    with pytest.raises(SystemExit):
        parse_overrides(["nope=1"], ReportParams())
