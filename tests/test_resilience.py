"""Lineage cut through the shared checkpoint folder, and partition sizing."""

from innsight.oracle.compare import row_lines
from innsight.params import DEFAULT_PARAMS as P
from innsight.plans.report import report_wide
from innsight.session import cluster_conf, shared_dir
from innsight.sources.fixtures import LodgingSources

from conftest import SF_SMOKE


def lines(df):
    return row_lines(df.columns, [tuple(r) for r in df.collect()])


def test_cut_lineage_gives_the_same_report(spark):
    src = LodgingSources(spark, SF_SMOKE)
    cut = report_wide(src, P, cut_lineage=True)
    assert shared_dir(spark)
    assert "LogicalRDD" in cut._jdf.queryExecution().optimizedPlan().toString()
    assert lines(cut) == lines(report_wide(LodgingSources(spark, SF_SMOKE), P))


def test_shared_dir_keeps_a_configured_folder(spark):
    first = shared_dir(spark)
    assert shared_dir(spark) == first


def test_cluster_conf_sizes_partitions():
    tb = 1 << 40
    conf = cluster_conf(20 * tb)
    assert conf["spark.sql.shuffle.partitions"] == str(80 * 1024)
    assert int(cluster_conf(1 << 20)["spark.sql.shuffle.partitions"]) == 200
    assert int(cluster_conf(1000 * tb)["spark.sql.shuffle.partitions"]) == 100_000
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)
