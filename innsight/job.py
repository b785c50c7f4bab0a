"""Report job: build the wide and narrow report for a run date and write both as CSV.

    python -m innsight.job --as-of 2026-11-30 --out <shared folder> [--stored <folder> | --catalog <db>]
                           [--channel "Walk In"] [--cut-lineage] [--set countries=NATION_1,NATION_6 ...]

Without ``--stored`` / ``--catalog`` the lodging tables are derived from the driver tables in ``--sf-dir``.
The session is the submitter's (cluster settings, ``spark.checkpoint.dir``); only ``--as-of`` and the lists in
:class:`innsight.params.ReportParams` decide what is computed.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators.channels import known_channels
from .params import ReportParams
from .plans.report import publish_report, report_narrow, report_wide, write_report_csv
from .session import cluster_conf, output_path
from .sources import check_sources
from .sources.fixtures import LodgingSources
from .sources.stored import CatalogSources, StoredSources


def run_report(sources, params: ReportParams, out: str, channel: str = "Walk In",
               cut_lineage: bool = False, publish: str | None = None,
               channels: tuple[str, ...] | None = None, ordered: bool = False) -> tuple[str, ...]:
    """Write ``<out>/wide`` and ``<out>/narrow`` (CSV, header, ``NA`` for NULL, replacing earlier content);
    with ``publish``, also make the zero-filled narrow report that location's current version."""
    check_sources(sources)
    channels = (*(channels or known_channels(sources.source_enums)), channel)
    # the report is evaluated once, into the shared folder; both files are written from there
    staged = output_path(sources.spark, "report-wide")
    evaluated = report_wide(sources, params, channels, cut_lineage)
    evaluated.write.parquet(staged)
    wide = sources.spark.read.schema(evaluated.schema).parquet(staged)
    narrow = report_narrow(wide, channel)
    wide_path, narrow_path = f"{out.rstrip('/')}/wide", f"{out.rstrip('/')}/narrow"
    write_report_csv(wide, wide_path, ordered)
    write_report_csv(narrow, narrow_path, ordered)
    if publish is None:
        return wide_path, narrow_path
    schema = narrow.withColumn("live_date2", F.col("live_date2").cast("string")).schema
    publish_report(sources.spark, narrow_path, schema, publish)
    return wide_path, narrow_path, publish


def parse_overrides(pairs: list[str], base: ReportParams) -> ReportParams:
    """``NAME=VALUE`` overrides of report parameters, typed by the field's default: comma-separated lists for
    tuples, ISO dates, integers and text (e.g. ``countries=NATION_1,NATION_6``, ``check_days=24``)."""
    changes = {}
    for pair in pairs:
        name, _, raw = pair.partition("=")
        if name not in {f.name for f in dataclasses.fields(base)}:
            raise SystemExit(f"unknown parameter {name!r}")
        current = getattr(base, name)
        if isinstance(current, tuple):
            kind = type(current[0]) if current else str
            changes[name] = tuple(kind(v) for v in raw.split(",") if v != "")
        elif isinstance(current, dt.date):
            changes[name] = dt.date.fromisoformat(raw)
        elif isinstance(current, int):
            changes[name] = int(raw)
        else:
            changes[name] = raw
    return dataclasses.replace(base, **changes)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=ReportParams().as_of)
    ap.add_argument("--out", required=True)
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--stored")
    ap.add_argument("--catalog")
    ap.add_argument("--channel", default="Walk In")
    ap.add_argument("--cut-lineage", action="store_true")
    ap.add_argument("--channels", help="comma-separated labels that get columns (default: all that are known)")
    ap.add_argument("--ordered", action="store_true", help="sort the files globally")
    ap.add_argument("--table", action="append", default=[], metavar="NAME=TABLE",
                    help="with --catalog: the table that holds a lodging table, e.g. bookings_base=raw_bookings")
    ap.add_argument("--taxes-on-bookings", action="store_true",
                    help="tax documents are a column of the raw bookings, not a table")
    ap.add_argument("--shuffle-bytes", type=int, help="size of the largest shuffle, to set partitions by")
    ap.add_argument("--publish", help="also publish the zero-filled narrow report there, as the location's current version")
    ap.add_argument("--set", action="append", default=[], metavar="NAME=VALUE",
                    help="override a report parameter (see innsight.params.ReportParams)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("innsight-report").getOrCreate()
    for name, value in (cluster_conf(args.shuffle_bytes) if args.shuffle_bytes else {}).items():
        spark.conf.set(name, value)
    if args.catalog:
        sources = CatalogSources(spark, args.catalog, dict(t.split("=", 1) for t in args.table),
                                 args.taxes_on_bookings)
    elif args.stored:
        sources = StoredSources(spark, args.stored, taxes_on_bookings=args.taxes_on_bookings)
    else:
        sources = LodgingSources(spark, args.sf_dir)
    params = parse_overrides(args.set, dataclasses.replace(ReportParams(), as_of=args.as_of))
    channels = tuple(args.channels.split(",")) if args.channels else None
    for path in run_report(sources, params, args.out, args.channel, args.cut_lineage, args.publish, channels,
                           args.ordered):
        print(path)


if __name__ == "__main__":
    main()
