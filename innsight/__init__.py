"""innsight: a PySpark-native lodging revenue mart.

Typical use::

    from innsight import CatalogSources, ReportParams, report_wide, report_narrow
    wide = report_wide(CatalogSources(spark, "lodging"), ReportParams(as_of=datetime.date(2026, 11, 30)))

Every operator is a function of DataFrames; ``innsight.plans.queries.OPERATORS`` names one per operator.
"""

from .params import ReportParams
from .plans.report import report_narrow, report_wide
from .sources import check_sources
from .sources.fixtures import LodgingSources
from .sources.stored import CatalogSources, StoredSources, store_sources, store_tables

__all__ = ["CatalogSources", "LodgingSources", "ReportParams", "StoredSources", "check_sources", "report_narrow",
           "report_wide", "store_sources", "store_tables"]
