"""Sums per key and night from difference arrays: what a stay adds on its first night it takes off after its last.

A stay costs two rows whatever its length. The changes of a key's day are summed (map-side first), a running sum over
the key's days gives the value that holds from each change to the next one, and only then are the days between two
changes filled in. Stays themselves are never expanded to nights.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bookings import calendar_days

_FROM, _UNTIL, _EDGE, _STAYS, _NEXT = "__from", "__until", "__edge", "__stays", "__next"


def changes(stays: DataFrame, keys: Sequence[str], measures: Sequence[str], nullable: Sequence[str], start: dt.date,
            end: dt.date, date_col: str = "date") -> DataFrame:
    """(keys, day, measures, counters): by how much each sum changes on each day of the window, one row per key and
    day with a change. Stays that overlap the window begin in it at the earliest; ends after it need no row."""
    lo, hi = F.lit(start), F.lit(end)
    overlapping = stays.filter((F.col("checkin") < F.col("checkout")) & (F.col("checkin") <= hi)
                               & (F.col("checkout") > lo))
    edges = (overlapping.select(*keys, *measures, F.greatest(F.col("checkin"), lo).alias(_FROM),
                                F.col("checkout").alias(_UNTIL))
             .unpivot([*keys, *measures], [_FROM, _UNTIL], _EDGE, date_col).filter(F.col(date_col) <= hi))
    begins = F.col(_EDGE) == _FROM

    def signed(value: Column) -> Column:
        return F.sum(F.when(begins, value).otherwise(-value))

    return edges.groupBy(*keys, date_col).agg(
        signed(F.lit(1)).alias(_STAYS),
        *[signed(F.coalesce(F.col(m), F.lit(0))).alias(m) for m in measures],
        *[signed(F.col(m).isNotNull().cast("int")).alias(_counter(m)) for m in nullable])


def _counter(measure: str) -> str:
    return f"__n_{measure}"


def sums_by_night(stays: DataFrame, keys: Sequence[str], measures: Mapping[str, Column], start: dt.date, end: dt.date,
                  calendar: DataFrame | None = None, nullable: Sequence[str] = (), date_col: str = "date") -> DataFrame:
    """Per (keys, night ``checkin <= d < checkout`` in the window): the sum of each measure over the stays of that
    night, one row where there is at least one stay. With ``calendar`` only its dates are kept.

    A measure that is NULL counts 0; those in ``nullable`` are NULL where no stay of the night has a value. Measures
    are whole numbers or decimals, so that adding and taking off again leaves exactly the sum of those that remain."""
    names = list(measures)
    rows = stays.select(*keys, *[c.alias(n) for n, c in measures.items()], "checkin", "checkout")
    day = Window.partitionBy(*keys).orderBy(date_col)
    upto = day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counters = [_counter(m) for m in nullable]
    running = changes(rows, keys, names, nullable, start, end, date_col).select(
        *keys, date_col, F.lead(date_col).over(day).alias(_NEXT),
        *[F.sum(c).over(upto).alias(c) for c in (_STAYS, *names, *counters)])
    until = F.coalesce(F.date_sub(F.col(_NEXT), 1), F.lit(end))
    held = running.filter(F.col(_STAYS) > 0).withColumn(date_col, F.explode(F.sequence(F.col(date_col), until)))
    if calendar is not None:
        held = held.join(F.broadcast(calendar_days(calendar, start, end, date_col)), date_col, "left_semi")
    return held.select(*keys, date_col, *[
        F.when(F.col(_counter(m)) > 0, F.col(m)).alias(m) if m in nullable else F.col(m) for m in names])
