"""Reshaping: long (melted) measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.exprs import money


def measures_long(df: DataFrame, keys: Sequence[str], measures: Sequence[str], variable: str = "variable",
                  value: str = "value") -> DataFrame:
    """Melt ``measures`` into ``(variable, value)`` rows; values share one type (``DECIMAL(38,6)``)."""
    typed = df.select(*keys, *[money(m).alias(m) for m in measures])
    return typed.unpivot(list(keys), list(measures), variable, value)
