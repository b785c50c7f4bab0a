"""Property dimension filters and key-list semi / anti joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import not_in, not_in_null_safe
from ..params import ReportParams


def eligible_properties(hotel_dim: DataFrame, p: ReportParams, name_terms: Sequence[str] | None = None) -> DataFrame:
    """Commercial properties of the report countries.

    Product not in the excluded list, lower-cased name containing none of ``name_terms``, code not starting
    with the excluded prefix (an empty prefix excludes nothing), country in the list. A NULL in any tested column drops the row (SQL logic).
    """
    terms = p.all_name_terms if name_terms is None else tuple(name_terms)
    name = F.lower(F.col("hotel_name"))
    cond = not_in("product", p.excluded_products)
    for term in terms:
        cond = cond & ~name.like(f"%{term}%")
    if p.excluded_code_prefix:
        cond = cond & ~F.col("property_code").startswith(p.excluded_code_prefix)
    return hotel_dim.filter(cond & F.col("property_code").isNotNull() & F.col("country_name").isin(*p.countries))


def exclude_keys(df: DataFrame, column: str, keys: Sequence | DataFrame) -> DataFrame:
    """Rows whose ``column`` is not among ``keys``; a NULL key is kept (R ``%notin%``).

    A literal list becomes a null-safe ``NOT IN`` filter; a key DataFrame becomes a ``left_anti`` join,
    which also keeps NULL keys and needs no driver-side list for a large key set.
    """
    if isinstance(keys, DataFrame):
        return df.join(keys.select(F.col(keys.columns[0]).alias(column)).distinct(), column, "left_anti")
    return df.filter(not_in_null_safe(column, list(keys)))


def restrict_to_keys(df: DataFrame, keys: DataFrame, column: str = "property_code") -> DataFrame:
    """Rows whose ``column`` occurs in ``keys`` (``IN (VALUES ...)`` / R ``%in%`` as a semi join)."""
    return df.join(keys.select(column), column, "left_semi")


def attribute_rows(hotel_dim: DataFrame, p: ReportParams) -> DataFrame:
    """Name, city and zone of commercial properties; this filter leaves out the extra name terms."""
    attrs = eligible_properties(hotel_dim, p, name_terms=p.excluded_name_terms)
    return attrs.select("property_code", "hotel_name", "city_name", "zone_name")


def property_attributes(hotel_dim: DataFrame, supply_codes: DataFrame, p: ReportParams) -> DataFrame:
    """:func:`attribute_rows` of the properties that have supply rows."""
    return restrict_to_keys(attribute_rows(hotel_dim, p), supply_codes)
