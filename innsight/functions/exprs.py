"""Column expressions shared by the operators. All are Spark built-ins (no Python UDF)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamp used when a cancellation time is missing or holds the text 'null' (fixed value).
MISSING_CANCEL_TIME = "2000-01-01 01:01:01"
# Local hour from which a same-day cancellation counts as late (fixed value).
LATE_CANCEL_HOUR = 18
# Type in which values and taxes are divided and summed.
VALUE_TYPE = "decimal(28,10)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_in(c: str | Column, values: Sequence) -> Column:
    """SQL ``NOT IN``: NULL input gives NULL (so a filter drops the row)."""
    return ~col(c).isin(*values)


def not_in_null_safe(c: str | Column, values: Sequence) -> Column:
    """R's ``%notin%``: NULL counts as "not in", so the row is kept."""
    return ~F.coalesce(col(c).isin(*values), F.lit(False))


def label_lookup(c: str | Column, pairs: Iterable[tuple], default=None) -> Column:
    """Ordered CASE over literal (key, label) pairs; unknown keys give ``default``."""
    c = col(c)
    expr = None
    for key, label in pairs:
        expr = F.when(c == F.lit(key), F.lit(label)) if expr is None else expr.when(c == F.lit(key), F.lit(label))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def booking_gmv(amount="amount", selling_amount="selling_amount", discount="discount") -> Column:
    """Net booking value: ``coalesce(selling_amount, amount) - coalesce(discount, 0)``."""
    return F.coalesce(col(selling_amount), col(amount)) - F.coalesce(col(discount), F.lit(0))


def booking_nights(checkin="checkin", checkout="checkout") -> Column:
    """Days between check-in and check-out."""
    return F.datediff(col(checkout), col(checkin))


def per_night(value: Column, nights: Column) -> Column:
    """Value spread over the nights of a stay, as a decimal of fixed scale: its sums are the same in any order.

    Zero-night stays have no nights and are dropped by the stay-night expansion. The division is
    ``try_divide`` (NULL for 0 nights), so it cannot raise under ANSI mode even when Spark evaluates it
    before that filter.
    """
    return F.try_divide(value.cast(VALUE_TYPE), nights.cast("decimal(10,0)")).cast(VALUE_TYPE)


def utc_offset_minutes(offset: str | Column) -> Column:
    """``+HH:MM`` -> minutes; any text not starting with ``+`` counts as negative."""
    o = col(offset)
    minutes = F.substring(o, 2, 2).try_cast("int") * 60 + F.substring(o, 5, 2).try_cast("int")
    return F.when(F.substring(o, 1, 1) == F.lit("+"), minutes).otherwise(-minutes)


def local_cancel_time(cancellation_time: str | Column, updated_at: str | Column, offset_minutes: str | Column) -> Column:
    """Cancellation time in local time (timestamp without zone).

    ``coalesce(cancellation_time, updated_at)``; NULL or the text ``'null'`` becomes a fixed old timestamp;
    the first 19 characters are parsed and shifted by the city's UTC offset (NULL offset -> NULL).
    """
    raw = F.coalesce(col(cancellation_time), col(updated_at))
    text = F.when(raw != F.lit("null"), raw).otherwise(F.lit(MISSING_CANCEL_TIME))
    ts = F.substring(text, 1, 19).try_cast("timestamp_ntz")
    return F.timestamp_add("MINUTE", col(offset_minutes), ts)


def is_late_cancellation(status: str | Column, local_time: str | Column, checkin: str | Column) -> Column:
    """Cancelled (status 3) on the check-in day from 18:00 local time on, or on a later day."""
    lt = col(local_time)
    day = F.to_date(lt)
    late = ((day == col(checkin)) & (F.hour(lt) >= LATE_CANCEL_HOUR)) | (day > col(checkin))
    return (col(status) == F.lit(3)) & late


def json_text(doc: str | Column, path: str) -> Column:
    """Scalar at ``path`` as text (JSON strings unquoted, numbers and booleans as written)."""
    return F.get_json_object(col(doc), path)


def whole_number(text: str | Column) -> Column:
    """Text as an integer: numbers with decimals are rounded, text that is no number gives NULL."""
    return F.round(col(text).try_cast("double")).try_cast("int")


def json_has_path(doc: str | Column, path: str) -> Column:
    """True when ``path`` exists, also when it holds JSON ``null`` (``get_json_object`` cannot tell)."""
    return F.try_variant_get(F.try_parse_json(col(doc)), path, "variant").isNotNull()


def zero_fill(df, text_fill: str | None = "0"):
    """Replace every NULL: numbers by 0 and, when ``text_fill`` is given, text by it (R ``x[is.na(x)] <- 0``)."""
    df = df.na.fill(0)
    return df.na.fill(text_fill) if text_fill is not None else df


def money(c: str | Column) -> Column:
    """Output form of a value: rounded to 6 decimals, ``DECIMAL(38,6)`` (exact text, engine-independent)."""
    return F.round(col(c), 6).cast("decimal(38,6)")


def count(c: str | Column) -> Column:
    """Output form of a room count: ``BIGINT``."""
    return col(c).cast("bigint")
