"""Sales-channel classification, pivots by channel and channel-group roll-ups."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R

# A rule is (name, condition, label); conditions see the booking columns plus ``ota_label`` and ``enum_val``.
# The first rule whose condition is TRUE wins; NULL conditions fall through, as in SQL ``CASE``.
Rule = tuple[str, Callable[[], Column], Callable[[], Column]]


def _ota_source() -> Column:
    return F.col("source").isin(*R.OTA_SOURCES) & F.col("micro_market_id").isNull()


def _not_gds() -> Column:
    return ~F.col("ota_id").isin(*R.GDS_OTA_IDS)


def _micro_market() -> Column:
    mm = F.col("micro_market_id")
    return mm.isNotNull() & (mm > 0) & ~mm.isin(*R.NON_MM_MICRO_MARKETS)


def _meta(sub_source: int) -> Column:
    return (F.col("source") == R.META_SOURCE) & (F.col("sub_source") == sub_source)


FULL_RULES: tuple[Rule, ...] = (
    ("unlabelled_ota", lambda: _ota_source() & F.col("ota_label").isNull() & _not_gds(), lambda: F.lit(R.OTHER_OTA)),
    ("labelled_ota", lambda: _ota_source() & _not_gds(), lambda: F.col("ota_label")),
    ("migration", lambda: (F.col("source") == R.MIGRATION_SOURCE) & F.col("micro_market_id").isNull(),
     lambda: F.lit(R.MIGRATION_OTA)),
    ("micro_market", _micro_market, lambda: F.lit(R.MICRO_MARKET)),
    ("bog", lambda: _meta(R.BOG_SUB_SOURCE), lambda: F.lit(R.BOG)),
    ("trivago", lambda: _meta(R.TRIVAGO_SUB_SOURCE), lambda: F.lit(R.TRIVAGO)),
    ("gds", lambda: F.col("ota_id").isin(*R.GDS_OTA_IDS), lambda: F.lit(R.GDS)),
)

# The realization report uses a shorter ladder: no travel-agent id tests, no Trivago and no GDS rule.
REDUCED_RULES: tuple[Rule, ...] = (
    ("unlabelled_ota", lambda: _ota_source() & F.col("ota_label").isNull(), lambda: F.lit(R.OTHER_OTA)),
    ("labelled_ota", _ota_source, lambda: F.col("ota_label")),
    FULL_RULES[2],
    FULL_RULES[3],
    FULL_RULES[4],
)


def classify(rules: Sequence[Rule], fallback: Callable[[], Column] = lambda: F.col("enum_val")) -> Column:
    """Fold an ordered rule list into one ``CASE WHEN`` expression."""
    expr = None
    for _, cond, label in rules:
        expr = F.when(cond(), label()) if expr is None else expr.when(cond(), label())
    return expr.otherwise(fallback())


def ota_label(name: str | Column = "name") -> Column:
    """Travel-agent name -> channel label (case-sensitive); unknown or NULL names give ``other_ota``."""
    name = F.col(name) if isinstance(name, str) else name
    expr = None
    for label, names in R.OTA_NAME_LABELS:
        cond = name.isin(*names)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(R.OTHER_OTA))


def labelled_agents(online_travel_agents: DataFrame) -> DataFrame:
    """``(ota_key, ota_label)`` per travel agent."""
    return online_travel_agents.select(F.col("id").alias("ota_key"), ota_label("name").alias("ota_label"))


def with_channel_inputs(bookings: DataFrame, online_travel_agents: DataFrame, source_enums: DataFrame) -> DataFrame:
    """Left lookups of the agent label (by ``ota_id``) and the source label (by ``source``).

    Both lookups are small dimensions; the planner broadcasts them by measured size.
    """
    agents = labelled_agents(online_travel_agents)
    enums = source_enums.select(F.col("enum_key").alias("_enum_key"), "enum_val")
    return (bookings
            .join(agents, F.col("ota_id") == F.col("ota_key"), "left").drop("ota_key")
            .join(enums, F.col("source") == F.col("_enum_key"), "left").drop("_enum_key"))


def with_channel(bookings: DataFrame, online_travel_agents: DataFrame, source_enums: DataFrame,
                 rules: Sequence[Rule] = FULL_RULES, name: str = "booking_source") -> DataFrame:
    """Add the channel column computed by ``rules``."""
    return with_channel_inputs(bookings, online_travel_agents, source_enums).withColumn(name, classify(rules))


def with_unlisted(channels: Sequence[str]) -> tuple[str, ...]:
    """The channels a pivot gives columns to: those asked for, and always the bucket for every other label."""
    return tuple(dict.fromkeys([*channels, R.UNLISTED_CHANNEL]))


def known_channels(source_enums: DataFrame) -> tuple[str, ...]:
    """All labels a booking can get: the rules' and those of the source lookup (a small table, read here), in
    the default order; labels that the default list doesn't have come last, by name."""
    labels = {r[0] for r in source_enums.select("enum_val").where("enum_val IS NOT NULL").distinct().collect()}
    fixed = [c for c in R.DEFAULT_CHANNELS if c in labels or c in R.RULE_LABELS]
    return with_unlisted([*fixed, *sorted(labels.difference(fixed))])


def sql_name(name: str) -> str:
    """Quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Key of the NULL label in a channel map (map keys can't be NULL); no label has it.
NULL_KEY = "\u0000"
CHANNEL_MAP = "__channels"


def pivot_state(channel: str, channels: Sequence[str], measures: Sequence[str], null_label: str) -> list[Column]:
    """Aggregates that hold a pivot by channel: a map from each listed label to its measures, and the sums over all
    labels that are not listed (NULL is listed if ``null_label`` is).

    The rows are already one per key and label, so the map has at most one entry per listed label and no sum is kept
    for every channel x measure. ``pivot_columns`` reads the pivot's columns from it."""
    label = sql_name(channel)
    listed = ", ".join(sql_text(c) for c in channels if c != R.UNLISTED_CHANNEL)
    fields = ", ".join(f"{sql_text(m)}, {sql_name(m)}" for m in measures)
    known = f"coalesce({label} IN ({listed}), {'true' if null_label in channels else 'false'})" if listed else "false"
    entry = f"struct(coalesce({label}, {sql_text(NULL_KEY)}), named_struct({fields}))"
    return [F.expr(f"map_from_entries(collect_list(CASE WHEN {known} THEN {entry} END)) AS {sql_name(CHANNEL_MAP)}"),
            *[F.expr(f"sum(CASE WHEN {known} THEN 0 ELSE {sql_name(m)} END) AS "
                     f"{sql_name(f'{R.UNLISTED_CHANNEL}_{m}')}") for m in measures]]


def pivot_columns(df: DataFrame, channels: Sequence[str], measures: Sequence[str], null_label: str,
                  skip: frozenset[str] = frozenset(), shape: Callable[[str, str], str] = lambda m, value: value) -> DataFrame:
    """``df`` with :func:`pivot_state` aggregates as ``<channel>_<measure>`` columns, 0 when absent; ``null_label`` is
    the column of the NULL label. Names in ``skip``, which other columns have, are left out.

    ``shape(measure, value)`` is the output form of a value, as SQL; it is taken of the values that a row has, before the
    0 of absent channels, so most cells of a wide pivot cost a null check. Each label is looked up once per row. The expressions are given as SQL text: a report has a few hundred of them,
    and one expression per call keeps building the plan cheap on the driver."""
    keep = [sql_name(c) for c in df.columns if c != CHANNEL_MAP]
    return (df.selectExpr("*", *pivot_lookups(channels))
            .selectExpr(*keep, *pivot_cells(channels, measures, null_label, skip, shape)))


def pivot_lookups(channels: Sequence[str], state: str = CHANNEL_MAP) -> list[str]:
    """Each listed label's measures, looked up in the map ``state`` (SQL; NULL where the label or the map is missing)."""
    listed = [c for c in channels if c != R.UNLISTED_CHANNEL]
    return [*[f"try_element_at({sql_name(state)}, {sql_text(c)}) AS `{state}_{i}`" for i, c in enumerate(listed)],
            f"try_element_at({sql_name(state)}, {sql_text(NULL_KEY)}) AS `{state}_null`"]


def pivot_cells(channels: Sequence[str], measures: Sequence[str], null_label: str, skip: frozenset[str] = frozenset(),
                shape: Callable[[str, str], str] = lambda m, value: value, state: str = CHANNEL_MAP) -> list[str]:
    """The ``<channel>_<measure>`` columns over :func:`pivot_lookups` (SQL); see :func:`pivot_columns`."""
    columns = []
    for i, c in enumerate(c for c in channels if c != R.UNLISTED_CHANNEL):
        for m in measures:
            if f"{c}_{m}" in skip:
                continue
            value = f"`{state}_{i}`.{sql_name(m)}"
            if c == null_label:
                null = f"`{state}_null`.{sql_name(m)}"
                value = f"coalesce({value} + {null}, {value}, {null})"
            columns.append(f"coalesce({shape(m, value)}, 0) AS {sql_name(f'{c}_{m}')}")
    return columns


def group_names(group: str, measures: Sequence[tuple[str, str]]) -> frozenset[str]:
    """Output names of :func:`group_aggs`."""
    return frozenset(f"{group}_{suffix}" for suffix, _ in measures)


def group_aggs(channel: str, group: str, members: Sequence[str], measures: Sequence[tuple[str, str]],
               extra_cond: str | None = None) -> list[Column]:
    """Sum of ``measure`` over the channels of a group, named ``<group>_<suffix>``; 0 when none.

    ``extra_cond`` is a boolean column name that must also be true (NULL counts as false).
    """
    cond = f"{sql_name(channel)} IN ({', '.join(sql_text(m) for m in members)})"
    if extra_cond is not None:
        cond = f"{cond} AND {sql_name(extra_cond)}"
    return [F.expr(f"sum(CASE WHEN {cond} THEN {sql_name(m)} ELSE 0 END) AS {sql_name(f'{group}_{suffix}')}")
            for suffix, m in measures]
