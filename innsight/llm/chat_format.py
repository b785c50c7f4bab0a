"""Chat formatting by schema fingerprint.

A record is JSON text of any known layout: a prompt with a completion, an instruction with input and output, or a
list of messages under one of several names. Its fingerprint is a hash of its nested field paths (names and nesting
of objects and arrays; scalar types, values and lengths don't matter). The fingerprint of the fields that layouts use
selects a declarative mapping from a table, by a join, and the mapping turns the record into canonical turns (role,
text). Turns are written into one string by a template whose control strings are escaped, reversibly, where they occur
inside a role or text; spans mark the assistant's texts for the loss. Everything is DataFrame expressions, and the work on
a conversation grows in proportion to its turns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

#: JSON reader options for records that the variant parser doesn't take, as their texts are too long for it.
_LONG = {"maxStringLen": "2147483647", "columnNameOfCorruptRecord": "__corrupt"}
TURNS = "array<struct<role: string, text: string>>"
START, END = "<|im_start|>", "<|im_end|>"
#: Role names of a public chat layout and the canonical role each stands for; other names stay as they are.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Single:
    """A layout of single fields: for each turn its role and the fields that make its text (joined by a blank line;
    absent and empty ones left out). A turn whose fields are all absent or empty is left out if ``optional``."""

    name: str
    turns: tuple[tuple[str, tuple[str, ...], bool], ...]  # role, fields, optional

    def paths(self) -> list[tuple[str, ...]]:
        """Sets of fields that have this layout."""
        every = [f for _, fields, _ in self.turns for f in fields]
        needed = [f for _, fields, optional in self.turns if not optional for f in fields[:1]]
        free = [f for f in every if f not in needed]
        return [tuple(sorted([*needed, *(f for i, f in enumerate(free) if n >> i & 1)])) for n in range(1 << len(free))]


@dataclass(frozen=True)
class Messages:
    """A layout of a list under ``path``, each item with a role and a text field; ``roles`` renames its roles."""

    name: str
    path: str
    role: str
    text: str
    roles: tuple[tuple[str, str], ...] = ()


#: Layouts in use; a record of none of them keeps null turns.
LAYOUTS: tuple[Single | Messages, ...] = (
    Messages("messages", "messages", "role", "content"),
    Messages("conversations", "conversations", "from", "value", tuple(ROLES.items())),
    Messages("turns", "turns", "role", "text"),
    Single("prompt", (("system", ("system",), True), ("user", ("prompt",), False),
                      ("assistant", ("completion",), False))),
    Single("response", (("system", ("system",), True), ("user", ("prompt",), False),
                        ("assistant", ("response",), False))),
    Single("instruction", (("system", ("system",), True), ("user", ("instruction", "input"), False),
                           ("assistant", ("output",), False))),
    Single("question", (("user", ("question", "context"), False), ("assistant", ("answer",), False))),
)


def field_paths(record: Column) -> Column:
    """Nested field paths of a variant: its schema with every scalar type written as ``?``. Objects list their
    fields by name, so the order of fields in the record doesn't matter; arrays merge their items' fields."""
    schema = F.schema_of_variant(record)
    return F.regexp_replace(schema, r"(?<=: |ARRAY<|^)(?!OBJECT<|ARRAY<)[A-Z]+(?:\([0-9, ]+\))?(?=[,>]|$)", "?")


def fingerprint(record: Column) -> Column:
    """64-bit hash of the record's nested field paths."""
    return F.xxhash64(field_paths(record))


def used_paths(paths: Column, layouts: Sequence[Single | Messages]) -> Column:
    """Field paths without the fields that no layout names (an id, a weight, flat lists and objects of them)."""
    names = "|".join(sorted({n for x in layouts for n in _names(x)}))
    other = rf"(?:`(?:[^`]|``)*`|(?!(?:{names}): )\w+): (?:\?|(?:OBJECT|ARRAY)<[^<>]*>)"
    return F.regexp_replace(F.regexp_replace(paths, rf"(?<=<){other}(?:, {other})*(?:, |(?=>))", ""), rf", {other}", "")


def _names(layout: Single | Messages) -> list[str]:
    if isinstance(layout, Messages):
        return [layout.path, layout.role, layout.text]
    return [f for _, fields, _ in layout.turns for f in fields]


def typed_paths(value: Column, kind: DataType) -> Column:
    """Field paths of a value of a declared type, written as ``field_paths`` writes them: fields that are null are
    absent, and so are the fields of an empty list's items."""
    if isinstance(kind, StructType):
        fields = [F.when(value[f.name].isNotNull(), F.concat(F.lit(f"{f.name}: "), typed_paths(value[f.name], f.dataType)))
                  for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.concat(F.lit("OBJECT<"), F.array_join(F.array(*fields), ", "), F.lit(">"))
    if isinstance(kind, ArrayType):
        # list items have the fields of their type
        return F.when(F.size(value) > 0, F.lit(f"ARRAY<{_type_paths(kind.elementType)}>")).otherwise(F.lit("ARRAY<?>"))
    return F.lit("?")


def _type_paths(kind: DataType) -> str:
    if isinstance(kind, StructType):
        return "OBJECT<" + ", ".join(f"{f.name}: {_type_paths(f.dataType)}"
                                     for f in sorted(kind.fields, key=lambda f: f.name)) + ">"
    return f"ARRAY<{_type_paths(kind.elementType)}>" if isinstance(kind, ArrayType) else "?"


def _expected_paths(layout: Single | Messages) -> list[str]:
    if isinstance(layout, Messages):
        items = "OBJECT<" + ", ".join(f"{x}: ?" for x in sorted([layout.role, layout.text])) + ">"
        return [f"OBJECT<{layout.path}: ARRAY<{x}>>" for x in (items, "?")]  # "?": an empty list
    return ["OBJECT<" + ", ".join(f"{x}: ?" for x in names) + ">" for names in layout.paths()]


def mapping_table(spark: SparkSession, layouts: Sequence[Single | Messages] = LAYOUTS) -> DataFrame:
    """(fingerprint, layout): a handful of rows per layout. An empty list maps to the first layout of its name."""
    rows: dict[str, str] = {}
    for x in layouts:
        for p in _expected_paths(x):
            rows.setdefault(p, x.name)
    return (spark.createDataFrame(list(rows.items()), "paths string, layout string")
            .select(F.xxhash64("paths").alias("fingerprint"), "layout"))


def with_layout(records: DataFrame, paths: Column, layouts: Sequence[Single | Messages]) -> DataFrame:
    """``records`` with ``layout``, which the mapping table has for the fingerprint of the fields that layouts use; null
    where it has none. The table has a handful of rows by construction and is broadcast."""
    printed = records.withColumn("fingerprint", F.xxhash64(used_paths(paths, layouts)))
    return printed.join(F.broadcast(mapping_table(records.sparkSession, layouts)), "fingerprint", "left").drop("fingerprint")


def _turns(record: Column, layout: Single | Messages, typed: bool = False) -> Column:
    """Canonical turns of a variant, or of a struct with the layout's fields (``typed``)."""
    def text(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    if isinstance(layout, Messages):
        kind = f"array<struct<`{layout.role}`: string, `{layout.text}`: string>>"
        items = record[layout.path] if typed else F.try_variant_get(record, f"$.{layout.path}", kind)
        known = F.create_map(*[F.lit(x) for pair in layout.roles for x in pair]) if layout.roles else None

        def role(c: Column) -> Column:
            return text(c) if known is None else F.coalesce(F.try_element_at(known, c), c, F.lit(""))

        return F.transform(items if typed else F.coalesce(items, F.array().cast(kind)), lambda x: F.struct(
            role(x[layout.role]).alias("role"), text(x[layout.text]).alias("text")))
    out = []
    for name, fields, optional in layout.turns:
        parts = F.array(*[record[f] if typed else F.try_variant_get(record, f"$.{f}", "string") for f in fields])
        said = F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), "\n\n")
        turn = F.array(F.struct(F.lit(name).alias("role"), said.alias("text")))
        out.append(F.when(said != "", turn).otherwise(F.array().cast(TURNS)) if optional else turn)
    return F.concat(*out)


def _by_layout(record: Column, layouts: Sequence[Single | Messages], typed: bool = False) -> Column:
    turns = F.lit(None).cast(TURNS)
    for x in layouts:
        turns = F.when(F.col("layout") == x.name, _turns(record, x, typed)).otherwise(turns)
    return turns


def _layout_schema(layouts: Sequence[Single | Messages]) -> StructType:
    """All layouts' fields as one struct, and the column of records that aren't read."""
    lists: dict[str, set[str]] = {}
    for x in layouts:
        if isinstance(x, Messages):
            lists.setdefault(x.path, set()).update((x.role, x.text))
    singles = {n for x in layouts if isinstance(x, Single) for n in _names(x)} - set(lists)
    text = StringType()
    items = {p: ArrayType(StructType([StructField(n, text) for n in sorted(ns)])) for p, ns in lists.items()}
    return StructType([*[StructField(p, t) for p, t in sorted(items.items())],
                       *[StructField(n, text) for n in sorted(singles)], StructField("__corrupt", text)])


def canonical_turns(records: DataFrame, id_col: str = "id", json_col: str = "record",
                    layouts: Sequence[Single | Messages] = LAYOUTS) -> DataFrame:
    """(id, layout, turns): one row per record. Records that are null, no JSON, or of no known layout have null layout
    and turns; fields that no layout names are ignored.

    The variant parser gives null for what isn't JSON and for JSON with very long texts. Whatever it doesn't take, of any
    length, is read once more as a struct of the layouts' fields, by a reader without that limit, and matched by the
    fingerprint of the struct."""
    schema = _layout_schema(layouts)
    parsed = records.select(F.col(id_col).alias("id"), F.col(json_col).alias("json"),
                            F.try_parse_json(F.col(json_col)).alias("record"))
    rest = F.from_json(F.when(F.col("record").isNull(), F.col("json")), schema, _LONG)
    read = parsed.select("id", "record", rest.alias("long"))
    sound = F.col("long").isNotNull() & F.col("long.__corrupt").isNull()
    known = StructType([f for f in schema.fields if f.name != "__corrupt"])
    paths = F.when(F.col("record").isNotNull(), field_paths(F.col("record"))) \
        .when(sound, typed_paths(F.col("long"), known))
    mapped = with_layout(read, paths, layouts)
    return mapped.select("id", "layout", F.when(F.col("record").isNotNull(), _by_layout(F.col("record"), layouts))
                         .otherwise(_by_layout(F.col("long"), layouts, typed=True)).alias("turns"))


def escape(c: Column) -> Column:
    """Every ``<|`` becomes ``<\\|``, and each further backslash there one more, so no control string is left."""
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\\\|", "<$1|")


def _escape_role(c: Column) -> Column:
    """A role also must not hold the line break that ends it."""
    return escape(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(c: Column) -> Column:
    return F.replace(F.replace(unescape(c), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


#: Turns whose places are added up in one growing list. Spark copies such a list with each step, so it is kept short.
_CHUNK = 64
PLACE = "struct<turn: bigint, start: bigint, length: bigint>"


def with_format(canonical: DataFrame) -> DataFrame:
    """``canonical`` (with ``turns``) with ``formatted``, the conversation's string, and ``loss``: for each turn where it
    begins, where its text begins and, if it is the assistant's, the text's length (in code points; null: no loss).

    Places are added up within chunks of turns and then over the chunks. Lists that are read more than once are
    columns of their own, so that no step works them out again."""
    pieces = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == "assistant").alias("learn")))
    lengths = F.transform("__pieces", lambda p: F.struct(
        p["learn"].alias("learn"), F.char_length(p["head"]).cast("long").alias("head"),
        F.char_length(p["body"]).cast("long").alias("body")))
    firsts = F.when(F.size("__lengths") > 0, F.sequence(F.lit(1), F.size("__lengths"), F.lit(_CHUNK))) \
        .when(F.col("__lengths").isNotNull(), F.array().cast("array<int>"))
    none = F.lit(0).cast("long")
    sizes = F.transform("__chunks", lambda c: F.aggregate(c, none, lambda n, p: n + _turn_length(p)))
    begins = F.aggregate(sizes, F.struct(none.alias("at"), F.array().cast("array<bigint>").alias("all")),
                         lambda acc, n: F.struct((acc["at"] + n).alias("at"),
                                                 F.concat(acc["all"], F.array(acc["at"])).alias("all")),
                         lambda acc: acc["all"])
    formatted = F.concat_ws("", F.transform("__pieces", lambda p: F.concat(p["head"], p["body"], F.lit(f"{END}\n"))))
    return (canonical.withColumn("__pieces", pieces).withColumn("__lengths", lengths)
            .withColumn("__chunks", F.transform(firsts, lambda i: F.slice("__lengths", i, _CHUNK)))
            .withColumn("loss", F.flatten(F.zip_with("__chunks", begins, _places)))
            .withColumn("formatted", F.when(F.col("loss").isNotNull(), formatted))
            .drop("__pieces", "__lengths", "__chunks"))


def _turn_length(p: Column) -> Column:
    return p["head"] + p["body"] + len(END) + 1


def _places(chunk: Column, begin: Column) -> Column:
    """Places of a chunk's turns from (learn, head, body) lengths."""
    return F.aggregate(
        chunk, F.struct(begin.alias("at"), F.array().cast(f"array<{PLACE}>").alias("all")),
        lambda acc, p: F.struct(
            (acc["at"] + _turn_length(p)).alias("at"),
            F.concat(acc["all"], F.array(F.struct(
                acc["at"].alias("turn"), (acc["at"] + p["head"]).alias("start"),
                F.when(p["learn"], p["body"]).alias("length")))).alias("all")),
        lambda acc: acc["all"])


def read_turns(formatted: Column) -> Column:
    """Turns read back from a formatted string: the inverse of ``format_turns``."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        _unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.regexp_extract(p, r"(?s)^[^\n]*\n(.*)<\|im_end\|>\n$", 1)).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """Texts under the loss mask, unescaped, in order. The string is parted once at its turns, and each text is read
    at its place in its turn."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    read = F.zip_with(parts, loss, lambda p, x: F.when(x["length"].isNotNull(), unescape(F.substring(
        p, (x["start"] - x["turn"] - len(START) + 1).cast("int"), x["length"].cast("int")))))
    return F.filter(read, lambda t: t.isNotNull())


def format_chats(records: DataFrame, id_col: str = "id", json_col: str = "record",
                 layouts: Sequence[Single | Messages] = LAYOUTS) -> DataFrame:
    """(id, layout, formatted, loss): one row per record.

    A conversation is one string, so its turns come together in one row; conversations never meet. Null roles and
    texts are empty; a record without turns formats to the empty string; one of no known layout keeps null. Ids may
    be null or repeat; an empty table gives an empty result; other columns are not read."""
    return format_canonical(canonical_turns(records, id_col, json_col, layouts))


def format_canonical(canonical: DataFrame) -> DataFrame:
    """(id, layout, formatted, loss) of (id, layout, turns)."""
    return with_format(canonical).select("id", "layout", "formatted", "loss")


def _conversations(conversations: DataFrame) -> DataFrame:
    """(id, turns): rows by turn gathered per conversation, ordered by turn, then role, then text, nulls first; null
    role and text are empty."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return (conversations.select("conv_id", turn.alias("t")).groupBy("conv_id")
            .agg(F.sort_array(F.collect_list("t")).alias("turns"))
            .select(F.col("conv_id").alias("id"), "turns"))


def conversation_records(conversations: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) as one JSON record per conversation, in the ``turns`` layout.
    Turns are ordered by turn, then role, then text, nulls first; null role and text are empty."""
    return _conversations(conversations).select("id", F.to_json(F.struct("turns")).alias("record"))


def format_conversations(conversations: DataFrame, layouts: Sequence[Single | Messages] = LAYOUTS) -> DataFrame:
    """What ``format_chats`` gives for ``conversation_records``, without JSON in between: records are structs, whose
    nested field paths are hashed and joined to the mapping table like those of any record."""
    records = _conversations(conversations).select("id", F.struct("turns").alias("record"))
    mapped = with_layout(records, typed_paths(F.col("record"), records.schema["record"].dataType), layouts)
    lists = [x for x in layouts if isinstance(x, Messages) and x.path == "turns"]
    return format_canonical(mapped.select("id", "layout", _by_layout(F.col("record"), lists, typed=True).alias("turns")))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, from what ``format_chats`` returns: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, all read back from the formatted string."""
    read = formatted.select("id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                            F.array_join(read_loss(F.col("formatted"), F.col("loss")), "").alias("learned"))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        F.col("id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"), F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
