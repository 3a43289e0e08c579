"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

Every nested field path of a record is hashed, and the hashes together are its schema fingerprint. A
layout, which says by field paths where turns, roles and texts are, is chosen once for each different
fingerprint, and records find theirs by fingerprint: of the layouts whose paths are all there the one
with the most, and of these the first in `LAYOUTS`, so that further fields do not matter, whatever
their names. Tables with typed columns have the paths of their schema, hence one fingerprint; records
in JSON text have their own each, with the paths of null values and of all elements of lists. Canonical turns are then written with control strings around them. Inside roles and texts every character that
could begin a control string, and the escape character, is followed by an escape character, so no
control string can appear there, and removing these characters gives the text back.

Defined results: null texts and roles are empty; turns are in the order of turn, role, text, nulls
first; rows with no conversation id form one conversation; records of no known layout keep their
row, with layout "unmapped" and no turns; an empty table gives no rows. A conversation is one value by its nature and has to fit into one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"

# control strings; each begins with a character of ESCAPED
OPEN, BODY, CLOSE = "<|turn|>", "<|text|>", "<|end|>"
ESCAPED, ESCAPE = "<[", "\\"
_UNSAFE = r"([<\[\\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _UNSAFE, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _UNSAFE + r"\\", "$1")


@dataclass(frozen=True)
class Layout:
    """Where the turns are. `paths`: the field paths that it needs, `[]` for elements.
    `turns`: (role, path) pairs for single fields. `list_path`, `role`, `text`: for lists of turns.
    `order`: for tables with a row for each turn."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    list_path: str = ""
    role: str = ""
    text: str = ""
    order: str = ""


LAYOUTS = (
    Layout("turn_rows", ("role", "text", "turn"), role="role", text="text", order="turn"),
    Layout("messages", ("messages[].content", "messages[].role"), list_path="messages", role="role", text="content"),
    Layout("conversations", ("conversations[].from", "conversations[].value"), list_path="conversations", role="from", text="value"),
    Layout("turns", ("turns[].role", "turns[].text"), list_path="turns", role="role", text="text"),
    Layout("prompt_completion", ("completion", "prompt"), turns=(("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt_response", ("prompt", "response"), turns=(("user", "prompt"), ("assistant", "response"))),
    Layout("instruction", ("instruction", "output"), turns=(("user", "instruction"), ("assistant", "output"))),
    Layout(
        "instruction_input",
        ("input", "instruction", "output"),
        turns=(("user", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    Layout("system_prompt", ("prompt", "response", "system"), turns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
)
#: names that other layouts give the roles
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def preferred() -> list[Layout]:
    """The layouts, those with more paths first."""
    return sorted(LAYOUTS, key=lambda layout: -len(layout.paths))


def schema_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Paths of all leaves."""
    found = []
    for field in schema.fields:
        kind, path = field.dataType, prefix + field.name
        while isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        found += schema_paths(kind, path + ".") if isinstance(kind, T.StructType) else [path]
    return found


def fingerprint(paths: Column) -> Column:
    """Of an array of field paths, in whatever order: the hash of their sorted hashes."""
    return F.md5(F.array_join(F.array_sort(F.transform(F.array_distinct(paths), F.md5)), ""))


def schema_fingerprint(schema: T.StructType) -> str:
    """The fingerprint of a typed table, the same as of a record with these paths."""
    hashed = sorted(hashlib.md5(p.encode()).hexdigest() for p in set(schema_paths(schema)))
    return hashlib.md5("".join(hashed).encode()).hexdigest()


#: layouts of the fingerprints that tables have had
_MAPPINGS: dict[str, Layout | None] = {}


def layout_of(schema: T.StructType) -> Layout:
    """The layout of a typed table, by its fingerprint; found out when the fingerprint is new."""
    print_of = schema_fingerprint(schema)
    if print_of not in _MAPPINGS:
        present = set(schema_paths(schema))
        _MAPPINGS[print_of] = next((layout for layout in preferred() if present.issuperset(layout.paths)), None)
    layout = _MAPPINGS[print_of]
    if layout is None:
        raise ValueError(f"no layout for the field paths {schema_paths(schema)}")
    return layout


def mappings(records: DataFrame) -> DataFrame:
    """`_fingerprint`, `layout`: a row for each different fingerprint of rows with `_paths`."""
    each = records.groupBy("_fingerprint").agg(F.get(F.collect_set("_paths"), F.lit(0)).alias("_paths"))
    name = F.lit("unmapped")
    for layout in reversed(preferred()):
        if not layout.order:
            needed = F.array(*map(F.lit, layout.paths))
            name = F.when(F.size(F.array_except(needed, F.col("_paths"))) == 0, layout.name).otherwise(name)
    return each.select("_fingerprint", name.alias("layout"))


def _role(role: Column) -> Column:
    plain = F.coalesce(role, F.lit(""))
    for name, means in ROLES.items():
        plain = F.when(role == name, means).otherwise(plain)
    return plain


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.cast("string").alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _from_list(elements: Column, role: Callable[[Column], Column], text: Callable[[Column], Column]) -> Column:
    return F.transform(elements, lambda t: _turn(_role(role(t)), text(t))).cast(TURNS)


def _from_fields(layout: Layout, field: Callable[[str], Column], has: Callable[[str], Column]) -> Column:
    """An array of turns; a field that is absent or null gives no turn of its own."""
    made = [F.when(has(path), _turn(F.lit(role), field(path))) for role, path in layout.turns]
    return F.filter(F.array(*made), lambda t: t.isNotNull()).cast(TURNS)


def canonical(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """`key`, `layout` and `turns` of a table with typed columns, by the layout its schema selects."""
    layout = layout_of(df.schema)
    if layout.order:
        said = F.struct(
            F.col(layout.order).alias("at"), _role(F.col(layout.role)).alias("role"), F.coalesce(F.col(layout.text), F.lit("")).alias("text")
        )
        in_order = F.sort_array(F.collect_list(said))
        turns = F.transform(in_order, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).cast(TURNS)
        return df.groupBy(key).agg(turns.alias("turns")).select(key, F.lit(layout.name).alias("layout"), "turns")
    if layout.list_path:
        elements = F.coalesce(F.col(layout.list_path), F.array())
        turns = _from_list(elements, lambda t: t[layout.role], lambda t: t[layout.text])
    else:
        turns = _from_fields(layout, F.col, lambda path: F.col(path).isNotNull())
    return df.select(key, F.lit(layout.name).alias("layout"), turns.alias("turns"))


def canonical_json(df: DataFrame, key: str, record: str) -> DataFrame:
    """`key`, `layout` and `turns` of records in JSON text, each by its own fingerprint."""
    no_names, no_elements = F.array().cast("array<string>"), F.array().cast("array<variant>")

    def at(path: str, of: str | Column = "_record", kind: str = "string") -> Column:
        return F.try_variant_get(of, f"$.{path}", kind)

    def fields(of: str | Column) -> Column:
        return F.try_variant_get(of, "$", "map<string,variant>")

    def below(name: Column, value: Column) -> Column:
        """Paths from a field on: of the fields of all its elements, of its own fields, or else itself."""
        elements = F.try_variant_get(value, "$", "array<variant>")
        listed = F.flatten(F.transform(elements, lambda e: F.coalesce(F.map_keys(fields(e)), no_names)))
        listed = F.transform(listed, lambda n: F.concat(name, F.lit("[]."), n))
        own = F.transform(F.map_keys(fields(value)), lambda n: F.concat(name, F.lit("."), n))
        return F.coalesce(F.when(F.size(listed) > 0, listed), F.when(F.size(own) > 0, own), F.array(name))

    every = F.flatten(F.transform(F.map_entries(fields("_record")), lambda e: below(e["key"], e["value"])))
    paths = F.array_sort(F.array_distinct(F.coalesce(every, no_names)))
    parsed = df.select(F.col(key), F.try_parse_json(F.col(record).cast("string")).alias("_record")).withColumn("_paths", paths)
    parsed = parsed.withColumn("_fingerprint", fingerprint(F.col("_paths")))
    found = parsed.join(mappings(parsed.select("_fingerprint", "_paths")), "_fingerprint")
    turns = F.lit(None).cast(TURNS)
    for layout in preferred():
        if layout.order:
            continue
        if layout.list_path:
            elements = F.coalesce(at(layout.list_path, kind="array<variant>"), no_elements)
            mapped = _from_list(elements, lambda t: at(layout.role, t), lambda t: at(layout.text, t))
        else:
            mapped = _from_fields(layout, at, lambda path: at(path).isNotNull())
        turns = F.when(F.col("layout") == layout.name, mapped).otherwise(turns)
    return found.select(key, "layout", turns.alias("turns"))


def formatted(df: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Adds `segments` (pieces of the output in order, each with whether the loss counts it) and
    `formatted`, the pieces together. The texts of the roles in `learn` are under the loss."""

    def pieces(turn: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(OPEN), escaped(turn["role"]), F.lit(BODY)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(turn["text"]).alias("text"), turn["role"].isin(*learn).alias("loss")),
            F.struct(F.lit(CLOSE).alias("text"), F.lit(False).alias("loss")),
        )

    segments = F.flatten(F.transform("turns", pieces))
    return df.withColumn("segments", segments).withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
    )


def parsed(formatted_text: Column) -> Column:
    """The turns that a formatted text holds."""
    raw = F.split(formatted_text, F.lit(r"\Q" + CLOSE + r"\E"), -1)
    bodies = F.slice(raw, F.lit(1), F.size(raw) - 1)

    def turn(body: Column) -> Column:
        halves = F.split(F.substring(body, len(OPEN) + 1, 2_147_483_647), F.lit(r"\Q" + BODY + r"\E"), 2)
        return F.struct(unescaped(halves[0]).alias("role"), unescaped(halves[1]).alias("text"))

    return F.transform(bodies, turn)


def learned(segments: Column) -> Column:
    """All text under the loss, as it was before escaping."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescaped(s["text"])), "")
