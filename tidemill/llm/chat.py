"""Chat formatting by schema fingerprints, in DataFrame functions alone."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
_TURNS = "array<struct<role:string,text:string>>"


def field_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths with their kinds: `messages[].role:string`."""
    if isinstance(schema, T.StructType):
        return sorted(p for f in schema for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name))
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, f"{prefix}[]")
    return [f"{prefix}:{'string' if isinstance(schema, T.StringType) else 'number' if isinstance(schema, T.NumericType) else schema.typeName()}"]


def fingerprint(paths: list[str]) -> str:
    """Names a layout whatever the order of its fields."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """A layout: the field paths it needs, and its turns. Per row, or one row per turn ordered by `order`."""

    name: str
    paths: tuple[str, ...]
    turns: Callable[[], Column]
    order: str | None = None


def _turn(role: str | Column, text: str | Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).alias("text"))


def _renamed(role: Column) -> Column:
    return F.when(role.isin("human", "Human"), "user").when(role.isin("gpt", "bot", "model"), "assistant").otherwise(role)


def _some(*turns: Column) -> Column:
    """The turns given, without leading ones whose text is empty."""
    return F.filter(F.array(*turns), lambda t: (t.role != "system") | (t.text != ""))


#: Declarative mappings by layout.
MAPPINGS = (
    Mapping("turn rows", ("role:string", "text:string", "turn:number"), lambda: F.array(_turn(F.col("role"), "text")), "turn"),
    Mapping("prompt and response", ("prompt:string", "response:string"), lambda: _some(_turn("user", "prompt"), _turn("assistant", "response"))),
    Mapping("prompt and completion", ("completion:string", "prompt:string"), lambda: _some(_turn("user", "prompt"), _turn("assistant", "completion"))),
    Mapping("question and answer", ("answer:string", "question:string"), lambda: _some(_turn("user", "question"), _turn("assistant", "answer"))),
    Mapping("instruction", ("instruction:string", "output:string"), lambda: _some(_turn("user", "instruction"), _turn("assistant", "output"))),
    Mapping("instruction with input", ("input:string", "instruction:string", "output:string"), lambda: _some(_turn("user", F.concat_ws("\n\n", F.nullif("instruction", F.lit("")), F.nullif("input", F.lit("")))), _turn("assistant", "output"))),
    Mapping("messages", ("messages[].content:string", "messages[].role:string"), lambda: F.transform("messages", lambda m: _turn(_renamed(m.role), m.content))),
    Mapping("conversations", ("conversations[].from:string", "conversations[].value:string"), lambda: F.transform("conversations", lambda m: _turn(_renamed(m["from"]), m.value))),
    Mapping("system and messages", ("messages[].content:string", "messages[].role:string", "system:string"), lambda: F.concat(_some(_turn("system", "system")), F.transform("messages", lambda m: _turn(_renamed(m.role), m.content)))),
)
_BY_PRINT = {fingerprint(list(m.paths)): m for m in MAPPINGS}


def mapping_of(df: DataFrame, conv_id: str = "conv_id") -> Mapping:
    """The mapping whose fingerprint the table's fields have; of several that fit, the one that needs most fields.

    Fields that no mapping knows are left out of the fingerprint first, so further columns do no harm.
    """
    known = {p for m in MAPPINGS for p in m.paths}
    paths = [p for p in field_paths(df.schema) if p in known and not p.startswith(f"{conv_id}:")]
    if m := _BY_PRINT.get(fingerprint(paths)):
        return m
    fit = [m for m in MAPPINGS if set(m.paths) <= set(paths)]
    if not fit:
        raise ValueError(f"no mapping for the layout {paths}")
    return max(fit, key=lambda m: len(m.paths))


def canonical_turns(df: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(conv_id, turns array<struct<role,text>>) of a table in any layout that has a mapping.

    Null roles and texts are empty. Turn rows are gathered by conv_id (rows with a null id are one conversation) and
    ordered by turn, then role and text, null turns first; a conversation is one row of the result, so its turns
    have to fit in one. In the other layouts a row is a conversation; a null list has no turns.
    """
    m = mapping_of(df, conv_id)
    if m.order is None:
        return df.select(F.col(conv_id).alias("conv_id"), F.coalesce(m.turns(), F.array().cast(_TURNS)).cast(_TURNS).alias("turns"))
    rows = df.select(F.col(conv_id).alias("conv_id"), F.col(m.order).alias("o"), F.element_at(m.turns(), 1).alias("t"))
    sort = F.array_sort(F.collect_list(F.struct(F.col("o").isNotNull().alias("has"), F.coalesce(F.col("o").cast("double"), F.lit(0.0)).alias("o"), F.col("t.role").alias("role"), F.col("t.text").alias("text"))))
    return rows.groupBy("conv_id").agg(sort.alias("s")).select("conv_id", F.transform("s", lambda x: F.struct(x.role.alias("role"), x.text.alias("text"))).cast(_TURNS).alias("turns"))


def json_turns(lines: DataFrame, column: str = "value", conv_id: str = "conv_id") -> DataFrame:
    """As canonical_turns, but each row is a JSON text with a layout of its own: (conv_id, layout, turns).

    A record is parsed into the union of all layouts; the field paths it fills, nested ones as well, are hashed and
    select the mapping: messages of which none has a content are no messages. Records that don't parse, or whose layout has no mapping, have a null layout and turns.
    """
    union = "prompt string, response string, completion string, question string, answer string, instruction string, input string, output string, system string, messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>"
    x = lines.withColumn("_r", F.from_json(column, union)).select(conv_id, "_r.*")

    def filled(path: str) -> Column:
        """Whether the record has a value there; in a list, whether any element has."""
        name = path.split(":")[0]
        if "[]." not in name:
            return F.col(name).isNotNull()
        items, field = name.split("[].")
        return F.coalesce(F.exists(items, lambda m: m[field].isNotNull()), F.lit(False))

    leaf = {p: filled(p) for m in MAPPINGS if m.order is None for p in m.paths}
    seen = F.array_compact(F.array(*(F.when(have, F.lit(p)) for p, have in sorted(leaf.items()))))
    x = x.withColumn("_fp", F.substring(F.sha2(F.array_join(seen, "\n"), 256), 1, 16))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    for m in MAPPINGS:
        if m.order is None:
            hit = F.col("_fp") == fingerprint(list(m.paths))
            layout, turns = F.when(hit, m.name).otherwise(layout), F.when(hit, m.turns().cast(_TURNS)).otherwise(turns)
    return x.select(conv_id, layout.alias("layout"), turns.alias("turns"))


def escape(text: Column) -> Column:
    """No `<|` is left: each `<`, backslashes, `|` gets one more backslash."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """As a text, and on one line."""
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def format_chat(turns: DataFrame) -> DataFrame:
    """From (conv_id, turns) to (conv_id, formatted, loss_mask): the template's text and the spans to train on.

    A turn is START, role, newline, text, END, newline, with control strings in role and text escaped reversibly.
    loss_mask lists (start, length), in code points of formatted, of the assistant's texts. No turns give ''.
    """
    x = turns.withColumn("_t", F.transform("turns", lambda t: F.struct(escape_role(t.role).alias("role"), escape(t.text).alias("text"))))
    part = F.transform("_t", lambda t: F.concat(F.lit(START), t.role, F.lit("\n"), t.text, F.lit(f"{END}\n")))
    head, tail = len(START) + 1, len(END) + 1
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + head + F.length(t.role)
        here = F.array(F.struct(start.alias("start"), F.length(t.text).alias("length")))
        spans = F.concat(acc["spans"], F.when(t.role == "assistant", here).otherwise(F.array().cast("array<struct<start:int,length:int>>")))
        return F.struct((start + F.length(t.text) + tail).cast("int").alias("at"), spans.cast("array<struct<start:int,length:int>>").alias("spans"))

    return x.select("conv_id", F.array_join(part, "").alias("formatted"), F.aggregate("_t", zero, step, lambda a: a["spans"]).alias("loss_mask"))


def parse_chat(formatted: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Read back: (conv_id, turns, loss_text, and what to keep) from (conv_id, formatted, loss_mask)."""
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, F.greatest(F.size(F.split("formatted", r"<\|im_start\|>")) - 1, F.lit(0)))

    def turn(p: Column) -> Column:
        body = F.substring(p, F.lit(1), F.length(p) - (len(END) + 1))
        cut = F.instr(body, "\n")
        return F.struct(unescape_role(F.substring(body, F.lit(1), cut - 1)).alias("role"), unescape(F.substring(body, cut + 1, F.length(body))).alias("text"))

    masked = F.transform("loss_mask", lambda s: unescape(F.substring(F.col("formatted"), s.start + 1, s.length)))
    return formatted.select("conv_id", F.transform(pieces, turn).cast(_TURNS).alias("turns"), F.array_join(masked, "").alias("loss_text"), *keep)
