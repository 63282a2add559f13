"""Chat formatting by schema fingerprint (DataFrame operations only).

The sorted nested field paths of a record layout are hashed; the hash selects a
declarative mapping that turns the record into canonical turns
``array<struct<role, text>>``.  Tables of typed records are matched once, by
their schema; columns of JSON records are matched row by row, by the schema
their parsed value has.  The template then writes

    <|im_start|>role\\n text <|im_end|>\\n

with ``\\`` and the ``|`` of every ``<|`` inside roles and texts escaped by a
backslash, so no control string can come from a text and unescaping gives back
every character.  The loss mask is a list of byte spans, one per assistant turn.

Defined cases: null roles and texts are empty; turns are ordered by turn, role
and text (null turns first), repeated rows are turns of their own; a record of
an unknown layout has null turns and no output text; an empty table gives an
empty result; columns that no mapping names are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage

START, END = "<|im_start|>", "<|im_end|>"

#: Layout name -> (nested field paths, mapping).  A mapping is either the list of turns to take from plain
#: fields, as (role, field), or the array to walk with its role and text fields.
LAYOUTS: dict[str, tuple[tuple[str, ...], dict]] = {
    "turn_rows": (("messages[].role", "messages[].text", "messages[].turn"),
                  {"array": "messages", "role": "role", "text": "text"}),
    "messages": (("messages[].content", "messages[].role"), {"array": "messages", "role": "role", "text": "content"}),
    "from_value": (("conversations[].from", "conversations[].value"),
                   {"array": "conversations", "role": "from", "text": "value"}),
    "prompt_response": (("prompt", "response"), {"fields": [("user", "prompt"), ("assistant", "response")]}),
    "prompt_completion": (("completion", "prompt"), {"fields": [("user", "prompt"), ("assistant", "completion")]}),
    "instruction_output": (("instruction", "output"),
                           {"fields": [("user", "instruction"), ("assistant", "output")]}),
    "instruction_input_output": (("input", "instruction", "output"),
                                 {"fields": [("system", "instruction"), ("user", "input"), ("assistant", "output")]}),
}
#: Role names of other layouts and what they are called here.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


FINGERPRINTS = {fingerprint(paths): name for name, (paths, _) in LAYOUTS.items()}


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a type; ``[]`` marks an array's element."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def _type_of(name: str) -> str:
    paths, how = LAYOUTS[name]
    if "array" in how:
        return f"{how['array']} array<struct<{', '.join(f'`{p.split('.')[1]}`: string' for p in paths)}>>"
    return ", ".join(f"`{p}` string" for p in paths)


def _turns(name: str, record: Column) -> Column:
    how = LAYOUTS[name][1]
    if "array" in how:
        return F.transform(record[how["array"]], lambda m: _turn(m[how["role"]], m[how["text"]]))
    return F.array(*[_turn(F.lit(role), record[field]) for role, field in how["fields"]])


def _turn(role: Column, text: Column) -> Column:
    named = F.coalesce(role, F.lit(""))
    for other, ours in ROLE_NAMES.items():
        named = F.when(role == other, F.lit(ours)).otherwise(named)
    return F.struct(named.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def turns_of_records(df: DataFrame, record: str) -> DataFrame:
    """Add ``turns`` to a table whose column ``record`` is a struct; its schema selects the mapping."""
    name = FINGERPRINTS.get(fingerprint(field_paths(df.schema[record].dataType)))
    turns = _turns(name, F.col(record)) if name else F.lit(None).cast("array<struct<role: string, text: string>>")
    return df.withColumn("turns", turns)


def turns_of_json(df: DataFrame, record: str) -> DataFrame:
    """Add ``turns`` to a table whose column ``record`` is JSON text of any layout, row by row.

    The parsed value's schema is brought to the shape ``{a: [{b, c///`` (leaf types
    left out, every bracket closed by ``/``), hashed and compared with the hashes of the known layouts.
    """
    shape = F.schema_of_variant(F.try_parse_json(F.col(record)))
    for pattern, plain in ((r": (?!ARRAY|OBJECT)[A-Z]+(\([0-9,]*\))?", ""), (r"OBJECT<", "{"), (r"ARRAY<", "["),
                           (r">", "/")):
        shape = F.regexp_replace(shape, pattern, plain)
    mark, turns = F.sha2(shape, 256), F.lit(None).cast("array<struct<role: string, text: string>>")
    for name, (paths, how) in LAYOUTS.items():
        names = ", ".join(sorted(p.split(".")[-1] for p in paths))
        form = "{" + (f"{how['array']}: [{{{names}//" if "array" in how else names) + "/"
        value = F.from_json(F.col(record), _type_of(name))
        turns = F.when(mark == hashlib.sha256(form.encode()).hexdigest(), _turns(name, value)).otherwise(turns)
    return df.withColumn("turns", turns)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\|(?<=<)\|)", r"\\$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(role, r"(\\|\n|(?<=<)\|)", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(df: DataFrame) -> DataFrame:
    """Add ``formatted`` and ``loss_spans`` (byte start and length of each assistant text) from ``turns``.

    Columns of these two names are replaced; all others, whatever their names, stay.
    """
    mark = f"parts_{uuid.uuid4().hex}"
    parts = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == "assistant").alias("loss")))
    tail = f"{END}\n"
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,len:long>>").alias("spans"))

    def step(acc, p):
        start = acc["at"] + F.octet_length(p["head"])
        size = F.octet_length(p["body"]).cast("long")
        span = F.struct(start.cast("long").alias("start"), size.alias("len"))
        return F.struct((start + size + len(tail)).cast("long").alias("at"),
                        F.when(p["loss"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return (df.withColumn(mark, parts)
            .withColumn("formatted", F.array_join(F.transform(mark, lambda p: F.concat(p["head"], p["body"], F.lit(tail))), ""))
            .withColumn("loss_spans", F.aggregate(mark, zero, step, lambda acc: acc["spans"]))
            .drop(mark))


def stage_rendered(df: DataFrame) -> DataFrame:
    """Render ``turns`` into the output table (key columns, formatted, loss_spans) and read it back."""
    return stage(render(df).drop("turns"), "chat")


def parse(df: DataFrame) -> DataFrame:
    """Read ``formatted`` and ``loss_spans`` back: adds ``read_turns`` and ``loss_text``."""
    pieces = F.filter(F.split("formatted", r"\Q" + END + "\n" + r"\E"), lambda s: s != "")
    head = r"(?s)^\Q" + START + r"\E((?:[^\\\n]|\\.)*)\n"
    turns = F.transform(pieces, lambda s: F.struct(
        unescape(F.regexp_extract(s, head, 1)).alias("role"), unescape(F.regexp_replace(s, head, "")).alias("text")))
    raw = F.col("formatted").cast("binary")
    loss = F.transform("loss_spans", lambda s: unescape(
        F.substring(raw, (s["start"] + 1).cast("int"), s["len"].cast("int")).cast("string")))
    return df.withColumn("read_turns", turns).withColumn("loss_text", F.array_join(loss, ""))


def records_of_rows(rows: DataFrame) -> DataFrame:
    """One record {messages: [{turn, role, text}]} per conv_id from a table of turns.

    A conversation is one output row, so its turns have to meet; the lists are
    built in the scan tasks first and only merged after the shuffle.
    """
    return (rows.groupBy("conv_id")
            .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"))
            .select("conv_id", F.struct("messages").alias("record")))
