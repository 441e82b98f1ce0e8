"""Conversations of any known layout as canonical turns, and as templated text with a loss mask."""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The template: "### Label: text</turn>\n". Inside texts its control strings are broken up reversibly.
OPENING, CLOSING = "### ", "</turn>\n"
LABELS = {"user": "User", "assistant": "Assistant", "system": "System"}
# Names that layouts use for the canonical roles.
ALIASES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """How one layout maps to turns: fixed (role, path) pairs, a list of messages, or one row per turn."""

    name: str
    paths: tuple[str, ...]
    fixed: tuple[tuple[str, str], ...] = ()
    messages: tuple[str, str, str] | None = None  # list, role and text fields
    rows: tuple[str, str, str, str] | None = None  # conversation, place, role and text columns


LAYOUTS = (
    Layout("turn_rows", ("role", "text", "turn"), rows=("conv_id", "turn", "role", "text")),
    Layout("messages", ("messages[].content", "messages[].role"), messages=("messages", "role", "content")),
    Layout("from_value", ("conversations[].from", "conversations[].value"), messages=("conversations", "from", "value")),
    Layout("prompt_completion", ("completion", "prompt"), fixed=(("user", "prompt"), ("assistant", "completion"))),
    Layout("prompt_response", ("prompt", "response"), fixed=(("user", "prompt"), ("assistant", "response"))),
    Layout("question_answer", ("answer", "question"), fixed=(("user", "question"), ("assistant", "answer"))),
    Layout("instruction", ("instruction", "output"), fixed=(("user", "instruction"), ("assistant", "output"))),
    Layout(
        "instruction_input",
        ("input", "instruction", "output"),
        fixed=(("user", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    Layout(
        "system_prompt",
        ("prompt", "response", "system"),
        fixed=(("system", "system"), ("user", "prompt"), ("assistant", "response")),
    ),
)
_KNOWN = sorted({p for layout in LAYOUTS for p in layout.paths})


def fingerprint(paths) -> str:
    """The hash that names a layout: of the known nested field paths that are present, in order."""
    return sha256(",".join(sorted(set(paths) & set(_KNOWN))).encode()).hexdigest()


_BY_PRINT = {fingerprint(layout.paths): layout for layout in LAYOUTS}


def field_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema; a list adds ``[]``."""
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, f"{prefix}[]")
    return [prefix]


def layout_of(df: DataFrame) -> Layout:
    """The layout of a table by the fingerprint of its schema; columns that no layout knows are ignored."""
    found = _BY_PRINT.get(fingerprint(field_paths(df.schema)))
    if found is None:
        raise ValueError(f"no mapping for a table with the columns {df.columns}")
    return found


def _role(role: Column) -> Column:
    known = F.lower(role)
    for alias, name in ALIASES.items():
        known = F.when(known == alias, F.lit(name)).otherwise(known)
    return F.coalesce(F.when(known.isin(*LABELS), known).otherwise(role), F.lit(""))


def canonical_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv_id, turn, role, text) rows of a table in any known layout, chosen by its fingerprint.

    In tables of turn rows, roles and texts stay as they are, but null becomes empty. Elsewhere roles
    are known by their aliases in any case, and missing or null texts and null messages make no turn.
    """
    layout = layout_of(df)
    if layout.rows:
        conv, turn, role, text = (F.col(f"`{c}`") for c in layout.rows)
        return df.select(
            conv.alias("conv_id"),
            turn.cast("long").alias("turn"),
            F.coalesce(role.cast("string"), F.lit("")).alias("role"),
            F.coalesce(text.cast("string"), F.lit("")).alias("text"),
        )
    if layout.messages:
        field, role, text = layout.messages
        turns = F.transform(
            F.col(f"`{field}`"),
            lambda m, i: F.struct(i.cast("long").alias("turn"), m[role].alias("role"), m[text].alias("text")),
        )
    else:
        turns = F.array(
            *(
                F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.col(f"`{p}`").alias("text"))
                for i, (r, p) in enumerate(layout.fixed)
            )
        )
    return _exploded(df.select(F.col(f"`{id_col}`").alias("conv_id"), F.explode(turns).alias("t")))


def _message(role: str, text: str):
    return lambda m: F.struct(m[role].alias("role"), m[text].alias("text"))


def canonical_json(df: DataFrame, id_col: str, json_col: str) -> tuple[DataFrame, DataFrame]:
    """Turns of JSON records whose layouts differ row by row, and the ids of records without a mapping.

    The known paths present in a record are hashed per row; the fingerprint picks the mapping.
    """
    record = F.try_parse_json(json_col)
    found = df.select(F.col(f"`{id_col}`").alias("conv_id"), record.alias("v"))
    here = [
        F.when(F.try_variant_get("v", "$." + p.replace("[]", "[0]"), "variant").isNotNull(), F.lit(p)) for p in _KNOWN
    ]
    found = found.withColumn("print", F.sha2(F.array_join(F.array_compact(F.array(*here)), ","), 256))
    kind = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("role", "text")]))
    turns = F.lit(None).cast(kind)
    for key, layout in _BY_PRINT.items():
        if layout.rows:
            continue
        if layout.messages:
            field, role, text = layout.messages
            items = F.try_variant_get("v", f"$.{field}", f"array<struct<`{role}`:string,`{text}`:string>>")
            made = F.transform(items, _message(role, text))
        else:
            made = F.array(
                *(
                    F.struct(F.lit(r).alias("role"), F.try_variant_get("v", f"$.{p}", "string").alias("text"))
                    for r, p in layout.fixed
                )
            )
        turns = F.when(F.col("print") == key, made).otherwise(turns)
    found = found.select("conv_id", turns.alias("turns"))
    listed = found.select("conv_id", F.posexplode("turns").alias("turn", "m"))
    rows = listed.select("conv_id", F.struct(F.col("turn").cast("long").alias("turn"), "m.role", "m.text").alias("t"))
    return _exploded(rows), found.filter("turns is null").select("conv_id")


def _exploded(rows: DataFrame) -> DataFrame:
    kept = rows.filter("t is not null and t.text is not null")
    return kept.select("conv_id", "t.turn", _role(F.col("t.role")).alias("role"), "t.text")


def escape(text: Column) -> Column:
    """Break up the template's control strings: no result holds ``##`` or ``</turn>``."""
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    text = F.replace(text, F.lit("##"), F.lit("#\\h"))
    return F.replace(text, F.lit("</turn>"), F.lit("\\l/turn>"))


def unescape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\l"), F.lit("<"))
    text = F.replace(text, F.lit("\\h"), F.lit("#"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def format_chats(turns: DataFrame, learned: str = "assistant") -> DataFrame:
    """Per conversation: conv_id, formatted, and the loss mask as (turn, start, end) in code points.

    Turns are ordered by place, then role and text; repeated rows stay. A role outside the known ones is
    written escaped behind ``=``. ``start`` and ``end`` count from the start of that turn's piece of
    ``formatted`` (pieces end with the closing mark), so a reader needs no second pass. A conversation
    is one row: its text must fit in a task, however many conversations there are.
    """
    label = F.concat(F.lit("="), F.replace(escape("role"), F.lit(": "), F.lit("\\c")))
    for role, name in LABELS.items():
        label = F.when(F.col("role") == role, F.lit(name)).otherwise(label)
    head = F.concat(F.lit(OPENING), label, F.lit(": "))
    body = escape("text")
    pieces = turns.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.concat(head, body, F.lit(CLOSING)).alias("piece"),
        F.when(F.col("role") == learned, F.length(head)).cast("long").alias("start"),
        F.when(F.col("role") == learned, F.length(head) + F.length(body)).cast("long").alias("end"),
    )
    grouped = pieces.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "piece", "start", "end"))).alias("all")
    )
    spans = F.transform("all", lambda p, i: F.struct(i.cast("long").alias("turn"), p["start"].alias("start"), p["end"].alias("end")))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("all", lambda p: p["piece"]), "").alias("formatted"),
        F.filter(spans, lambda s: s["start"].isNotNull()).alias("loss"),
    )


def read_chats(chats: DataFrame) -> DataFrame:
    """Read formatted conversations back: conv_id, turns (role, text), and the unescaped text under the mask."""
    pieces = F.split("formatted", F.lit(r"\Q" + CLOSING + r"\E"))
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    cut = chats.select("conv_id", "formatted", "loss", pieces.alias("pieces"))

    def turn(piece: Column) -> Column:
        at = F.locate(": ", piece)
        label = F.substring(piece, F.lit(len(OPENING) + 1), at - len(OPENING) - 1)
        role = unescape(F.replace(F.substring(label, F.lit(2), F.length(label)), F.lit("\\c"), F.lit(": ")))
        for name, shown in LABELS.items():
            role = F.when(label == shown, F.lit(name)).otherwise(role)
        text = unescape(F.substring(piece, at + 2, F.length(piece)))
        return F.struct(role.alias("role"), text.alias("text"))

    under = F.transform(
        "loss",
        lambda s: unescape(
            F.substring(F.element_at(F.col("pieces"), (s["turn"] + 1).cast("int")), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        ),
    )
    return cut.select(
        "conv_id", "formatted", F.transform("pieces", turn).alias("turns"), F.array_join(under, "").alias("learned")
    )


def digests(chats: DataFrame) -> DataFrame:
    """What a reader gets from formatted conversations, as counts and digests."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_chats(chats).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
