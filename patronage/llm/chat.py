"""Chat formatting by schema fingerprint, in DataFrame functions only.

Records come in many layouts: rows by turn, lists of messages, prompt and response,
instruction and output. A layout is told by the hash of its nested field paths, and each
known hash selects a declarative mapping to canonical turns. Turns are rendered with markers;
marker-like strings inside texts are escaped so that the output can be read back exactly, and
a mask says which parts of the output carry loss.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
NEWLINE = "<|n|>"  # a line feed in the name of a role


@dataclass(frozen=True)
class Layout:
    """A declarative mapping. rows: the table has a row for each turn, `role` and `text` are
    its columns. list: `turns` is an array of messages with fields `role` and `text`.
    fields: each (role, column) that is not null is a turn, in this order."""

    kind: str
    paths: tuple[str, ...]
    turns: str = ""
    role: str = ""
    text: str = ""
    order: str = ""
    fields: tuple[tuple[str, str], ...] = ()
    names: dict[str, str] = field(default_factory=dict, hash=False)


# Known layouts: field paths without the id column, and where the turns are
LAYOUTS = (
    Layout("rows", ("role", "text", "turn"), role="role", text="text", order="turn"),
    Layout("list", ("messages[].content", "messages[].role"), turns="messages", role="role", text="content"),
    Layout("list", ("conversations[].from", "conversations[].value"), turns="conversations", role="from", text="value",
           names={"human": "user", "gpt": "assistant"}),
    Layout("fields", ("prompt", "response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Layout("fields", ("completion", "prompt"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout("fields", ("prompt", "response", "system"), fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("fields", ("instruction", "output"), fields=(("user", "instruction"), ("assistant", "output"))),
    Layout("fields", ("input", "instruction", "output"), fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
)


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Paths of all leaves; [] marks an array. Types and column order do not matter."""
    if isinstance(kind, T.StructType):
        return sorted(p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name))
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


KNOWN = {fingerprint(x.paths): x for x in LAYOUTS}


def layout_of(df: DataFrame, id_col: str) -> Layout:
    """The mapping for the table's field paths. Further columns are tried away: the known
    layout with the most paths among the table's is taken, if there is one."""
    paths = [p for p in field_paths(df.schema) if p != id_col]
    if (print_ := fingerprint(paths)) in KNOWN:
        return KNOWN[print_]
    inside = [x for x in LAYOUTS if set(x.paths) <= set(paths)]
    if not inside:
        raise ValueError(f"no mapping for the layout {print_}: {', '.join(paths)}")
    return max(inside, key=lambda x: len(x.paths))


def canonical(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv_id, turns array<struct<role, text>>), one row for each conversation.

    Null texts and roles are empty. Rows by turn are ordered by turn, then role, then text
    (null turns first); rows without a conversation id are conversations of one turn. In
    layouts with one row for each record the ids are kept as they are, and a null list is a
    conversation without turns. Empty tables give empty tables; further columns are ignored.
    """
    how = layout_of(df, id_col)
    conv = F.col(id_col).alias("conv_id")

    def named(role: Column) -> Column:
        out = F.coalesce(role, F.lit(""))
        for old, new in how.names.items():
            out = F.when(out == old, new).otherwise(out)
        return out

    def turn(role: Column, text: Column) -> Column:
        return F.struct(named(role).alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))

    if how.kind == "rows":
        rows = df.select(conv, F.col(how.order).alias("turn"), turn(F.col(how.role), F.col(how.text)).alias("t"))
        ordered = F.sort_array(F.collect_list(F.struct("turn", "t")))
        many = (rows.filter("conv_id is not null").groupBy("conv_id").agg(ordered.alias("x"))
                .select("conv_id", F.transform("x", lambda e: e["t"]).alias("turns")))
        return many.unionByName(rows.filter("conv_id is null").select("conv_id", F.array("t").alias("turns")))
    if how.kind == "list":
        turns = F.transform(how.turns, lambda e: turn(e[how.role], e[how.text]))
        return df.select(conv, F.coalesce(turns, F.array().cast("array<struct<role:string,text:string>>")).alias("turns"))
    given = F.array(*[F.when(F.col(c).isNotNull(), turn(F.lit(r), F.col(c))) for r, c in how.fields])
    return df.select(conv, F.filter(given, lambda t: t.isNotNull()).alias("turns"))


def escaped(text: Column) -> Column:
    """One more backslash between < and |, so that no marker remains."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, segments): segments are (text, loss) in order, and formatted is
    their texts joined. Assistant texts carry loss, markers and other roles do not."""
    def part(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def render(t: Column) -> Column:
        role = F.replace(escaped(t["role"]), F.lit("\n"), F.lit(NEWLINE))
        return F.array(part(F.concat(F.lit(START), role, F.lit("\n")), F.lit(False)),
                       part(escaped(t["text"]), t["role"] == LOSS_ROLE), part(F.lit(END + "\n"), F.lit(False)))

    cut = turns.select("conv_id", F.flatten(F.transform("turns", render)).alias("segments"))
    return cut.select("conv_id", F.array_join(F.col("segments")["text"], "").alias("formatted"), "segments")


def read_back(out: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted), parsed from the formatted text and the mask."""
    def parse(x: Column) -> Column:
        at = F.instr(x, "\n")
        role = F.replace(F.substring_index(x, "\n", 1), F.lit(NEWLINE), F.lit("\n"))
        text = F.substr(x, at + 1, F.length(x) - at - len(END) - 1)
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    pieces = F.filter(F.split("formatted", START.replace("|", r"\|"), -1), lambda x: x != "")
    under = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"]))
    return out.select("conv_id", F.transform(pieces, parse).alias("turns"), F.array_join(under, "").alias("loss_text"), "formatted")
