"""Chat formatting by a finite-state machine over roles, in DataFrame functions only.

A template names the control strings, the transitions between roles, and the roles that are trained on.
Every conversation becomes an ordered list of segments, each with a loss flag; joined, they are the
formatted text. Control strings inside roles and texts are escaped and can be read back.

Rows of a conversation are ordered by turn, then role, then text; nulls come first. Null texts are
empty texts, null roles empty roles. Null conversation ids form one conversation. Invalid orders of turns
are formatted all the same, and reported. Extra columns are not read; no rows give no conversations.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``start`` role ``after_role`` text ``end`` ``after_turn``. ``moves``: state, role, next state."""

    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>"
    after_turn: str = "\n"
    trained: tuple[str, ...] = ("assistant",)
    begin: str = "begin"
    final: tuple[str, ...] = ("answered",)
    moves: tuple[tuple[str, str, str], ...] = field(
        default=(
            ("begin", "system", "briefed"),
            ("begin", "user", "asked"),
            ("briefed", "user", "asked"),
            ("asked", "assistant", "answered"),
            ("asked", "tool", "asked"),
            ("answered", "user", "asked"),
            ("answered", "tool", "asked"),
        )
    )


CHATML = Template()


def escape(text: Column) -> Column:
    r"""``\`` becomes ``\\``, ``<|`` becomes ``<\|``: no control string is left."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(role, r"\\\\", -1), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|")))
    return F.array_join(parts, "\\")


def conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id and its turns in order. A conversation is one output text, so its rows meet in one task."""
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    return rows.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))


def format_chat(rows: DataFrame, template: Template = CHATML, **columns) -> DataFrame:
    """conv_id, segments (text, loss), formatted, valid, first_bad (index of the first turn out of order)."""
    t = template
    table = F.create_map(*[F.lit(x) for state, role, to in t.moves for x in (f"{state}\n{role}", to)])

    def move(state: Column, one: Column) -> Column:
        to = F.try_element_at(table, F.concat_ws("\n", state["state"], one["role"]))
        bad = F.when((state["bad"] < 0) & to.isNull(), state["n"]).otherwise(state["bad"])
        return F.struct(F.coalesce(to, state["state"]).alias("state"), bad.alias("bad"), (state["n"] + 1).alias("n"))

    begin = F.struct(F.lit(t.begin).alias("state"), F.lit(-1).alias("bad"), F.lit(0).alias("n"))
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda one: F.array(
                piece(F.concat(F.lit(t.start), escape_role(one["role"]), F.lit(t.after_role)), F.lit(False)),
                piece(escape(one["text"]), one["role"].isin(*t.trained)),
                piece(F.lit(t.end + t.after_turn), F.lit(False)),
            ),
        )
    )
    end = F.aggregate("turns", begin, move)
    return (
        conversations(rows, **columns)
        .withColumn("end", end)
        .withColumn("segments", segments)
        .select(
            "conv_id",
            "segments",
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
            ((F.col("end.bad") < 0) & F.col("end.state").isin(*t.final)).alias("valid"),
            F.col("end.bad").alias("first_bad"),
        )
    )


def read_back(formatted: Column, template: Template = CHATML) -> Column:
    """Turns (role, text) parsed from a formatted text."""
    t = template
    parts = F.split(formatted, f"\\Q{t.start}\\E", -1)
    bodies = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

    def one(body: Column) -> Column:
        inner = F.left(body, F.length(body) - F.lit(len(t.end + t.after_turn)))
        cut = F.instr(inner, F.lit(t.after_role))
        return F.struct(
            unescape_role(F.left(inner, cut - 1)).alias("role"),
            unescape(F.substring(inner, cut + F.lit(len(t.after_role)), F.length(inner))).alias("text"),
        )

    return F.transform(bodies, one)
