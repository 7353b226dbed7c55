"""Chat formatting with a finite-state machine over roles (native).

A template declares the control strings around a turn, which roles are trained on, and
from which state a role may follow. Its segments are the control strings and the texts of
the turns; only texts of trained roles carry the loss flag. Control strings inside a text
are escaped: every ``<|`` with any number of backslashes between its two characters gets one
backslash more, which reading back takes away again.

A conversation is one value of the result, so its turns are gathered in one row.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Template:
    """Control strings, trained roles, and the state machine.

    ``moves`` gives the next state by ``state role``; a role without a move leads to the
    state ``invalid``, which no role leaves. A conversation is valid if it ends in one of
    ``final``.
    """

    start: str = START
    after_role: str = "\n"
    end: str = END + "\n"
    trained: tuple[str, ...] = ("assistant",)
    moves: Mapping[str, str] = field(default_factory=lambda: {
        "begin system": "system", "begin user": "user", "system user": "user",
        "user assistant": "assistant", "assistant user": "user",
        "assistant tool": "tool", "tool assistant": "assistant",
    })
    final: tuple[str, ...] = ("user", "assistant")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def _escape_role(role: Column) -> Column:
    """A role must stay on one line."""
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def format_chats(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text", template: Template = Template()) -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments``, ``state``, ``valid``.

    ``segments`` is an array of ``(text, loss)`` in order. A null text or role is empty. Turns
    come by turn number, a null number first; equal numbers by role, then text; repeated rows
    are turns of their own. A null conversation is one of its own. An invalid order is marked and formatted
    all the same. Other columns are not read. No rows give no rows.
    """
    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    said = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), text_of(role).alias("role"), text_of(text).alias("text"))
        .alias("said"))
    chats = said.groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("said"))
    moves = F.create_map(*[F.lit(x) for move in template.moves.items() for x in move])
    state = F.aggregate(
        "said", F.lit("begin"),
        lambda s, t: F.coalesce(F.try_element_at(moves, F.concat(s, F.lit(" "), t["role"])), F.lit("invalid")))

    def segment(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    def of_turn(t: Column) -> Column:
        head = F.concat(F.lit(template.start), _escape_role(t["role"]), F.lit(template.after_role))
        return F.array(
            segment(head, F.lit(False)),
            segment(escape(t["text"]), t["role"].isin(*template.trained)),
            segment(F.lit(template.end), F.lit(False)))

    return chats.select(
        "conv_id", F.flatten(F.transform("said", of_turn)).alias("segments"), state.alias("state"),
    ).withColumn("valid", F.col("state").isin(*template.final))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_spans(segments: Column) -> Column:
    """``(start, length)`` in code points of the segments under the loss mask."""
    none = F.array().cast("array<struct<start:int,length:int>>")

    def step(acc: Column, s: Column) -> Column:
        n = F.char_length(s["text"])
        span = F.struct(acc["at"].alias("start"), n.alias("length"))
        return F.struct((acc["at"] + n).alias("at"),
                        F.when(s["loss"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(segments, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])


def read_turns(text: Column, template: Template = Template()) -> Column:
    """The ``(role, text)`` turns of a formatted conversation."""
    # Escaped texts hold no control string, so the pieces between starts are the turns.
    pieces = F.filter(F.split(text, _literal(template.start)), lambda _, i: i > 0)

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, template.after_role)
        body = F.substring(piece, cut + len(template.after_role), F.char_length(piece))
        return F.struct(
            _unescape_role(F.substring(piece, F.lit(1), cut - 1)).alias("role"),
            unescape(F.substring(body, F.lit(1), F.char_length(body) - len(template.end))).alias("text"))

    return F.transform(pieces, turn)


def _literal(control: str) -> str:
    return r"\Q" + control + r"\E"
