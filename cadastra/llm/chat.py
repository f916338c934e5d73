"""Chat formatting by a state machine over roles, in DataFrame functions only.

A template is plain data: the control strings around a turn, which roles may
follow which state, and in which states the text is learned from.  The state a
turn leads to is its role, in order or not (the machine goes on from there), so
each transition needs the state before it only and a conversation of any length
is run in one pass over its turns.  The states decide the loss flags of the text
segments; the first transition that is not allowed is noted.  Control strings
inside texts are escaped in a way that can be undone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Template:
    """``before`` and ``after`` surround a turn, ``{role}`` names its role; ``follows`` maps a state to allowed roles."""

    before: str = START + "{role}\n"
    after: str = END + "\n"
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", "tool"),
            "tool": ("assistant", "tool"),
        }
    )
    last: tuple[str, ...] = ("assistant",)
    learned: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escape(text: Column) -> Column:
    """No ``<|`` remains: a backslash goes between, one more where some are there already."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role stays on one line."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def format_chats(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation of ``conv_id, turn, role, text``.

    ``formatted`` is the whole text, ``segments`` its parts in order with
    their ``loss`` flag (their texts joined are ``formatted``), ``valid`` says
    whether the state machine accepts the order of roles, ``bad_turn`` is the
    place of the first turn out of order, ``n_turns`` their number.

    Turns stand by ``turn``; nulls first, ties by role, then text, and
    repeated rows stay repeated.  A null text or role is empty, a null
    ``conv_id`` is a conversation of its own, other columns are ignored, and
    an empty table gives no rows.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    allowed = F.create_map(*(
        x for state, roles in template.follows.items() for x in (F.lit(state), F.array(*map(F.lit, roles)))
    ))

    def transition(before: Column, t: Column) -> Column:
        fits = F.coalesce(F.array_contains(F.try_element_at(allowed, before), t["role"]), F.lit(False))
        return F.struct(t["role"].alias("state"), fits.alias("fits"), t["text"].alias("text"))

    befores = F.concat(F.array(F.lit("")), F.slice(F.transform("turns", lambda t: t["role"]), F.lit(1), F.size("turns") - 1))
    ran = chats.select("conv_id", F.zip_with(befores, "turns", transition).alias("states"))
    bad = F.array_position(F.transform("states", lambda s: s["fits"]), F.lit(False)).cast("int")
    head, tail = (F.lit(x) for x in template.before.split("{role}"))

    def segments(s: Column) -> Column:
        return F.array(
            F.struct(F.concat(head, escape_role(s["state"]), tail).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(s["text"]).alias("text"), s["state"].isin(*template.learned).alias("loss")),
            F.struct(F.lit(template.after).alias("text"), F.lit(False).alias("loss")),
        )

    parts = ran.select(
        "conv_id", F.size("states").cast("long").alias("n_turns"), F.nullif(bad, F.lit(0)).alias("bad"),
        F.element_at("states", -1)["state"].alias("last"),
        F.flatten(F.transform("states", segments)).alias("segments"),
    )
    return parts.select(
        "conv_id",
        "n_turns",
        (F.col("bad").isNull() & F.col("last").isin(*template.last)).alias("valid"),
        (F.col("bad") - 1).alias("bad_turn"),
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
    )


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """The ``role, text`` turns of a formatted text: the template undone, texts unescaped."""
    head, tail = template.before.split("{role}")
    chunks = F.filter(F.split(formatted, _literal(template.after), -1), lambda c: F.length(c) > 0)

    def turn(chunk: Column) -> Column:
        inner = F.substring(chunk, F.lit(len(head) + 1), F.length(chunk))
        at = F.instr(inner, tail)
        role = F.substring(inner, F.lit(1), at - 1)
        return F.struct(
            unescape_role(role).alias("role"),
            unescape(F.substring(inner, at + len(tail), F.length(inner))).alias("text"),
        )

    return F.transform(chunks, turn)


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() else f"\\x{ord(c):02x}" for c in text)
