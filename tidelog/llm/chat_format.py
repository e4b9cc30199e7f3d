"""Chat formatting: a role state machine checks turn order, a declarative template lays out the text.

Everything here is DataFrame functions. Groups are single conversations; one conversation is one output row,
so its turns must meet in one task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import with_free_names


@dataclass(frozen=True)
class Turn:
    """open + text + close; loss: whether the text is trained on."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    """Marks per role, and the allowed moves of the role machine.

    Roles without marks of their own are written as other.open + role + naming + text + other.close.
    Every mark is one of the characters in heads followed by a body without heads and backslashes, so that
    putting a backslash behind a mark's first character defuses it, and taking one away restores it.
    """

    roles: dict[str, Turn] = field(default_factory=lambda: {"system": Turn("[SYS]", "[/SYS]"), "user": Turn("[INST]", "[/INST]"), "assistant": Turn("<s>", "</s>", True), "tool": Turn("[TOOL]", "[/TOOL]")})
    other: Turn = Turn("[TURN]", "[/TURN]")
    naming: str = "[AS]"
    moves: dict[str, dict[str, str]] = field(default_factory=lambda: {"start": {"system": "system", "user": "user"}, "system": {"user": "user"}, "user": {"assistant": "assistant"}, "assistant": {"user": "user", "tool": "tool"}, "tool": {"assistant": "assistant", "tool": "tool"}})
    accepting: tuple[str, ...] = ("assistant",)
    heads: str = "<["

    def __post_init__(self) -> None:
        marks = self.marks()
        if len(set(marks)) != len(marks) or any(m[0] not in self.heads or len(m) < 2 or set(m[1:]) & set(self.heads + "\\") for m in marks):
            raise ValueError("marks must be distinct, begin with a head and hold no other head or backslash")

    def marks(self) -> list[str]:
        return [m for t in [*self.roles.values(), self.other] for m in (t.open, t.close)] + [self.naming]

    def escape(self, text: Column) -> Column:
        by_head = "|".join(f"{re.escape(h)}(?=\\\\*(?:{'|'.join(re.escape(m[1:]) for m in self.marks() if m[0] == h)}))" for h in self.heads)
        return F.regexp_replace(text, f"({by_head})", r"$1\\")

    def unescape(self, text: Column) -> Column:
        by_head = "|".join(f"(?<={re.escape(h)})\\\\(?=\\\\*(?:{'|'.join(re.escape(m[1:]) for m in self.marks() if m[0] == h)}))" for h in self.heads)
        return F.regexp_replace(text, by_head, "")


def format_chats(conversations: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments (text, loss), valid, first_bad_turn.

    conversations needs conv_id, turn, role, text; other columns are ignored. Turns go by turn number; ties and
    repeated rows stay, ordered by role and text; null turn numbers come first, a null role or text counts as
    empty, and rows without conv_id form one conversation. valid: the machine accepts the roles; first_bad_turn:
    position of the first move it forbids, else null. No turn is dropped either way. Empty input: no rows.
    """
    t = template or ChatTemplate()
    df = with_free_names(conversations, ["conv_id", "turn", "role", "text"])
    df = df.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    df = df.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def by_role(role: Column, pick) -> Column:
        out = F.lit(pick(t.other))
        for name, turn in t.roles.items():
            out = F.when(role == name, F.lit(pick(turn))).otherwise(out)
        return out

    def pieces(x: Column) -> Column:
        known = x["role"].isin(*t.roles)
        opened = F.when(known, by_role(x["role"], lambda r: r.open)).otherwise(F.concat(F.lit(t.other.open), t.escape(x["role"]), F.lit(t.naming)))
        none = F.lit(False)
        return F.array(
            F.struct(opened.alias("text"), none.alias("loss")),
            F.struct(t.escape(x["text"]).alias("text"), by_role(x["role"], lambda r: r.loss).alias("loss")),
            F.struct(by_role(x["role"], lambda r: r.close).alias("text"), none.alias("loss")),
        )

    moves = F.create_map(*[F.lit(v) for s, to in t.moves.items() for role, end in to.items() for v in (f"{s}\n{role}", end)])
    begin = F.struct(F.lit("start").alias("state"), F.lit(0).alias("seen"), F.lit(None).cast("int").alias("bad"))

    def move(s: Column, x: Column) -> Column:
        to = F.try_element_at(moves, F.concat(s["state"], F.lit("\n"), x["role"]))
        return F.struct(F.coalesce(to, F.lit("refused")).alias("state"), (s["seen"] + 1).alias("seen"), F.when(s["bad"].isNull() & to.isNull(), s["seen"]).otherwise(s["bad"]).alias("bad"))

    df = df.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("segments"), F.aggregate("turns", begin, move).alias("end"))
    return df.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        F.col("end.state").isin(*t.accepting).alias("valid"),
        F.col("end.bad").alias("first_bad_turn"),
    )


def read_turns(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """Array of (role, text) found in a formatted conversation."""
    t = template or ChatTemplate()
    every = [*t.roles.values(), t.other]
    found = F.regexp_extract_all(formatted, F.lit("(?s)" + "|".join(f"{re.escape(x.open)}.*?{re.escape(x.close)}" for x in every)), F.lit(0))

    def read(x: Column) -> Column:
        inner = lambda turn: F.substring(x, F.lit(len(turn.open) + 1), F.length(x) - len(turn.open) - len(turn.close))
        body = inner(t.other)
        out = F.struct(t.unescape(F.substring_index(body, t.naming, 1)).alias("role"), t.unescape(F.substring(body, F.instr(body, t.naming) + len(t.naming), F.length(body))).alias("text"))
        for name, turn in t.roles.items():
            out = F.when(x.startswith(turn.open), F.struct(F.lit(name).alias("role"), t.unescape(inner(turn)).alias("text"))).otherwise(out)
        return out

    return F.transform(found, read)


def loss_text(segments: Column, template: ChatTemplate | None = None) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    t = template or ChatTemplate()
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: t.unescape(s["text"])), "")
