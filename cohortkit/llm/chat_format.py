"""Chat formatting with DataFrame functions only.

A template names the marks around a turn, the roles whose text is trained
on, and the allowed steps from role to role. A conversation's turns run
through that machine; out come text segments, each with a loss flag, whose
concatenation is the formatted conversation. Control strings inside texts
are replaced by short codes, so the marks never occur in a text and the
original can be read back exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import quoted


@dataclass(frozen=True)
class Template:
    """How conversations are written. ``open`` + role + ``close`` + text + ``end`` is a turn.

    ``steps`` lists the allowed (state, role) pairs; the state is the last
    role, at first ``start``. A valid conversation ends in one of ``final``.
    """

    open: str = "### "
    close: str = ": "
    end: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    steps: tuple[tuple[str, str], ...] = (("start", "system"), ("start", "user"), ("system", "user"),
                                          ("user", "assistant"), ("assistant", "user"))
    final: tuple[str, ...] = ("assistant",)
    #: Control strings and the codes that stand for them in a text; the escape sign comes first.
    escapes: tuple[tuple[str, str], ...] = field(default=(("\\", "\\0"), ("###", "\\1"), ("</turn>", "\\2"),
                                                          (": ", "\\3")))

    def escape(self, text: Column) -> Column:
        for plain, code in self.escapes:
            text = F.replace(text, F.lit(plain), F.lit(code))
        return text

    def unescape(self, text: Column) -> Column:
        for plain, code in reversed(self.escapes):
            text = F.replace(text, F.lit(code), F.lit(plain))
        return text


DEFAULT = Template()


def machine(turns: Column, template: Template) -> Column:
    """Struct of the last ``state`` and the position of the first turn out of order (``bad_turn``, from 0)."""
    allowed = F.array(*[F.lit(f"{state}\n{role}") for state, role in template.steps])
    first = F.struct(F.lit("start").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))

    def step(acc: Column, turn: Column) -> Column:
        good = F.array_contains(allowed, F.concat(acc["state"], F.lit("\n"), turn["role"]))
        return F.struct(turn["role"].alias("state"), (acc["at"] + 1).alias("at"),
                        F.coalesce(acc["bad"], F.when(~good, acc["at"])).alias("bad"))

    return F.aggregate(turns, first, step)


def segments(turns: Column, template: Template) -> Column:
    """Array of (text, loss): head, text and end of every turn."""
    no = F.lit(False).alias("loss")
    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.concat(F.lit(template.open), template.escape(t["role"]), F.lit(template.close)).alias("text"), no),
        F.struct(template.escape(t["text"]).alias("text"), t["role"].isin(*template.loss_roles).alias("loss")),
        F.struct(F.lit(template.end).alias("text"), no))))


def format_chats(rows: DataFrame, *, template: Template = DEFAULT, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``segments`` (text and loss flag,
    their texts joined are ``formatted``), ``n_turns``, ``valid`` and ``bad_turn``.

    Turns are ordered by number (NULL first), equal numbers by role, then
    text; repeated rows are turns of their own. NULL texts and roles count as
    empty. Conversations whose roles break the template's order, or end in
    another than a final state, are formatted all the same with ``valid``
    false and the position of the first bad turn (NULL if only the end is
    missing). Rows without a conversation id form one conversation. Other
    columns are not read. An empty table gives an empty result.
    """
    turn = F.struct(quoted(turn_col).alias("turn"), F.coalesce(quoted(role_col).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"))
    chats = (rows.select(quoted(conv_col).alias("conv_id"), turn.alias("turn"))
             .groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns")))
    run = chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       segments(F.col("turns"), template).alias("segments"),
                       machine(F.col("turns"), template).alias("run"))
    return run.select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments", "n_turns",
                      (F.col("run.bad").isNull() & F.col("run.state").isin(*template.final)).alias("valid"),
                      F.col("run.bad").alias("bad_turn"))


def read_back(formatted: Column, template: Template = DEFAULT) -> Column:
    """Array of (role, text) parsed from a formatted conversation."""
    parts = F.split(formatted, "\\Q" + template.end + "\\E")
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)  # nothing follows the last end

    def parse(part: Column) -> Column:
        close = F.instr(part, template.close)
        head = len(template.open)
        return F.struct(template.unescape(F.substring(part, F.lit(head + 1), close - F.lit(head + 1))).alias("role"),
                        template.unescape(F.substring(part, close + F.lit(len(template.close)),
                                                      F.length(part))).alias("text"))

    return F.transform(turns, parse)
