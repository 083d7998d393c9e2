"""Chat-data steps for conversations stored as one row per turn.

Same meaning as ``folioframe.functions.chat`` for arrays. A conversation is never collected:
neighbours and turn numbers come from ordered scans. Turn numbers start at 0 or above and are
unique in a conversation; they may have gaps.

Steps scan in segments of ``width`` turn numbers, whatever the size of a conversation, so one
conversation may hold any share of the rows. ``width`` never changes a result. Turns without a
conversation id form one conversation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions.chat import ChatTemplate, standard_role, turn_prefix, turn_text
from folioframe.operators.ordered import WIDTH, by_width, scan_groups


@dataclass(frozen=True)
class TurnColumns:
    """Names of the conversation id, turn number, role and content columns."""

    conversation: str = "conv_id"
    turn: str = "turn"
    role: str = "role"
    content: str = "text"

    @property
    def all(self) -> list[str]:
        return [self.conversation, self.turn, self.role, self.content]


COLUMNS = TurnColumns()


def _scan(turns: DataFrame, c: TurnColumns, width: int, **wanted) -> DataFrame:
    return scan_groups(by_width(turns, c.turn, width), [c.conversation], [c.turn], **wanted)


def _row(c: TurnColumns, turn: Column, role: Column, content: Column) -> Column:
    return F.struct(turn.cast("bigint").alias(c.turn), role.alias(c.role), content.alias(c.content))


def standardize_roles(turns: DataFrame, c: TurnColumns = COLUMNS) -> DataFrame:
    return turns.withColumn(c.role, standard_role(c.role))


def mark_orphans(
    turns: DataFrame, c: TurnColumns = COLUMNS, width: int = WIDTH
) -> DataFrame:
    """Add ``is_orphan``: a user turn whose next turn is absent or not the assistant's."""
    seen = _scan(turns, c, width, following={"_next_role": c.role})
    answered = F.coalesce(F.col("_next_role"), F.lit("")) == "assistant"
    return seen.withColumn("is_orphan", (F.col(c.role) == "user") & ~answered).drop("_next_role")


def repair_turns(
    turns: DataFrame, c: TurnColumns = COLUMNS, width: int = WIDTH
) -> DataFrame:
    """Insert an empty assistant turn after each orphan user turn; turns are numbered anew."""
    marked = mark_orphans(turns.select(*c.all), c, width)
    size = F.lit(1) + F.col("is_orphan").cast("int")
    counted = _scan(marked, c, width, totals={"_last": size})
    own = _row(c, F.col("_last") - size, F.col(c.role), F.col(c.content))
    added = _row(c, F.col("_last") - 1, F.lit("assistant"), F.lit(""))
    rows = F.when(F.col("is_orphan"), F.array(own, added)).otherwise(F.array(own))
    return counted.select(c.conversation, F.inline(rows))


def replace_system(
    turns: DataFrame, system: str, c: TurnColumns = COLUMNS, width: int = WIDTH
) -> DataFrame:
    """System prompt as turn 0 of every conversation, then its user and assistant turns."""
    kept = F.coalesce(F.col(c.role).isin("user", "assistant"), F.lit(False))
    seen = _scan(turns.select(*c.all), c, width, totals={"_n": F.lit(1), "_kept": kept.cast("int")})
    opening = F.when(F.col("_n") == 1, _row(c, F.lit(0), F.lit("system"), F.lit(system)))
    own = F.when(kept, _row(c, F.col("_kept"), F.col(c.role), F.col(c.content)))
    return seen.select(c.conversation, F.inline(F.array_compact(F.array(opening, own))))


def insert_system(
    turns: DataFrame, system: str, c: TurnColumns = COLUMNS, width: int = WIDTH
) -> DataFrame:
    """System prompt as turn 0 of the conversations that do not start with a system turn."""
    seen = _scan(turns.select(*c.all), c, width, totals={"_n": F.lit(1)}, first={"_first": c.role})
    lacking = F.coalesce(F.col("_first"), F.lit("")) != "system"
    own = _row(c, F.col("_n") - 1 + lacking.cast("int"), F.col(c.role), F.col(c.content))
    opening = F.when((F.col("_n") == 1) & lacking, _row(c, F.lit(0), F.lit("system"), F.lit(system)))
    return seen.select(c.conversation, F.inline(F.array_compact(F.array(opening, own))))


def rendered_turns(
    turns: DataFrame, template: ChatTemplate, add_generation_prompt: bool = False,
    c: TurnColumns = COLUMNS, width: int = WIDTH,
) -> DataFrame:
    """``(conversation, turn, role, piece, start, end, is_target)`` per turn.

    ``piece`` is the turn's share of the rendered text; ``start`` and ``end`` are the span of
    its content there. Only assistant content is a training target. The template's default
    system turn is expected to be in place already.
    """
    text = turn_text(template, F.col(c.role), F.col(c.content))
    pieces = turns.select(*c.all).withColumn("piece", text)
    seen = _scan(
        pieces, c, width,
        totals={"_n": F.lit(1), "_chars": F.length("piece").cast("bigint")},
    )
    start = (
        F.lit(len(template.bos)) + F.col("_chars") - F.length("piece")
        + F.length(turn_prefix(template, F.col(c.role)))
    )
    end = F.lit(len(template.bos)) + F.col("_chars") - len(template.suffix)
    opening = F.when(F.col("_n") == 1, F.lit(template.bos)).otherwise(F.lit(""))
    closing = F.when(F.col("_n") == F.col("_n_all"), F.lit(template.generation)).otherwise(F.lit(""))
    tail = closing if add_generation_prompt else F.lit("")
    return seen.select(
        c.conversation,
        (F.col("_n") - 1).alias(c.turn),
        c.role,
        F.concat(opening, F.col("piece"), tail).alias("piece"),
        start.cast("bigint").alias("start"),
        end.cast("bigint").alias("end"),
        (F.col(c.role) == "assistant").alias("is_target"),
    )


def render_conversations(
    turns: DataFrame, template: ChatTemplate, add_generation_prompt: bool = False,
    c: TurnColumns = COLUMNS, width: int = WIDTH,
) -> DataFrame:
    """``(conversation, n_turns, text)``: the rendered text of each conversation, one row for each."""
    rows = rendered_turns(turns, template, add_generation_prompt, c, width)
    return rows.groupBy(c.conversation).agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.expr(f"listagg(piece, '') within group (order by `{c.turn}`)").alias("text"),
    )


def training_turns(
    turns: DataFrame, template: ChatTemplate, system: str, policy: str = "insert",
    c: TurnColumns = COLUMNS, width: int = WIDTH,
) -> DataFrame:
    """Repair, system policy and rendering in sequence."""
    shape = {"insert": insert_system, "replace": replace_system}[policy]
    return rendered_turns(shape(repair_turns(turns, c, width), system, c, width), template, False, c, width)
