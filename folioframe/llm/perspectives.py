"""Chat formatting: one rendering of a dialogue for each of its speakers, with loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioframe.operators.ordered import by_range, scan_groups
from folioframe.session import cut

# A public chat layout.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
NARRATOR = "system"
#: Characters of a dialogue in one row, and what each of its turns counts besides its text.
PART_CHARS, TURN_CHARS = 16_777_216, 64


def _turns(turns: DataFrame, conversation: str, turn: str, speaker: str, text: str) -> DataFrame:
    """Turns under fixed names; no text can hold a mark of the layout."""
    return turns.select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"), F.col(speaker).alias("speaker"),
        _without_marks(F.coalesce(F.col(text), F.lit(""))).alias("text"),
    )


def _without_marks(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _sides(rows: DataFrame, narrator: str) -> DataFrame:
    """``(side_id, perspective)``: every conversation's distinct speakers but the narrator."""
    speaks = ~F.col("speaker").eqNullSafe(F.lit(narrator))
    return rows.where(speaks).select(F.col("conv_id").alias("side_id"), F.col("speaker").alias("perspective")).distinct()


def _rotated(joined: DataFrame, narrator: str, *kept: str) -> DataFrame:
    """Turns that have met a perspective, with their role, head, body and mask."""
    own = F.col("speaker").eqNullSafe(F.col("perspective"))
    narrates = F.col("speaker").eqNullSafe(F.lit(narrator))
    role = F.when(own, "assistant").when(narrates, "system").otherwise("user")
    called = _without_marks(F.regexp_replace("speaker", r"[\p{Cc}\u2028\u2029]+", " "))
    name = F.when(F.col("role") == "user", F.coalesce(F.concat(F.lit(" name="), called), F.lit(""))).otherwise("")
    return joined.withColumn("role", role).select(
        "conv_id", "perspective", "turn", "speaker", "role",
        F.concat(F.lit(TURN_START), "role", name, F.lit("\n")).alias("head"),
        F.concat("text", F.lit(TURN_END)).alias("body"), own.alias("trained"), *kept,
    )


def rotated_turns(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
    narrator: str = NARRATOR,
) -> DataFrame:
    """Every turn once for every speaker of its conversation, as that speaker's side sees it.

    Columns: ``conv_id, perspective, turn, speaker, role, head, body, trained``. The speaker whose
    perspective it is has the role ``assistant``, the narrator is ``system``, all others are
    ``user`` and named in the head. ``head || body`` is the turn's rendering, and ``trained`` tells
    whether its body, end mark included, counts for the loss. The narrator has no perspective; a
    conversation of the narrator alone gives no rows.

    Nobody can write a turn for somebody else: ``<|`` in a text or a name becomes ``< |``, and control
    characters and line breaks in a name become a blank. ``speaker`` and ``perspective`` keep the name as given.

    Only the distinct speakers of a conversation are joined to its turns, on the conversation;
    nothing is gathered, so a conversation of any length is dealt over tasks. A null id is one
    conversation. A null speaker is one speaker, unlike any other and without a name; a null text is
    empty. Extra columns are dropped.
    """
    rows = _turns(turns, conversation, turn, speaker, text)
    return _rotated(rows.join(_sides(rows, narrator), F.col("conv_id").eqNullSafe(F.col("side_id"))), narrator)


def render_perspectives(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
    narrator: str = NARRATOR, part_chars: int = PART_CHARS,
) -> DataFrame:
    """One training text for every speaker of every conversation.

    Columns: ``conv_id, perspective, part, n_turns, text, spans, n_trained``. ``spans`` are the half-open
    character ranges of ``text`` that count for the loss, in order; ``n_trained`` is their total
    length. Turns are ordered by number, then speaker, then text; nulls come first and repeated turns stay.

    A turn belongs to part ``n`` if the turns before it have ``n * part_chars`` characters or more, each turn
    counting ``TURN_CHARS`` besides its text. So a dialogue is one row, part 0, up to that length, and beyond it
    several rows that are its text when joined in order: a conversation may hold any share of all turns
    (those without an id are one). Which turns share a part depends on no perspective. The rest as in ``rotated_turns``.
    """
    # equal beginnings share a segment, where whole texts decide
    lead = F.substring("text", 1, 64).alias("lead")
    rows = _turns(turns, conversation, turn, speaker, text).select("*", lead)
    size = F.length("text") + TURN_CHARS
    counted = scan_groups(
        by_range(rows, ["conv_id", "turn", "speaker", "lead"]), ["conv_id"], ["turn", "speaker", "text"],
        totals={"upto": size.cast("bigint")},
    )
    part = F.expr(f"(upto - length(text) - {TURN_CHARS}) div {int(part_chars)}").alias("part")
    placed, _ = cut(counted.select("conv_id", "turn", "speaker", "text", part), "dialogues")
    parts = placed.select("conv_id", "part").distinct()
    sides = parts.join(_sides(placed, narrator), F.col("conv_id").eqNullSafe(F.col("side_id"))).select(
        "side_id", F.col("part").alias("side_part"), "perspective"
    )
    same = F.col("conv_id").eqNullSafe(F.col("side_id")) & (F.col("part") == F.col("side_part"))
    rotated = _rotated(placed.join(sides, same), narrator, "part", "text")
    # the keys hold those of the join, so what it has dealt out stays in place
    order = Window.partitionBy("conv_id", "part", "perspective").orderBy("turn", "speaker", "text").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    numbered = rotated.withColumn("place", F.count(F.lit(1)).over(order)).withColumn(
        "end", F.sum(F.length("head") + F.length("body")).over(order)
    )
    start = (F.col("end") - F.length("body")).alias("first")
    piece = F.struct("place", F.concat("head", "body").alias("piece"))
    span = F.when(F.col("trained"), F.struct(start, F.col("end").alias("last")))
    grouped = numbered.groupBy("conv_id", "part", "perspective").agg(
        F.count("*").alias("n_turns"), F.array_sort(F.collect_list(piece)).alias("pieces"),
        F.array_sort(F.collect_list(span)).alias("spans"),
        F.sum(F.when(F.col("trained"), F.length("body")).otherwise(0)).alias("n_trained"),
    )
    return grouped.select(
        "conv_id", "perspective", "part", "n_turns",
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("text"), "spans", "n_trained",
    )


def span_text(spans: str) -> Column:
    """Spans as text, ``first-last`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat(s["first"].cast("string"), F.lit("-"), s["last"].cast("string"))), ",")
