"""Conversation functions over ``array<struct<role,content>>`` columns, and turn rendering.

A conversation is one row here, so every function is a narrow projection.
``folioframe.operators.turns`` has the same steps for one row per turn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioframe.functions.text import as_column, default_field, render_template, strip

TURNS = "array<struct<role:string,content:string>>"

# Training-record wording, role names and chat layouts.
PAPER_SYSTEM = "You are a helpful AI assistant that generates high-quality academic abstracts."
PAPER_USER = "Write me an abstract for this article: Title: {title}\n\nSections:\n{content}"
UNKNOWN_TITLE = "Unknown Title"
ROLE_NAMES = {"system": "system", "human": "user", "gpt": "assistant"}
LLAMA_HEADER = "Cutting Knowledge Date: December 2023\nToday Date: 26 July 2024\n\n"
QWEN_SYSTEM = "You are Qwen, created by Alibaba Cloud. You are a helpful assistant."
INSTRUCTION_LAYOUT = "<s>[INST] {system}\n\n{user} [/INST]"


@dataclass(frozen=True)
class ChatTemplate:
    """Text around each turn. ``{role}`` in ``prefix`` is replaced by the turn's role."""

    bos: str
    prefix: str
    suffix: str
    generation: str
    system_header: str = ""
    default_system: str | None = None
    trim: bool = False


LLAMA_31 = ChatTemplate(
    bos="<|begin_of_text|>",
    prefix="<|start_header_id|>{role}<|end_header_id|>\n\n",
    suffix="<|eot_id|>",
    generation="<|start_header_id|>assistant<|end_header_id|>\n\n",
    system_header=LLAMA_HEADER,
    default_system="",
    trim=True,
)
QWEN_25 = ChatTemplate(
    bos="",
    prefix="<|im_start|>{role}\n",
    suffix="<|im_end|>\n",
    generation="<|im_start|>assistant\n",
    default_system=QWEN_SYSTEM,
)


def turn(role: Column | str, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def messages(system: str, user: Column) -> Column:
    """``[system, user]`` array for inference."""
    return F.array(turn("system", F.lit(system)), turn("user", user))


def instruction_prompt(system: Column, user: Column) -> Column:
    """Single-turn layout for models without a chat template."""
    return render_template(INSTRUCTION_LAYOUT, {"system": system, "user": user})


def paper_conversation(title: Column | str, content: Column | str, abstract: Column | str) -> Column:
    """``[system, user, assistant]`` training record of one paper."""
    fields = {"title": default_field(title, UNKNOWN_TITLE), "content": default_field(content, "")}
    return F.array(
        turn("system", F.lit(PAPER_SYSTEM)),
        turn("user", render_template(PAPER_USER, fields)),
        turn("assistant", default_field(abstract, "")),
    )


def standard_role(role: Column | str) -> Column:
    """``human``/``gpt`` names to ``user``/``assistant``; other names stay."""
    role = as_column(role)
    pairs = [F.lit(text) for pair in ROLE_NAMES.items() for text in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), role), role)


def standardize_turns(conversation: Column | str, role: str = "from", content: str = "value") -> Column:
    """Array of ``{from, value}`` structs as ``{role, content}`` structs."""
    return F.transform(as_column(conversation), lambda x: turn(standard_role(x[role]), x[content]))


def repair_turns(conversation: Column | str) -> Column:
    """Insert an empty assistant turn after every user turn that lacks an answer."""
    conversation = as_column(conversation)
    ahead = F.slice(conversation, 2, F.size(conversation))

    def with_answer(x: Column, following: Column) -> Column:
        answered = F.coalesce(following["role"], F.lit("")) == "assistant"
        same = turn(x["role"], x["content"])
        return F.when((x["role"] == "user") & ~answered, F.array(same, turn("assistant", F.lit("")))).otherwise(
            F.array(same)
        )

    return F.flatten(F.zip_with(conversation, ahead, with_answer))


def replace_system(conversation: Column | str, system: str) -> Column:
    """Given system prompt first, then only user and assistant turns."""
    kept = F.filter(as_column(conversation), lambda x: x["role"].isin("user", "assistant"))
    return F.concat(F.array(turn("system", F.lit(system))), kept)


def insert_system(conversation: Column | str, system: str) -> Column:
    """Prepend the system prompt unless the first turn already is one."""
    conversation = as_column(conversation)
    first = F.coalesce(F.try_element_at(conversation, F.lit(1))["role"], F.lit(""))
    return F.when(first == "system", conversation).otherwise(
        F.concat(F.array(turn("system", F.lit(system))), conversation)
    )


def turn_prefix(template: ChatTemplate, role: Column) -> Column:
    """Text before a turn's content, with the system header where the layout has one."""
    before, _, after = template.prefix.partition("{role}")
    prefix = F.concat(F.lit(before), role, F.lit(after))
    if not template.system_header:
        return prefix
    return F.concat(prefix, F.when(role == "system", F.lit(template.system_header)).otherwise(F.lit("")))


def turn_body(template: ChatTemplate, content: Column) -> Column:
    content = F.coalesce(content, F.lit(""))
    return strip(content) if template.trim else content


def turn_text(template: ChatTemplate, role: Column, content: Column) -> Column:
    """One rendered turn."""
    return F.concat(turn_prefix(template, role), turn_body(template, content), F.lit(template.suffix))


def with_default_system(template: ChatTemplate, conversation: Column | str) -> Column:
    if template.default_system is None:
        return as_column(conversation)
    return insert_system(conversation, template.default_system)


def render_chat(
    conversation: Column | str, template: ChatTemplate, add_generation_prompt: bool = False
) -> Column:
    """Conversation array as one training or inference text."""
    full = with_default_system(template, conversation)
    body = F.array_join(F.transform(full, lambda x: turn_text(template, x["role"], x["content"])), "")
    tail = template.generation if add_generation_prompt else ""
    return F.concat(F.lit(template.bos), body, F.lit(tail))


def response_spans(conversation: Column | str, template: ChatTemplate) -> Column:
    """``array<struct<turn,start,end,is_target>>``: character span of each turn's content
    in the rendered text; only assistant content is a training target."""
    full = with_default_system(template, conversation)
    empty = F.array().cast("array<struct<turn:bigint,start:bigint,end:bigint,is_target:boolean>>")
    zero = F.struct(F.lit(len(template.bos)).cast("bigint").alias("offset"), empty.alias("spans"))

    def step(state: Column, x: Column) -> Column:
        start = state["offset"] + F.length(turn_prefix(template, x["role"]))
        end = start + F.length(turn_body(template, x["content"]))
        span = F.struct(
            F.size(state["spans"]).cast("bigint").alias("turn"),
            start.cast("bigint").alias("start"),
            end.cast("bigint").alias("end"),
            (x["role"] == "assistant").alias("is_target"),
        )
        return F.struct(
            (end + len(template.suffix)).cast("bigint").alias("offset"),
            F.concat(state["spans"], F.array(span)).alias("spans"),
        )

    return F.aggregate(full, zero, step)["spans"]
