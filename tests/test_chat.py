import json

import pytest
from pyspark.sql import functions as F

from folioframe.functions import chat
from folioframe.operators import turns
from folioframe.plans import finetuning

CONVERSATIONS = {
    1: [],
    2: ["user"],
    3: ["user", "user", "assistant"],
    4: ["system", "user", "assistant", "user"],
    5: ["assistant", "tool", "user", "system", "assistant", "user", "user"],
    6: ["user", "assistant"] * 8 + ["user"],
}


def array_frame(spark):
    rows = [(k, [(r, f" c{i} ") for i, r in enumerate(v)]) for k, v in CONVERSATIONS.items()]
    return spark.createDataFrame(rows, f"conv_id int, c {chat.TURNS}")


def turn_frame(spark):
    # Turn numbers with gaps.
    rows = [(k, 3 * i, r, f" c{i} ") for k, v in CONVERSATIONS.items() for i, r in enumerate(v)]
    return spark.createDataFrame(rows, "conv_id int, turn long, role string, text string").repartition(4)


def from_arrays(df, column):
    return {r["conv_id"]: [(t["role"], t["content"]) for t in r["v"]] for r in df.select("conv_id", column.alias("v")).collect()}


def from_turns(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    for k, v in out.items():
        v.sort()
        assert [t for t, _, _ in v] == list(range(len(v))), k
    return {k: [(r, c) for _, r, c in v] for k, v in out.items()}


def repaired(rows):
    out = []
    for i, (role, content) in enumerate(rows):
        out.append((role, content))
        if role == "user" and (i + 1 == len(rows) or rows[i + 1][0] != "assistant"):
            out.append(("assistant", ""))
    return out


def plain():
    return {k: [(r, f" c{i} ") for i, r in enumerate(v)] for k, v in CONVERSATIONS.items()}


@pytest.mark.parametrize("width", [2, 1000])
def test_repair(spark, width):
    expected = {k: repaired(v) for k, v in plain().items()}
    assert from_arrays(array_frame(spark), chat.repair_turns("c")) == expected
    fixed = turns.repair_turns(turn_frame(spark), width=width)
    assert from_turns(fixed) == {k: v for k, v in expected.items() if v}
    fixed = fixed.checkpoint()
    assert from_turns(turns.repair_turns(fixed, width=width)) == from_turns(fixed)
    assert turns.mark_orphans(fixed, width=width).filter("is_orphan").count() == 0


@pytest.mark.parametrize("width", [2, 1000])
def test_system_policies(spark, width):
    sys = ("system", "S")
    replaced = {k: [sys] + [t for t in v if t[0] in ("user", "assistant")] for k, v in plain().items()}
    inserted = {k: v if v and v[0][0] == "system" else [sys, *v] for k, v in plain().items()}
    assert from_arrays(array_frame(spark), chat.replace_system("c", "S")) == replaced
    assert from_arrays(array_frame(spark), chat.insert_system("c", "S")) == inserted
    rows = turn_frame(spark)
    assert from_turns(turns.replace_system(rows, "S", width=width)) == {k: v for k, v in replaced.items() if k != 1}
    assert from_turns(turns.insert_system(rows, "S", width=width)) == {k: v for k, v in inserted.items() if k != 1}


def layout(template, rows, generation=False):
    text, spans = template.bos, []
    for i, (role, content) in enumerate(rows):
        text += template.prefix.replace("{role}", role) + (template.system_header if role == "system" else "")
        body = content.strip() if template.trim else content
        spans.append((i, len(text), len(text) + len(body), role == "assistant"))
        text += body + template.suffix
    return text + (template.generation if generation else ""), spans


@pytest.mark.parametrize("width", [4, 1000])
@pytest.mark.parametrize("policy", ["insert", "replace"])
def test_training_turns(spark, width, policy):
    out = {}
    for r in turns.training_turns(turn_frame(spark), chat.QWEN_25, "S", policy, width=width).orderBy("turn").collect():
        out[r["conv_id"]] = out.get(r["conv_id"], "") + r["piece"]
    expected = {}
    for k, rows in plain().items():
        rows = repaired(rows)
        if policy == "replace":
            rows = [("system", "S")] + [t for t in rows if t[0] in ("user", "assistant")]
        elif rows and rows[0][0] != "system":
            rows = [("system", "S"), *rows]
        if CONVERSATIONS[k]:
            expected[k] = layout(chat.QWEN_25, rows)[0]
    assert out == expected


@pytest.mark.parametrize("template", [chat.LLAMA_31, chat.QWEN_25])
def test_render_and_spans(spark, template):
    default = template.default_system
    full = {k: v if v and v[0][0] == "system" else [("system", default), *v] for k, v in plain().items()}
    df = array_frame(spark).select(
        "conv_id", chat.render_chat("c", template).alias("text"), chat.render_chat("c", template, True).alias("open"),
        chat.response_spans("c", template).alias("spans"),
    )
    for r in df.collect():
        text, spans = layout(template, full[r["conv_id"]])
        assert r["text"] == text
        assert r["open"] == text + template.generation
        assert [tuple(s) for s in r["spans"]] == spans
        for (_, start, end, _), (_, content) in zip(spans, full[r["conv_id"]]):
            assert text[start:end] == (content.strip() if template.trim else content)
    rows = turns.insert_system(turn_frame(spark), default, width=2).checkpoint()
    for width in (1, 2, 4096):
        out = turns.render_conversations(rows, template, True, width=width).collect()
        assert {r["conv_id"]: r["text"] for r in out} == {k: layout(template, v, True)[0] for k, v in full.items() if k != 1}
        assert len(out) == len({r["conv_id"] for r in out})
    spans = {}
    for r in turns.rendered_turns(rows, template, width=3).orderBy("turn").collect():
        spans.setdefault(r["conv_id"], []).append((r["turn"], r["start"], r["end"], r["is_target"]))
    assert spans == {k: layout(template, v)[1] for k, v in full.items() if k != 1}


def test_llama_layout(one):
    turn = chat.turn("user", F.lit("Hello!"))
    text = one(chat.render_chat(F.array(chat.turn("system", F.lit("Be kind")), turn), chat.LLAMA_31, True))
    assert text == (
        "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nCutting Knowledge Date: December 2023\n"
        "Today Date: 26 July 2024\n\nBe kind<|eot_id|><|start_header_id|>user<|end_header_id|>\n\nHello!<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\n"
    )
    assert one(chat.instruction_prompt(F.lit("s"), F.lit("u"))) == "<s>[INST] s\n\nu [/INST]"


def test_standard_roles(spark):
    raw = [{"from": "system", "value": "s"}, {"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}, {"from": "tool", "value": "t"}]
    df = spark.createDataFrame([(1, json.dumps(raw))], "conv_id int, j string")
    df = df.select("conv_id", F.from_json("j", "array<struct<`from`:string,value:string>>").alias("c"))
    once = df.select("conv_id", chat.standardize_turns("c").alias("c"))
    expected = {1: [("system", "s"), ("user", "h"), ("assistant", "g"), ("tool", "t")]}
    assert from_arrays(once, F.col("c")) == expected
    assert from_arrays(once, chat.standardize_turns("c", "role", "content")) == expected


def test_paper_records_and_training_texts(spark):
    articles = spark.createDataFrame([(0, "T", "C", "A"), (1, None, None, None)], "pos long, title string, content string, abstract string")
    records = finetuning.paper_records(articles)
    got = {r["pos"]: [(t["role"], t["content"]) for t in r["conversations"]] for r in records.collect()}
    assert got[0][1:] == [("user", "Write me an abstract for this article: Title: T\n\nSections:\nC"), ("assistant", "A")]
    assert got[1][1:] == [("user", "Write me an abstract for this article: Title: Unknown Title\n\nSections:\n"), ("assistant", "")]
    texts = finetuning.training_texts(records, "pos", chat.LLAMA_31, "New", policy="replace", spans=True)
    first = texts.filter("pos = 0").first()
    assert "New<|eot_id|>" in first["text"] and "helpful" not in first["text"]
    target = [s for s in first["spans"] if s["is_target"]]
    assert [first["text"][s["start"] : s["end"]] for s in target] == ["A"]
    kept = finetuning.training_texts(records, "pos", chat.LLAMA_31, "New", policy="insert").filter("pos = 0").first()
    assert "New" not in kept["text"]


@pytest.mark.parametrize("width", [1, 2, 100])
def test_turns_without_conversation_id(spark, width):
    """They are one conversation, whatever the width of a segment."""
    rows = [(None, 0, "user", "a"), (None, 1, "user", "b"), (None, 2, "assistant", "c"), (5, 0, "user", "d")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = sorted((tuple(r) for r in turns.repair_turns(df, width=width).collect()), key=str)
    assert out == sorted([
        (None, 0, "user", "a"), (None, 1, "assistant", ""), (None, 2, "user", "b"), (None, 3, "assistant", "c"),
        (5, 0, "user", "d"), (5, 1, "assistant", ""),
    ], key=str)
    system = turns.insert_system(df, "S", width=width)
    assert sorted((r["conv_id"] is None, r["turn"]) for r in system.collect()) == [
        (False, 0), (False, 1), (True, 0), (True, 1), (True, 2), (True, 3)
    ]
