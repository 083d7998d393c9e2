import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioframe.functions.text import has_score, judge_score
from folioframe.operators import hooks, judging
from folioframe.plans import evaluation

TEMPLATES = {m: judging.JudgeTemplate(m + ": {content} {side} {abstract} 1-{top}", m != "fluency") for m in judging.TOP_SCORES}
TEMPLATES["fluency"] = judging.JudgeTemplate("fluency: {side} {abstract} 1-{top}", needs_content=False)


def articles(spark):
    return spark.createDataFrame(
        [("t", "talks of coherence", "o", "g"), ("u", "c", "o2", "g2")],
        "title string, content string, original_abstract string, generated_abstract string",
    )


def test_prompts(spark):
    rows = {(r["title"], r["metric"], r["side"]): (r["prompt"], r["max_score"]) for r in judging.judge_prompts(articles(spark), TEMPLATES).collect()}
    assert len(rows) == 16
    assert rows["t", "coherence", "original"] == ("coherence: talks of coherence Original o 1-5", 5)
    assert rows["t", "fluency", "generated"] == ("fluency: Generated g 1-3", 3)


def test_resume_asks_only_open_questions(spark):
    done = [("t", s, m) for s in judging.SIDES for m in judging.TOP_SCORES if (s, m) != ("generated", "relevance")]
    answered = spark.createDataFrame(done + done[:2] + [("t", "other", "fluency")], "title string, side string, metric string")
    rows = judging.judge_prompts(articles(spark), TEMPLATES, done=answered).collect()
    assert [(r["metric"], r["side"]) for r in rows if r["title"] == "t"] == [("relevance", "generated")]
    assert len([r for r in rows if r["title"] == "u"]) == 8
    assert all(r["prompt"].startswith(r["metric"]) for r in rows)


def test_all_or_nothing_and_means(spark):
    responses = []
    for title in ("t", "u"):
        for side in judging.SIDES:
            for i, metric in enumerate(judging.TOP_SCORES):
                responses.append((title, side, metric, 1, "no answer" if i == 2 else f'"score": {i + 1}'))
                if i == 2:
                    late = 4 if (title, side) == ("u", "generated") else 2
                    responses.append((title, side, metric, late, '"score": 3'))
    df = spark.createDataFrame(responses, "title string, side string, metric string, attempt int, response string")
    accepted = judging.accepted_scores(df)
    assert accepted.count() == 15
    records = judging.complete_records(accepted)
    assert [r["title"] for r in records.collect()] == ["t"]
    means = {(r["side"], r["metric"]): r["average_score"] for r in judging.judge_means(records).collect()}
    assert means == {(s, m): float(i + 1) for s in judging.SIDES for i, m in enumerate(judging.TOP_SCORES)}
    assert judging.judge_means(records.filter("title = 'none'")).count() == 0
    nested = judging.nested_records(records, articles(spark)).first()
    assert nested["generated_abstract"]["text"] == "g" and nested["original_abstract"]["scores"]["fluency_score"] == 3


def test_evaluator_inputs(spark):
    pairs = articles(spark).withColumn("pos", F.lit(0)).withColumn("generated_abstract", F.lit("<think>x\n\n y "))
    row = judging.evaluator_inputs(pairs, ["pos", "title"]).filter("title = 't'").first()
    assert (row["source"], row["system_output"], row["reference"]) == ("t\n\ntalks of coherence", "y", "o")


def test_judge_hook_retries_only_unusable(spark):
    def make():
        def judge(prompts, attempt):
            if any("boom" in p for p in prompts):
                raise RuntimeError
            return ['"score": 1' if f"ok{attempt}" in p else "none" for p in prompts]

        return judge

    data = [("a", "original", "fluency", "ok1"), ("b", "original", "fluency", "ok3"), ("c", "original", "fluency", "never"), ("d", "original", "fluency", "boom")]
    prompts = spark.createDataFrame(data, "title string, side string, metric string, prompt string").repartition(1)
    calls = hooks.run_judge(prompts, make)
    assert sorted((r["title"], r["attempt"]) for r in calls.collect()) == [
        ("a", 1), ("b", 1), ("b", 2), ("b", 3), ("c", 1), ("c", 2), ("c", 3), ("d", 1), ("d", 2), ("d", 3),
    ]
    assert sorted(r["title"] for r in judging.accepted_scores(calls).collect()) == ["a", "b"]


def test_an_answer_without_a_number_is_asked_again(spark):
    def make():
        return lambda prompts, attempt: ['"score": "good"' if attempt == 1 else '"score": 4' for _ in prompts]

    prompts = spark.createDataFrame([("a", "original", "fluency", "p")], "title string, side string, metric string, prompt string")
    calls = hooks.run_judge(prompts, make)
    assert [r["score"] for r in judging.accepted_scores(calls).collect()] == [4]


def test_judge_run_resumes(spark, tmp_path):
    rows = [(i, f"o{i}", f"g{i}", "c") for i in range(6)]
    articles = spark.createDataFrame(rows, "pos long, original_abstract string, generated_abstract string, content string")
    templates = {"fluency": judging.JudgeTemplate("{side}|{abstract}|{top}", needs_content=False)}
    whole, halves = str(tmp_path / "whole"), str(tmp_path / "halves")
    one = evaluation.judge_missing(articles, templates, hooks.stub_judge, whole, ["pos"])
    evaluation.judge_missing(articles.where("pos < 3"), templates, hooks.stub_judge, halves, ["pos"])
    two = evaluation.judge_missing(articles, templates, hooks.stub_judge, halves, ["pos"])
    pick = lambda df: sorted((r["pos"], r["side"], r["metric"], r["score"]) for r in df.collect())
    assert pick(one) == pick(two) and one.count() > 6


def test_evaluator_means(spark):
    def make():
        def evaluate(sources, outputs, references):
            if "bad" in outputs:
                raise ValueError
            return [{"fluency": float(len(o))} for o in outputs]

        return evaluate

    rows = [(0, "t", "c", "r", "abcd"), (1, "t", "c", "r", "ab"), (2, "t", "c", "r", "bad"), (3, "t", "c", None, "x")]
    pairs = spark.createDataFrame(rows, "pos long, title string, content string, original_abstract string, generated_abstract string")
    out = evaluation.evaluator_report(pairs, make, ["fluency", "relevance"]).collect()
    assert [tuple(r) for r in out] == [("fluency", 3.0, 2)]


def test_generator_and_encoder_hooks(spark):
    def make():
        def generate(prompts, models, options):
            if "bad" in prompts:
                raise ValueError
            return [f" {m}:{p}:{options['temperature']} " if p != "none" else "" for p, m in zip(prompts, models)]

        return generate

    work = spark.createDataFrame([("m", 0, "x"), ("m", 1, "bad"), ("m", 2, "none")], "model string, pos long, prompt string").repartition(1)
    out = {r["pos"]: (r["text"], r["status"]) for r in hooks.run_generator(work, make, {"temperature": 0.7}).collect()}
    assert out == {0: ("m:x:0.7", "ok"), 1: (None, "failed"), 2: (None, "failed")}
    assert hooks.run_generator(work, make, {"temperature": 0.7}, partitions=3).count() == 3
    texts = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "text string")
    encoded = hooks.encode_texts(texts, hooks.stub_encoder).collect()
    assert len(encoded) == 2 and all(len(r["vector"]) == 16 for r in encoded)


def test_a_score_is_the_same_in_a_task_and_in_a_plan(spark):
    answers = ['{"score": 4}', '{"score": ٣}', '"score": ４', '{"score":\u00a04}', '{"score":\u20284}', '"score" : 10', "", None, '{"score": 99999999999}', "none"]
    table = spark.createDataFrame([(a,) for a in answers], "answer string").select("answer", judge_score("answer").alias("score"))
    for r in table.collect():
        assert has_score(r["answer"]) == (r["score"] is not None)


def test_calls_are_small_and_their_rows_go_out_together(spark):
    """Hooks are called with few prompts at a time, and a batch of rows comes back as one."""
    def make():
        def judge(prompts, attempt):
            assert len(prompts) <= 5
            return [f'"score": {len(prompts)}' if int(p) % 3 else "none" for p in prompts]

        return judge

    prompts = spark.range(0, 103, 1, 1).select(F.col("id").alias("title"), F.lit("s").alias("side"), F.lit("m").alias("metric"), F.col("id").cast("string").alias("prompt"))
    calls = hooks.run_judge(prompts, make, batch_size=5)
    rows = {(r["title"], r["attempt"]): r["response"] for r in calls.collect()}
    assert set(rows) == {(i, a) for i in range(103) for a in ((1,) if i % 3 else (1, 2, 3))}
    assert rows[0, 1] == rows[102, 3] == "none" and rows[1, 1] == '"score": 5' and rows[101, 1] == '"score": 3'

    class Captured:
        schema = prompts.schema
        select = lambda self, *names: self
        mapInArrow = lambda self, run, types: run  # noqa: E731, N815

    batch = pa.RecordBatch.from_pandas(prompts.select("title", "prompt").toPandas())
    frames = list(hooks.run_judge(Captured(), make, ["title"], batch_size=5)(iter([batch])))
    assert [f.num_rows for f in frames] == [173]
    inputs = prompts.select("title", F.lit("").alias("source"), F.col("prompt").alias("system_output"), F.lit("").alias("reference"))
    scored = hooks.run_evaluator(inputs, lambda: lambda s, o, r: [{"x": float(x)} if len(o) <= 5 else None for x in o], ("x",), ["title"], batch_size=5)
    assert {r["title"]: r["score"] for r in scored.collect()} == {i: float(i) for i in range(103)}
