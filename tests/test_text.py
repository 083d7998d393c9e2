import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioframe.functions import text as tx


def column(spark, values, name="t"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def values(df, expression):
    return [r["v"] for r in df.select("i", expression.alias("v")).orderBy("i").collect()]


def test_strip_matches_python(spark):
    texts = ["\t x y　\n", "", " ", "a", " \x1f b\x85", None]
    assert values(column(spark, texts), tx.strip("t")) == [t.strip() if t is not None else None for t in texts]


def test_normalize_title(spark):
    texts = ["\t A: B, C (D)-e.f ", "", None, " Ünï Code"]
    assert values(column(spark, texts), tx.normalize_title("t")) == ["a_b_c_(d)-e.f", "", None, "ünï_code"]


def test_normalize_file_name(spark):
    texts = ["'My Paper: v2.PDF", "\"a-b_c.pdf\"", "x.pdf.pdf", "", None, "'quoted'.pdf"]
    assert values(column(spark, texts), tx.normalize_file_name("t")) == [
        "my_paper_v2", "ab_cpdf", "xpdf", "", None, "quoted",
    ]


def test_normalizers_differ(spark):
    df = column(spark, ["A-B (c)"])
    assert values(df, tx.normalize_title("t")) == ["a-b_(c)"]
    assert values(df, tx.normalize_file_name("t")) == ["ab_c"]


def test_checkpoint_key(spark):
    texts = ["My Paper: x", "my_paper_x.pdf", "checkpoint.txt", "", "  ", None]
    assert values(column(spark, texts), tx.checkpoint_key("t")) == ["my_paper_x", "my_paper_x", None, None, None, None]


def test_names_and_segments(spark):
    assert values(column(spark, ["a:b/c"]), tx.safe_model_name("t")) == ["a_b_c"]
    assert values(column(spark, ["x.pdf", "y.PDF"]), tx.output_name("t")) == ["x.md", "y.PDF"]
    urls = ["https://h/venues/acl/", "x", None]
    assert values(column(spark, urls), tx.url_segment("t")) == ["acl", None, None]


def test_strip_reasoning(spark):
    texts = ["<think>a", "<think>a\n\nb ", "<think>a\n\nb\n\n c ", " <think>a\n\nb", "plain\n\nx", "<think>a\n\n\nb", None]
    def expected(t, trim):
        if t is None or not t.startswith("<think>"):
            return t
        tail = t.split("\n\n")[-1]
        return tail.strip() if trim else tail

    df = column(spark, texts)
    for trim in (True, False):
        assert values(df, tx.strip_reasoning("t", trim)) == [expected(t, trim) for t in texts]


def test_strip_prompt_echo(spark):
    rows = [(0, "p [/INST] x [/INST] y ", "p"), (1, "ppanswerp", "p"), (2, " keep ", ""), (3, None, "p"), (4, "x", None)]
    df = spark.createDataFrame(rows, "i int, t string, p string")
    assert values(df, tx.strip_prompt_echo("t", "p")) == ["y", "answer", "keep", None, "x"]


def test_judge_score(spark):
    texts = [
        '{"score": 4}', '"score":"4"', "\"score\":'4'", '"score": 4.5', '"score": 12', '"score": 3 "score": 5',
        "no score", '"Score": 2', None, '"score": 99999999999',
    ]
    assert values(column(spark, texts), tx.judge_score("t")) == [4, 4, 4, 4, 12, 3, None, None, None, None]


def test_source_article_and_defaults(spark):
    rows = [(0, "T", "c"), (1, "", "c"), (2, "T", ""), (3, None, None)]
    df = spark.createDataFrame(rows, "i int, t string, c string")
    assert values(df, tx.source_article("t", "c")) == ["T\n\nc", "c", "T\n\n", ""]
    assert values(df, tx.default_field("t", "No Title")) == ["T", "", "T", "No Title"]


def test_template(one):
    expression = tx.render_template("{{{a}}} and {b}{a}", {"a": F.col("a"), "b": F.col("b")})
    assert one(expression, a="1", b=None) == "{1} and 1"
    with pytest.raises(KeyError):
        tx.render_template("{missing}", {})


def test_ngrams(spark):
    texts = ["a b c d", "a b", "a", "", "É-té x"]
    df = column(spark, texts).select("i", tx.words("t").alias("w"))
    words = [re.findall("[a-z0-9]+", t.lower()) for t in texts]
    assert [r["w"] for r in df.orderBy("i").collect()] == words
    for n in (1, 2, 3):
        expected = [[" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] for w in words]
        assert values(df, tx.word_ngrams("w", n)) == expected


def test_decode_bytes(spark):
    raw = ["é".encode("utf-8"), b"\xe9", b"", "abc".encode()]
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(raw)], "i int, t binary")
    assert values(df, tx.decode_bytes("t")) == ["é", "é", "", "abc"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_scalar_functions_on_any_text(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    df = column(spark, texts)
    assert values(df, tx.strip("t")) == [t.strip() for t in texts]
    assert values(df, tx.generation_length("t")) == [len(t.strip()) for t in texts]
