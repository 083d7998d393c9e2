"""Physical plans: exchanges, pushed columns and the absence of products and single tasks."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from folioframe.functions import chat
from folioframe.operators import corpus, datasets, metrics, pairing, turns
from folioframe.plans.workload import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def texts(spark, name):
    return spark.range(50).select(F.col("id").alias("pair_id"), F.concat(F.lit("a b "), "id").alias(name))


def test_rouge_adds_no_exchange_to_a_pair_join(spark, no_broadcast):
    pairs = pairing.truncating_zip(texts(spark, "reference_text"), texts(spark, "candidate_text"), "pair_id")
    for scored in (metrics.rouge_n(pairs, (1, 2)), metrics.rouge_l(pairs), metrics.rouge(pairs)):
        assert plan(scored).count("Exchange") == 2


def test_ngram_overlap_is_narrow(spark):
    pairs = texts(spark, "reference_text").withColumn("candidate_text", F.upper("reference_text"))
    text = plan(metrics.rouge_n(pairs, (1, 2)))
    assert "Exchange" not in text and "Generate" not in text and "Python" not in text
    for scored in (metrics.rouge_l(pairs), metrics.rouge(pairs), metrics.rouge_n(pairs, 1, stemmed=True)):
        assert "Exchange" not in plan(scored)


def test_array_chat_pipeline_has_no_exchange(spark):
    text = plan(QUERIES["training_texts"](spark, SF_DIR))
    assert "Exchange" not in text and "Python" not in text and text.count("FileScan") == 1


def test_turn_pipeline_is_segmented_and_never_in_one_task(spark):
    text = plan(QUERIES["training_turns"](spark, SF_DIR))
    assert "SinglePartition" not in text and "Python" not in text and "_segment#" in text


@pytest.mark.parametrize("name", ["page_links", "sections", "split_hash", "prompt_table", "judge_prompts", "strip_reasoning", "budget_truncate"])
def test_narrow_queries(spark, name):
    assert "Exchange" not in plan(QUERIES[name](spark, SF_DIR))


def test_scans_read_only_needed_columns(spark):
    assert "ReadSchema: struct<doc_id:bigint>" in plan(QUERIES["split_hash"](spark, SF_DIR))
    assert "ReadSchema: struct<n_chars:bigint>" in plan(spark.read.parquet(f"{SF_DIR}/documents.parquet").agg(F.max("n_chars")))
    report = plan(QUERIES["volume_progress"](spark, SF_DIR))
    assert "text:string" not in report


EAGER = {"stream_convert", "stream_manifest", "generation_run"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_products(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_repeated_key_is_combined_before_the_shuffle(spark, no_broadcast):
    df = spark.range(1000).select(F.col("id").alias("pos"), F.when(F.col("id") >= 0, "hot").alias("k"), F.lit("wide").alias("t"))
    text = plan(pairing.first_wins(df, "k"))
    assert "partial_min(_place" in text and "hashpartitioning(_digest" in text and "hashpartitioning(k" not in text


def test_hot_run_is_split(spark):
    """One run with all rows is spread over segments instead of one window partition."""
    from folioframe.operators.ordered import SEGMENT, by_width, scan_groups

    df = spark.range(1000).select((F.col("id") - F.col("id")).alias("run"), F.col("id").alias("pos"))
    seen = scan_groups(by_width(df, "pos", 100), ["run"], ["pos"], totals={"n": F.lit(1)})
    assert f"hashpartitioning(run#" in plan(seen) and f"{SEGMENT}#" in plan(seen)
    assert seen.agg(F.max(F.abs(F.col("n") - F.col("pos") - 1))).first()[0] == 0


def test_split_scans_keys_only(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    text = plan(datasets.hash_split(df, "doc_id").select("doc_id", "split"))
    assert "ReadSchema: struct<doc_id:bigint>" in text
