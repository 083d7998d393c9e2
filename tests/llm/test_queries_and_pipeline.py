"""Registered queries against SQL and plain Python at the smallest scale; the pipeline stage by stage."""

from pathlib import Path

import brute
import duckdb
import public_tokenizers
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from folioframe.llm import compression_bands
from folioframe.llm.queries import QUERIES
from folioframe.llm.queries_sql import SQL

SF_DIR = "/root/testdata/sf0.001"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def rows(duck):
    return duck.execute("select doc_id, text from documents order by doc_id").fetchall()


def test_registered():
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_of_whole_table(spark, rows, name):
    out = QUERIES[name](spark, SF_DIR).collect()
    assert {r["doc_id"] for r in out} == {i for i, _ in rows}
    if name.startswith("op7_"):
        ids = dict(zip([i for i, _ in rows], brute.token_ids([t for _, t in rows], WORD_BPE), strict=True))
        assert brute.check_pieces([r.asDict() for r in out], ids) < 0.1
    else:
        assert len(out) == len(rows)


def test_pipeline_stage_by_stage(spark, rows, duck):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, texts = docs.columns, dict(rows)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_dedup", "substring_dedup", "decontamination", "packing"]

    def run(name, given):
        table = spark.createDataFrame(given.collect(), given.schema) if given is not docs else docs
        return stages[name](spark, table, SF_DIR)

    first = run("quality_rules", docs)
    judge = compression_bands.Bands()
    kept = {i: t for i, t in texts.items() if not brute.quality(t)["base_failed"] and judge(t.encode())[0]}
    assert first.columns == columns and {r["doc_id"]: r["text"] for r in first.collect()} == kept

    second = run("near_dedup", first)
    near = brute.near(list(kept.items()), corpus_pipeline.SHINGLE, corpus_pipeline.SIMILARITY)
    kept = {i: t for i, t in kept.items() if near[i][2]}
    assert second.columns == columns and {r["doc_id"]: r["text"] for r in second.collect()} == kept

    third = run("substring_dedup", second)
    gone = brute.repeats(list(kept.items()), corpus_pipeline.PASSAGE)
    left = {r["doc_id"]: r for r in third.collect()}
    assert third.columns == columns and set(left) == {i for i in kept if gone[i][1] < gone[i][0]}
    for i, r in left.items():
        assert len(brute.words(r["text"])) == gone[i][0] - gone[i][1] and r["n_chars"] == len(r["text"])
        assert gone[i][1] or r["text"] == kept[i]

    fourth = run("decontamination", third)
    items = duck.execute("select item_id, text from benchmark").fetchall()
    leaks = brute.leaks([(i, r["text"]) for i, r in left.items()], items)
    assert fourth.columns == columns and {r["doc_id"] for r in fourth.collect()} == {i for i, e in leaks.items() if not e[4]}

    ids = {r["doc_id"]: r["text"] for r in fourth.collect()}
    ids = dict(zip(ids, brute.token_ids(ids.values(), WORD_BPE), strict=True))
    whole = [r.asDict() for r in corpus_pipeline.run(spark, SF_DIR).collect()]
    brute.check_pieces(whole, ids, corpus_pipeline.WIDTH)
    brute.check_pieces([r.asDict() for r in run("packing", fourth).collect()], ids, corpus_pipeline.WIDTH)
