import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from folioframe.operators import corpus, filters, pairing


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_strict_zip(spark):
    a = spark.createDataFrame([(0, "a"), (1, "b")], "pos long, x string")
    b = spark.createDataFrame([(1, "B"), (0, "A")], "pos long, y string")
    assert rows(pairing.strict_zip(a, b), "pos", "x", "y") == [(0, "a", "A"), (1, "b", "B")]
    for left, right in ((a, b.filter("pos = 0")), (a.filter("pos = 0"), b)):
        with pytest.raises(PySparkException, match="differ in length"):
            pairing.strict_zip(left, right).collect()


def test_truncating_zip(spark):
    a = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos long, x string")
    b = spark.createDataFrame([(0, "A"), (1, "B")], "pos long, y string")
    assert pairing.truncating_zip(a, b).count() == 2


def test_title_join_last_wins_and_keeps_left_copies(spark):
    left = spark.createDataFrame([(0, "t"), (1, "t"), (2, "u")], "left_pos long, title string")
    right = spark.createDataFrame([(0, "t", "old"), (1, "t", "new"), (2, "v", "x")], "pos long, title string, abstract string")
    assert rows(pairing.title_join(left, right), "left_pos", "abstract") == [(0, "new"), (1, "new")]


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([(0, "a"), (1, None), (2, "a"), (3, None), (4, "b")], "pos long, k string")
    assert rows(pairing.first_wins(df, "k"), "pos") == [(0,), (1,), (4,)]
    assert rows(pairing.last_wins(df, "k"), "pos") == [(2,), (3,), (4,)]
    assert corpus.dedup_report(df, "k").first().asDict() == {"n_before": 5, "n_after": 3, "n_removed": 2}
    assert rows(corpus.repeated_keys(df, "k", "k"), "k", "n_rows") == [("a", 2), (None, 2)]


def test_first_and_last_wins_where_positions_repeat(spark):
    data = [("f1", 0, "a", "x"), ("f1", 1, "b", "y"), ("f2", 0, "c", "z"), ("f2", 1, "a", "w"), ("f2", 1, "a", "w")]
    df = spark.createDataFrame(data, "file string, pos long, k string, v string")
    order = ["file", "pos"]
    assert rows(pairing.first_wins(df, "k", order), "k", "v") == [("a", "x"), ("b", "y"), ("c", "z")]
    assert rows(pairing.last_wins(df, "k", order), "k", "v") == [("a", "w"), ("b", "y"), ("c", "z")]
    # positions alone tie: still one row a key
    assert pairing.first_wins(df, "k").count() == 3
    left = spark.createDataFrame([("a",)], "k string")
    assert rows(pairing.title_join(left, df, "k", order), "k", "v") == [("a", "w")]


def test_pending_ignores_blank_keys(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), ("b",)], "k string")
    done = spark.createDataFrame([("a",), ("",), (None,)], "k string")
    assert rows(pairing.pending(df, done, "k"), "k") == [("",), ("b",), (None,)]
    assert rows(pairing.drop_blank_distinct(df.union(done), "k"), "k") == [("a",), ("b",)]


def test_work_list(spark):
    articles = spark.createDataFrame([(0, "x"), (1, "y")], "pos long, title string")
    done = spark.createDataFrame([(0, "m1"), (0, "m1"), (0, "other")], "pos long, model string")
    assert rows(pairing.work_list(articles, ["m1", "m2"], done), "pos", "model") == [(0, "m2"), (1, "m1"), (1, "m2")]
    assert pairing.work_list(articles, ["m1", "m2"]).count() == 4
    waiting = pairing.work_list(articles, ["m1", "m2"], done)
    assert rows(corpus.high_water_mark(waiting), "model", "done_prefix") == [("m1", 1), ("m2", 0)]


def test_first_usable_attempt(spark):
    data = [("a", 1, None), ("a", 2, 4), ("a", 3, 5), ("b", 4, 1), ("c", 1, 3)]
    df = spark.createDataFrame(data, "k string, attempt int, score int")
    assert rows(pairing.first_usable_attempt(df, ["k"], "score"), "k", "score") == [("a", 4), ("c", 3)]


def test_completeness(spark):
    articles = spark.createDataFrame([(0,), (1,)], "pos long")
    results = spark.createDataFrame([("m", 0), ("m", 1), ("n", 1)], "model string, pos long")
    assert rows(corpus.complete_models(results, articles), "model", "n_done") == [("m", 2)]
    assert corpus.publishable(results, articles).count() == 2
    assert rows(corpus.resume_summary(results), "model", "next_pos", "n_done") == [("m", 2, 2), ("n", 2, 1)]


def test_volume_progress(spark):
    listed = spark.createDataFrame([("v", "a"), ("v", "a"), ("v", "b"), ("w", "c"), ("w", "")], "volume string, key string")
    done = spark.createDataFrame([("v", "a"), ("v", ""), ("w", "c"), ("w", "gone"), ("x", "y")], "volume string, key string")
    out = rows(corpus.volume_progress(listed, done), "volume", "n_total", "n_done", "complete")
    assert out == [("v", 2, 1, False), ("w", 1, 1, True)]


def test_manifest_upsert(spark):
    manifest = spark.createDataFrame([("a", 3, "1"), ("b", None, "2")], "normalized_name string, page_count int, file_id string")
    listing = spark.createDataFrame([("A.pdf", "1"), ("B.pdf", "2"), ("C d.pdf", "3")], "name string, file_id string")
    assert rows(corpus.manifest_upsert(manifest, listing), "normalized_name", "page_count", "file_id") == [
        ("a", 3, "1"), ("b", None, "2"), ("c_d", None, "3"),
    ]
    again = corpus.manifest_upsert(manifest, listing, F.lit(7), retry_nulls=True)
    assert rows(again, "normalized_name", "page_count") == [("a", 3), ("b", 7), ("c_d", 7)]
    same = corpus.manifest_upsert(manifest, listing.filter("file_id = '1'"))
    assert same.count() == 2


def test_positions(spark):
    df = spark.range(5).withColumnRenamed("id", "pos")
    assert corpus.first_positions(df, 2).count() == 2
    assert corpus.first_positions(df, 0).count() == corpus.first_positions(df, None).count() == 5
    assert corpus.at_position(df, 3).first()["pos"] == 3


def test_eligibility(spark):
    data = [("t", "c", "o", "g"), (None, "", "o", "g"), ("t", "", None, "g"), ("", "c", "o", None)]
    df = spark.createDataFrame(data, "title string, content string, original_abstract string, generated_abstract string")
    reasons = [r["reject_reason"] for r in filters.eligibility(df).collect()]
    assert reasons == [None, "no source article", "no original abstract", "no generated abstract"]
    assert filters.scorable(df).count() == 1
    ok = df.select(filters.succeeded("generated_abstract").alias("v"))
    assert [r["v"] for r in ok.collect()] == [True, True, True, False]
