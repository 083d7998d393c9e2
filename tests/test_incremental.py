import numpy as np
from pyspark.sql import functions as F

from folioframe.operators import hooks
from folioframe.plans import generation
from folioframe.streaming import incremental, key_index


def stream(spark, folder):
    return spark.readStream.schema("k long, body string").parquet(folder)


def add(spark, folder, rows):
    spark.createDataFrame(rows, "k long, body string").coalesce(1).write.mode("append").parquet(folder)


def test_stream_append_is_incremental_and_idempotent(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    add(spark, source, [(1, "a"), (2, "b"), (2, "b")])
    incremental.stream_append(stream(spark, source), out, state, "k")
    add(spark, source, [(2, "again"), (3, "c")])
    incremental.stream_append(stream(spark, source), out, state, "k")
    incremental.stream_append(stream(spark, source), out, str(tmp_path / "lost state"), "k")
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_failures_are_retried(spark, tmp_path):
    source, out, failed, state = (str(tmp_path / n) for n in ("in", "out", "failed", "state"))
    add(spark, source, [(1, "ok"), (2, "bad")])

    def convert(broken):
        return lambda df: df.select("k", "body", F.upper("body").alias("done"), F.when(F.col("body").isin(*broken), "cannot").alias("error"))

    args = ("k", out, failed, state)
    incremental.convert_incrementally(stream(spark, source), convert(["bad"]), *args)
    assert [r["k"] for r in spark.read.parquet(out).collect()] == [1]
    schema = stream(spark, source).schema
    assert [r["k"] for r in incremental.unresolved(spark, failed, out, schema, "k").collect()] == [2]
    add(spark, source, [(3, "ok")])
    incremental.convert_incrementally(stream(spark, source), convert(["none"]), *args)
    assert sorted((r["k"], r["done"]) for r in spark.read.parquet(out).collect()) == [(1, "OK"), (2, "BAD"), (3, "OK")]
    assert incremental.unresolved(spark, failed, out, schema, "k").count() == 0


def test_generation_resumes(spark, tmp_path):
    articles = spark.createDataFrame([(i, f"t{i}", f"a{i}", f"c{i}") for i in range(12)], "pos long, title string, abstract string, content string")
    whole, halves = str(tmp_path / "whole"), str(tmp_path / "halves")
    models, template = ["m1", "m2"], "{title}|{content}"
    one = generation.generate_missing(articles, models, template, hooks.stub_generator, whole)
    generation.generate_missing(articles.filter("pos < 6"), models, template, hooks.stub_generator, halves)
    two = generation.generate_missing(articles, models, template, hooks.stub_generator, halves)
    rows = lambda df: sorted((r["model"], r["pos"], r["text"]) for r in df.collect())
    assert rows(one) == rows(two)

    def always():
        return lambda prompts, models, options: ["late" for _ in prompts]

    full = generation.generate_missing(articles, models, template, always, halves)
    assert full.count() == 24
    published = generation.published(full, articles)
    assert published.count() == 24 and published.filter("original_abstract = 'a3'").count() == 2
    assert generation.published(full.filter("not (model = 'm2' and pos = 0)"), articles).count() == 12


def test_append_is_the_same_on_every_run(spark, tmp_path):
    rows = [(1, "b"), (1, "a"), (1, "c"), (None, "x"), (2, None)]
    seen = set()
    for i in range(3):
        path = str(tmp_path / f"t{i}")
        batch = spark.createDataFrame(rows, "k long, body string").repartition(i + 1)
        incremental.append_unseen(batch, path, "k")
        incremental.append_unseen(batch, path, "k")
        seen.add(tuple(sorted((r["k"], r["body"]) for r in spark.read.parquet(path).collect())))
    assert len(seen) == 1 and {k for k, _ in seen.pop()} == {1, 2}


def test_a_batch_reads_only_files_that_may_hold_its_keys(spark, tmp_path):
    path = str(tmp_path / "sink")
    for start in range(0, 4000, 1000):
        incremental.append_unseen(spark.range(start, start + 1000).select(F.col("id").alias("k"), F.lit("x").alias("body")), path, "k")
    everything = spark.read.parquet(path)
    assert everything.count() == 4000 and everything.columns == ["k", "body"]
    files = everything.inputFiles()
    assert len(files) >= 4
    filters = key_index.key_filters(spark, path)
    assert {r["file"] for r in filters.select("file").distinct().collect()} == set(files)
    assert filters.agg(F.sum("hashes")).first()[0] == 4000

    def may_hold(*keys):
        return key_index.files_with(spark.createDataFrame([(k,) for k in keys], "k long"), path, ["k"])

    held = {r["k"]: r["f"] for r in everything.select("k", F.input_file_name().alias("f")).collect()}
    assert held[0] in may_hold(0) and len(may_hold(0)) <= 2
    assert {held[1234], held[1999]} <= set(may_hold(1234, 1999)) and len(may_hold(1234, 1999)) <= 3
    assert len(may_hold(10_000)) <= 1
    repeated = spark.range(2000, 2300).select(F.col("id").alias("k"), F.lit("again").alias("body"))
    plan = incremental.unseen(repeated, path, "k")._jdf.queryExecution().executedPlan().toString()
    read = incremental.unseen(repeated, path, "k")
    assert read.count() == 0 and "FileScan parquet" in plan
    incremental.append_unseen(repeated.union(spark.createDataFrame([(7_000, "new")], "k long, body string")), path, "k")
    assert spark.read.parquet(path).count() == 4001


def test_filters_of_other_buckets_are_not_read(spark, tmp_path):
    path = str(tmp_path / "sink")
    incremental.append_unseen(spark.range(3000).select(F.col("id").alias("k")), path, "k")
    one = key_index._of_buckets(key_index.key_filters(spark, path), [3])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(zone" in plan or "PartitionFilters: [isnotnull(zone" in plan
    assert len(one.select("bits").collect()) == 1 and len(one.inputFiles()) >= 8


def test_a_table_written_by_others_is_indexed_on_the_way(spark, tmp_path):
    path = str(tmp_path / "sink")
    spark.createDataFrame([(i, "old") for i in range(20)], "k long, body string").write.parquet(path)
    assert key_index.files_with(spark.createDataFrame([(99,)], "k long"), path, ["k"])
    incremental.append_unseen(spark.createDataFrame([(3, "new"), (30, "new")], "k long, body string"), path, "k")
    # a writer that died before it made its filters
    spark.createDataFrame([(40, "late")], "k long, body string").write.mode("append").parquet(path)
    incremental.append_unseen(spark.createDataFrame([(40, "twice"), (41, "new")], "k long, body string"), path, "k")
    rows = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert rows == [(i, "old") for i in range(20)] + [(30, "new"), (40, "late"), (41, "new")]


def test_key_filters_lose_no_key():
    hashes = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000, dtype=np.int64)
    bits = key_index.make_filter(hashes[:2500])
    assert all(key_index.any_passes(bits, hashes[i : i + 1]) for i in range(2500))
    assert sum(key_index.any_passes(bits, hashes[i : i + 1]) for i in range(2500, 5000)) < 75
    assert key_index.any_passes(key_index.make_filter(hashes[:1]), hashes[:3])


def test_two_part_keys(spark, tmp_path):
    path = str(tmp_path / "a sink, 100%25")
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "m string, k int, body string")
    for _ in range(2):
        incremental.append_unseen(rows, path, ["m", "k"])
    assert spark.read.parquet(path).count() == 3
    names = [r["file"] for r in key_index.key_filters(spark, path).select("file").distinct().collect()]
    assert set(names) == set(spark.read.parquet(path).inputFiles())
