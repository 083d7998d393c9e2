import hashlib
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from folioframe.functions import tokens
from folioframe.operators import corpus, datasets, profile


def test_assemble_pages(spark):
    data = [("d", i, f"p{i}") for i in range(4094, 4098)] + [("e", 0, "x"), ("e", 2, None), (None, 1, "y")]
    pages = spark.createDataFrame(data, "doc string, page long, text string").repartition(4)
    out = {r["doc"]: (r["n_pages"], r["text"]) for r in corpus.assemble_pages(pages, "doc", "page", "text").collect()}
    assert out == {
        "d": (4, "".join(f"p{i}\n\n" for i in range(4094, 4098))), "e": (2, "x\n\n\n\n"), None: (1, "y\n\n"),
    }


def test_sections(spark):
    text = "Front\nmatter\nIntroduction\nbody one\n2 Method\nbody two"
    df = spark.createDataFrame([(1, text), (2, "no headings"), (3, "")], "id long, text string")
    out = corpus.sections(df, "id", "text", r"Introduction|\d+ [A-Z]\w+").orderBy("id", "section").collect()
    assert [(r["id"], r["section"], r["heading"], r["body"]) for r in out] == [
        (1, 0, "", "Front\nmatter\n"), (1, 1, "Introduction", "\nbody one\n"), (1, 2, "2 Method", "\nbody two"),
        (2, 0, "", "no headings"), (3, 0, "", ""),
    ]


def test_sections_keep_control_characters(spark):
    df = spark.createDataFrame([(1, "x\x01y\x02z keep\x02end"), (2, "H\na\x01b\nH\n\x02c")], "id long, text string")
    out = corpus.sections(df, "id", "text", "H").orderBy("id", "section").collect()
    assert [tuple(r) for r in out] == [
        (1, 0, "", "x\x01y\x02z keep\x02end"), (2, 0, "", ""), (2, 1, "H", "\na\x01b\n"), (2, 2, "H", "\n\x02c"),
    ]


def test_complete_models_counts_listed_articles(spark):
    articles = spark.createDataFrame([(0,), (1,)], "pos long")
    results = spark.createDataFrame(
        [("m", 0), ("m", 0), ("n", 0), ("n", 1), ("n", 1), ("o", 0), ("o", 7)], "model string, pos long"
    )
    assert [tuple(r) for r in corpus.complete_models(results, articles).collect()] == [("n", 2, 2)]
    assert corpus.publishable(results, articles).count() == 3


def test_article_parts(spark):
    text = "My Title\nAbstract\nshort text\nIntroduction\nlong\ntext"
    df = spark.createDataFrame([(1, text), (2, "Only Title\nbody")], "id long, text string")
    out = {r["id"]: r for r in corpus.article_parts(df, "id", "text", "Abstract", "Introduction").collect()}
    assert (out[1]["title"], out[1]["abstract"], out[1]["content"]) == ("My Title", "short text\n", "Introduction\nlong\ntext")
    assert (out[2]["title"], out[2]["abstract"], out[2]["content"]) == ("Only Title", "", "body")


@pytest.mark.parametrize("n_samples", [None, 3])
def test_trigrams_in_a_corpus(spark, n_samples):
    """Against sets in plain Python: nulls, short texts, repeated and null keys, clashing names, a hot sequence."""
    random.seed(3)
    pool = ["red", "Fish", "two", "sky"]
    own = [(i % 40 if i % 9 else None, " ".join(random.choices(pool, k=random.randrange(14)))) for i in range(60)]
    own += [(90, None), (91, ""), (92, "one two"), (93, "never seen words here"), (94, "Red, red; RED red")]
    other = [" ".join(random.choices(pool, k=random.randrange(6))) for _ in range(12)] + ["red red red"] * 30 + [None, "", "fish"]
    schema = "k int, text string, _known string, n_found int"
    checked = spark.createDataFrame([(k, t, "x", 1) for k, t in own], schema).repartition(3)
    against = spark.createDataFrame([(i, t, "y", 2) for i, t in enumerate(other)], schema)

    def grams(text):
        tokens = re.findall("[a-z0-9]+", (text or "").lower())
        return {" ".join(tokens[i : i + 3]) for i in range(len(tokens) - 2)}

    known, tested = set().union(*map(grams, other)), {}
    for k, text in own:
        ranked = sorted(grams(text), key=lambda g: hashlib.md5(f"check:{g}".encode()).hexdigest())
        tested.setdefault(k, set()).update(ranked[:n_samples])
    out = corpus.trigram_check_in_corpus(checked, against, "k", n_samples=n_samples).collect()
    assert {r["k"]: (r["n_sampled"], r["n_found"]) for r in out} == {k: (len(g), len(g & known)) for k, g in tested.items()}
    assert len(out) == len(tested)
    none = corpus.trigram_check_in_corpus(checked, against.where("false"), "k")
    assert none.agg({"n_found": "sum"}).first()[0] == 0
    assert corpus.trigram_check_in_corpus(checked.where("false"), against, "k").count() == 0


def test_a_corpus_sends_only_sequences_that_may_be_asked_for(spark):
    """Also texts cut into several blocks of hashes, and one longer than a part."""
    random.seed(5)
    long = " ".join(f"w{random.randrange(900)}" for _ in range(200_000)) + " " + "z" * tokens.PART_BYTES
    rows = [(0, long), (1, "Éa, b-c; d"), (2, None), (3, "e f"), (4, "g h i"), (5, "j k l m")]
    texts = spark.createDataFrame(rows, "k int, text string").coalesce(1)
    asked = spark.createDataFrame([("a b c",), ("b c d",), ("g h i",), ("h i j",), (" ".join(long.split()[150_000:150_003]),), (None,)], "_gram string")
    sieve = corpus._sieve(asked)
    sent = [r["_known"] for r in corpus._known_trigrams(texts, "text", sieve).collect()]
    assert set(sent) >= {r["_gram"] for r in asked.collect()} - {"h i j", None} and len(sent) < 50
    every = {r["_known"] for r in corpus._known_trigrams(texts, "text", None).collect()}
    words = long.split()
    assert every == {" ".join(words[i : i + 3]) for i in range(len(words) - 2)} | {"a b c", "b c d", "g h i", "j k l", "k l m"}


def test_sampled_sequences_of_a_long_text(spark):
    """The smallest digests of a text whose sequences repeat; rows without any keep their key."""
    random.seed(6)
    rows = [(1, " ".join(random.choices("abcdefgh", k=3000))), (2, "a b c"), (3, "")]
    out = corpus._asked_trigrams(spark.createDataFrame(rows, "k int, text string"), "k", "text", 100, "check").collect()
    own = {rows[0][1][i : i + 5] for i in range(0, 2 * 2998, 2)}
    ranked = sorted(own, key=lambda g: hashlib.md5(f"check:{g}".encode()).hexdigest())
    assert [r["_gram"] for r in out if r["_key"] == 1] == ranked[:100]
    assert [(r["_key"], r["_gram"]) for r in out if r["_key"] != 1] == [(2, "a b c"), (3, None)]


def test_a_sample_sends_only_what_a_small_corpus_may_hold(spark, monkeypatch):
    """Long texts in several blocks of digests, with hits in and outside of their samples; repeated and null keys."""
    random.seed(7)
    texts = [" ".join(f"w{random.randrange(60)}" for _ in range(random.choice([0, 2, 20, 400, 3000]))) for _ in range(60)]
    texts += [None, "red red " * 700]
    own = [(None if i % 20 == 7 else i % 50, t) for i, t in enumerate(texts)]
    other = [" ".join(random.sample((texts[i] or "").split() or ["x"], 1) + (texts[i] or "").split()[30:60]) for i in range(0, 60, 4)]
    checked = spark.createDataFrame(own, "k int, text string").repartition(3)
    against = spark.createDataFrame([(t,) for t in [*other, "red red red", None]], "text string")
    sent, write = [], corpus.cut

    def counted(df, label):
        out = write(df, label)
        if label == "asked":
            sent.append(out[0].where("_gram IS NOT NULL").join(checked.groupBy(F.col("k").alias("_key")).count().where("count = 1"), "_key").count())
        return out

    monkeypatch.setattr(corpus, "cut", counted)

    def grams(text):
        words = (text or "").split()
        return {" ".join(words[i : i + 3]) for i in range(len(words) - 2)}

    known, tested = set().union(*map(grams, other), {"red red red"}), {}
    for k, text in own:
        ranked = sorted(grams(text), key=lambda g: hashlib.md5(f"check:{g}".encode()).hexdigest())
        tested.setdefault(k, set()).update(ranked[:100])
    expected = {k: (len(g), len(g & known)) for k, g in tested.items()}
    assert any(0 < found < 10 for n, found in expected.values() if n == 100)
    out = corpus.trigram_check_in_corpus(checked, against, "k", n_samples=100).collect()
    assert {r["k"]: (r["n_sampled"], r["n_found"]) for r in out} == expected and len(out) == len(expected)
    alone = [k for k in tested if [x for x, _ in own].count(k) == 1]
    assert sent == [sum(expected[k][1] for k in alone)]
    # a corpus that may have too many sequences for a sieve
    monkeypatch.setattr(corpus, "SIEVE_GRAMS", 10)
    out = corpus.trigram_check_in_corpus(checked, against, "k", n_samples=100).collect()
    assert {r["k"]: (r["n_sampled"], r["n_found"]) for r in out} == expected


def test_trigram_check(spark):
    df = spark.createDataFrame([(1, "a b c d e", "x a b c d y"), (2, "a b", "a b"), (3, "a a a a a", "a a a")], "k int, l string, r string")
    out = corpus.trigram_check(df, ["k"], "l", "r", 2, "s").orderBy("k").collect()
    def expected(left, right):
        grams = lambda t: [" ".join(t[i : i + 3]) for i in range(len(t) - 2)]
        own = sorted(set(grams(left.split())), key=lambda g: hashlib.md5(f"s:{g}".encode()).hexdigest())[:2]
        return len(own), len(set(own) & set(grams(right.split())))

    assert [(r["n_sampled"], r["n_found"]) for r in out] == [expected(r["l"], r["r"]) for r in df.orderBy("k").collect()]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_fuzzy_titles_equal_brute_force(spark, k):
    random.seed(k)
    base = ["".join(random.choice("ab") for _ in range(random.randrange(0, 14))) for _ in range(60)]
    other = ["".join(random.choice("ab") for _ in range(random.randrange(0, 14))) for _ in range(60)]
    left = spark.createDataFrame([(t,) for t in base + base[:9]], "title string")
    right = spark.createDataFrame([(t,) for t in other], "title string")
    found = {(r[0], r[1], r[2]) for r in corpus.fuzzy_title_match(left, right, max_distance=k).collect()}
    assert found == {(a, b, distance(a, b)) for a in base for b in other if distance(a, b) <= k}


def test_splits(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    for split in (datasets.hash_split, datasets.exact_split):
        a = {r["k"]: r["split"] for r in split(df.repartition(3), "k").collect()}
        b = {r["k"]: r["split"] for r in split(df.repartition(11), "k").collect()}
        assert a == b and len(a) == 1003 and set(a.values()) == {"train", "validation"}
    order = sorted(range(1003), key=lambda k: (hashlib.md5(f"3407:{k}".encode()).hexdigest(), k))
    assert {k for k, s in a.items() if s == "validation"} == set(order[:201])


@pytest.mark.parametrize("prefix", [1, 2, 4])
def test_exact_split_at_any_prefix(spark, monkeypatch, prefix):
    monkeypatch.setattr(datasets, "PREFIX", prefix)
    df = spark.range(500).withColumnRenamed("id", "k")
    for share in (0.0, 0.013, 0.5, 1.0):
        n = datasets.exact_split(df, "k", share).filter("split = 'validation'").count()
        assert n == -(-500 * share // 1)


def test_budget(spark):
    texts = ["a  b\nc", "x", "", " a\n\nb  c", "a\nb ", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    out = datasets.fit_budget(df, "t", 2).orderBy("k").collect()
    assert [(r["n_tokens"], r["over_budget"], r["budget_text"]) for r in out[:5]] == [
        (3, True, "a  b"), (1, False, "x"), (0, False, ""), (3, True, " a\n\nb"), (2, False, "a\nb "),
    ]
    assert out[5]["budget_text"] is None
    assert datasets.fit_budget(df, "t", 0).orderBy("k").first()["budget_text"] == ""
    report = datasets.budget_report(df.where("k < 3"), "t", [0, 2]).first()
    assert (report["n_rows"], report["n_tokens"], report["over_0"], report["over_2"]) == (3, 4, 2, 1)


def test_profile(spark):
    random.seed(1)
    xs = [random.choice([None, *range(20)]) for _ in range(200)]
    df = spark.createDataFrame([(x, 1.5, "s") for x in xs], "x int, y double, s string")
    known = [x for x in xs if x is not None]
    out = {r["column"]: r for r in profile.describe(df, ["x", "y"]).collect()}
    q = statistics.quantiles(known, n=4, method="inclusive")
    assert [out["x"][c] for c in ("q25", "q50", "q75")] == pytest.approx(q)
    assert out["x"]["n"] == len(known) and out["x"]["std"] == pytest.approx(statistics.stdev(known))
    assert (out["y"]["min"], out["y"]["q50"], out["y"]["max"]) == (1.5, 1.5, 1.5)
    rough = {r["column"]: r for r in profile.describe_roughly(df, ["x"]).collect()}
    assert rough["x"]["q50"] in known
    counts = {r["column"]: (r["n_rows"], r["n_non_null"]) for r in profile.row_counts(df).collect()}
    assert counts == {"x": (200, len(known)), "y": (200, 200), "s": (200, 200)}
    assert [r["type"] for r in profile.column_types(df).orderBy("position").collect()] == ["int", "double", "string"]


def test_order_statistics(spark, monkeypatch):
    """Radix selection over every kind of double, with and without the short cut to all bits."""
    random.seed(4)
    odd = [0.0, -0.0, 1e308, -1e308, 5e-324, -5e-324, float("inf"), float("-inf"), float("nan"), 1.5, 1.5, 1.5000000000000002]
    xs = [*odd, *(random.uniform(-1, 1) * 10 ** random.randint(-300, 300) for _ in range(150)), *map(float, range(-40, 40)), None]
    ys = [random.choice([None, 3]) for _ in xs]
    df = spark.createDataFrame(list(zip(xs, ys, strict=True)), "x double, y int").repartition(3)
    known = sorted((x for x in xs if x is not None), key=lambda x: (x != x, x))
    ranks = {"x": set(range(0, len(known), 3)) | {len(known) - 1}, "y": {0}}
    for few in (1 << 20, 1):
        monkeypatch.setattr(profile, "_FEW", few)
        found = profile.order_statistics(df, ranks)
        assert [str(found["x", r] + 0.0) for r in sorted(ranks["x"])] == [str(known[r] + 0.0) for r in sorted(ranks["x"])]
        assert found["y", 0] == 3.0 and len(found) == len(ranks["x"]) + 1
    assert profile.order_statistics(df, {"x": set()}) == {}
    assert profile.describe(df.where("y > 3"), ["x", "y"]).count() == 0
    assert profile.describe(spark.createDataFrame([], "x double"), ["x"]).count() == 0
