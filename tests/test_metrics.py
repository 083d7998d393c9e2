import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioframe.functions import stemming, tokens as token_arrays
from folioframe.functions.lcs import lcs_length
from folioframe.functions.stemming import stem
from folioframe.operators import hooks, metrics
from folioframe.plans import evaluation

TEXTS = [
    ("the cat sat on the mat", "the cat lay on a mat"), ("same text here", "same text here"), ("one two", "three four"),
    ("", "something"), ("", ""), ("!!!", "?"), ("été à la plage", "Ete A LA Plage"), ("a a a b", "a b b a a"), ("word", None),
    ("running dogs", "the dog runs"),
]


def tokens(text):
    return re.findall("[a-z0-9]+", (text or "").lower())


def table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], max(row[j], row[j - 1], last + (x == y))
    return row[-1]


def prf(hits, n_ref, n_cand):
    p, r = hits / max(n_cand, 1), hits / max(n_ref, 1)
    return p, r, 2 * p * r / (p + r) if p + r else 0.0


def overlap(a, b, n):
    grams = lambda t: Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1))
    x, y = grams(a), grams(b)
    return prf(sum((x & y).values()), sum(x.values()), sum(y.values()))


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(i, "ab"[i % 2], r, c) for i, (r, c) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "pair_id long, model string, reference_text string, candidate_text string")


def result(df, prefix):
    return {r["pair_id"]: tuple(r[f"{prefix}_{c}"] for c in ("precision", "recall", "f")) for r in df.collect()}


def close(found, expected):
    assert found.keys() == expected.keys()
    for key, value in expected.items():
        assert found[key] == pytest.approx(value), key


@pytest.mark.parametrize("n", [1, 2, 3])
def test_rouge_n(pairs, n):
    close(result(metrics.rouge_n(pairs, n), f"rouge{n}"), {i: overlap(tokens(a), tokens(b), n) for i, (a, b) in enumerate(TEXTS)})


def test_overlap_of_random_and_repetitive_texts(spark):
    random.seed(11)
    rows = [(i, *[" ".join(random.choice(["a", "aa", "b", "a1", "c"]) for _ in range(random.randrange(60))) for _ in "rc"]) for i in range(150)]
    rows.append((150, "word " * 200_000, "word " * 150_000 + "other"))
    df = spark.createDataFrame(rows, "pair_id long, reference_text string, candidate_text string")
    scored = metrics.rouge_n(df, (1, 2, 4)).cache()
    for n in (1, 2, 4):
        close(result(scored, f"rouge{n}"), {i: overlap(tokens(a), tokens(b), n) for i, a, b in rows})
    sets = {i: prf(len(set(tokens(a)) & set(tokens(b))), len(set(tokens(a))), len(set(tokens(b)))) for i, a, b in rows}
    close(result(metrics.unigram_scores(df, distinct=True), "unigram"), sets)


def test_rouge_l(pairs):
    expected = {i: prf(table(tokens(a), tokens(b)), len(tokens(a)), len(tokens(b))) for i, (a, b) in enumerate(TEXTS)}
    close(result(metrics.rouge_l(pairs), "rougeL"), expected)


def test_combined_equals_separate(pairs):
    for stemmed in (False, True):
        joint = {r["pair_id"]: (r["rouge1"], r["rouge2"], r["rougeL"]) for r in metrics.rouge(pairs, stemmed=stemmed).collect()}
        one, two = (result(metrics.rouge_n(pairs, n, stemmed=stemmed), f"rouge{n}") for n in (1, 2))
        longest = result(metrics.rouge_l(pairs, stemmed=stemmed), "rougeL")
        close(joint, {k: (one[k][2], two[k][2], longest[k][2]) for k in one})
        assert all(0 <= v <= 1 for row in joint.values() for v in row)
        assert joint[1] == pytest.approx((1, 1, 1)) and joint[2] == (0, 0, 0)
        assert all(longest[k][1] <= one[k][1] + 1e-12 for k in one)


def test_unigram_sets(pairs):
    def expected(a, b):
        x, y = set(tokens(a)), set(tokens(b))
        return prf(len(x & y), len(x), len(y))

    close(result(metrics.unigram_scores(pairs, distinct=True), "unigram"), {i: expected(a, b) for i, (a, b) in enumerate(TEXTS)})
    close(result(metrics.unigram_scores(pairs), "unigram"), {i: overlap(tokens(a), tokens(b), 1) for i, (a, b) in enumerate(TEXTS)})


@given(st.lists(st.sampled_from("abc"), max_size=40), st.lists(st.sampled_from("abc"), max_size=40), st.integers(1, 50))
def test_lcs_equals_dynamic_program(a, b, width):
    assert lcs_length(a, b, width) == lcs_length(b, a, width) == table(a, b) <= min(len(a), len(b))


def test_lcs_of_long_texts():
    random.seed(3)
    a, b = ([random.choice("abcdefgh") for _ in range(n)] for n in (3000, 1200))
    assert lcs_length(a, b, 512) == lcs_length(a, b) == table(a, b)


# Words and stems from the published description of the algorithm.
STEMS = {
    "caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster",
    "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size",
    "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "relational": "relat", "conditional": "condit", "rational": "ration",
    "valenci": "valenc", "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "differentli": "differ",
    "vileli": "vile", "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "formalize": "formal",
    "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv",
    "allowance": "allow", "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust",
    "defensible": "defens", "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend",
    "adoption": "adopt", "homologou": "homolog", "communism": "commun", "activate": "activ", "angulariti": "angular",
    "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate",
    "cease": "ceas", "controll": "control", "roll": "roll", "the": "the", "was": "was", "dies": "die", "dying": "die",
}


def test_stems():
    assert {w: stem(w) for w in STEMS} == STEMS


def test_cosine(spark):
    rows = [(0, [1.0, 0.0], [1.0, 1.0]), (1, [0.0, 0.0], [1.0, 2.0]), (2, [1.0, 2.0], [-1.0, -2.0])]
    df = spark.createDataFrame(rows, "pair_id int, a array<float>, b array<float>")
    out = {r["pair_id"]: r["similarity"] for r in metrics.cosine_scores(df, ["pair_id"], "a", "b").collect()}
    assert out == pytest.approx({0: 2**-0.5, 1: 0.0, 2: -1.0})


@pytest.mark.parametrize("block", [2, 512])
def test_bert_score(spark, block):
    rng = np.random.default_rng(7)
    rows, expected = [], {}
    for pair, (n, m) in enumerate([(5, 3), (1, 7), (0, 2), (4, 4)]):
        a, b = rng.normal(size=(n, 6)).astype("float32"), rng.normal(size=(m, 6)).astype("float32")
        if pair == 3:
            b[0] = 0
        rows += [(pair, "reference", i, v.tolist()) for i, v in enumerate(a)]
        rows += [(pair, "candidate", i, v.tolist()) for i, v in enumerate(b)]
        if n and m:
            unit = lambda x: np.nan_to_num(x.astype("float64") / np.linalg.norm(x.astype("float64"), axis=1, keepdims=True))
            s = unit(a) @ unit(b).T
            p, r = s.max(axis=0).mean(), s.max(axis=1).mean()
            expected[pair] = (p, r, 2 * p * r / (p + r))
        else:
            expected[pair] = (0.0, 0.0, 0.0)
    df = spark.createDataFrame(rows, "pair_id int, side string, tok int, vec array<float>").repartition(3)
    out = {r["pair_id"]: (r["bert_precision"], r["bert_recall"], r["bert_f1"]) for r in metrics.bert_score(df, block=block).collect()}
    close(out, expected)


def test_bert_score_plan_and_odd_rows(spark):
    """Each vector is shuffled once, and there is no pandas; a token given twice counts by its best."""
    rows = [("m", 0, "reference", 0, [1.0, 0.0]), ("m", 0, "reference", 1, [0.0, 1.0]), ("m", 0, "candidate", 5, [1.0, 1.0]),
            ("m", 0, "candidate", 5, [2.0, 0.0]), ("m", 0, "candidate", 6, None), (None, 1, "reference", 0, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "model string, pair_id int, side string, tok int, vec array<float>")
    scored = metrics.bert_score(df, ["model", "pair_id"])
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "InPandas" not in plan and "FlatMapCoGroupsInArrow" in plan
    out = {(r["model"], r["pair_id"]): (r["bert_precision"], r["bert_recall"]) for r in scored.collect()}
    close(out, {("m", 0): (1.0, (1 + 0.5**0.5) / 2), (None, 1): (0.0, 0.0)})
    every = spark.createDataFrame([("m", 0), ("m", 9)], "model string, pair_id int")
    assert {r["pair_id"]: r["bert_f1"] > 0 for r in metrics.bert_score(df, ["model", "pair_id"], pairs=every).collect()} == {0: True, 9: False}


def test_best_matches_by_tiles():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(17, 4)), rng.normal(size=(9, 4))
    for tile in (1, 4, 100):
        rows, columns = metrics.best_matches(a, b, tile)
        assert np.allclose(rows, (a @ b.T).max(axis=1)) and np.allclose(columns, (a @ b.T).max(axis=0))


def test_vector_store_encodes_each_text_once(spark, tmp_path):
    calls, store = tmp_path / "calls", str(tmp_path / "store")
    calls.mkdir()

    def counting(name):
        def make():
            def encode(texts):
                if "fails" in texts:
                    raise ValueError
                for text in texts:
                    with (calls / name).open("a") as log:
                        log.write(text + "\n")
                return [[float(len(t)), 1.0] for t in texts]

            return encode

        return make

    def seen(name):
        return sorted((calls / name).read_text().split()) if (calls / name).exists() else []

    rows = [(0, "aa", "bbb"), (1, "bbb", "aa"), (2, "aa", "aa"), (3, None, "aa"), (4, "fails", "cccc")]
    pairs = spark.createDataFrame(rows, "pair_id int, reference_text string, candidate_text string")
    encoders = {"x": counting("x"), "y": counting("y")}
    cosine = lambda n, m: (n * m + 1) / ((n * n + 1) * (m * m + 1)) ** 0.5
    for _ in range(2):
        out = metrics.similarity_of_texts(pairs, encoders, store=store).collect()
        assert len(out) == 10
        for name in encoders:
            got = {r["pair_id"]: r["similarity"] for r in out if r["encoder"] == name}
            assert got[3] is None and got[4] is None
            assert [got[i] for i in range(3)] == pytest.approx([cosine(2, 3), cosine(3, 2), 1.0])
            assert seen(name) == ["aa", "bbb", "cccc"]
    more = spark.createDataFrame([(9, "aa", "new")], pairs.schema)
    assert metrics.similarity_of_texts(more, {"x": counting("x")}, store=store).count() == 1
    assert seen("x") == ["aa", "bbb", "cccc", "new"] and seen("y") == ["aa", "bbb", "cccc"]


def test_roll_ups(pairs):
    scored = metrics.rouge_n(pairs, 1, keys=("pair_id", "model"))
    values = {r["pair_id"]: r["rouge1_f"] for r in scored.collect()}
    means = {r["model"]: r for r in metrics.roll_up_with_total(scored, ["rouge1_f"], ["model"]).collect()}
    assert means[None]["average_rouge1_f"] == pytest.approx(np.mean(list(values.values())))
    assert means[None]["summary"] == "Overall Metrics" and means["a"]["summary"] is None
    assert means["a"]["average_rouge1_f"] == pytest.approx(np.mean([v for k, v in values.items() if k % 2 == 0]))
    rows = metrics.with_summary(scored.select("pair_id", "rouge1_f"), ["rouge1_f"]).collect()
    assert len(rows) == len(TEXTS) + 1
    last = [r for r in rows if r["summary"]][0]
    assert last["average_rouge1_f"] == pytest.approx(np.mean(list(values.values()))) and last["pair_id"] is None
    joined = metrics.benchmark_table({
        "x": metrics.roll_up(scored, ["rouge1_f"], ["model"]),
        "y": metrics.roll_up(scored.filter("model = 'a'").withColumnRenamed("rouge1_f", "z"), ["z"], ["model"]),
    })
    got = {r["model"]: r["average_z"] for r in joined.collect()}
    assert got["b"] is None and got["a"] is not None


def test_overlap_of_pairs_in_several_parts(spark, monkeypatch):
    """Parts of a few texts give what one part gives, and no array of tokens is made in the plan."""
    random.seed(12)
    rows = [(i, *[" ".join(random.choices(["runs", "running", "Éa", "b-c", "x"], k=random.randrange(40))) for _ in "rc"]) for i in range(200)]
    rows += [(200, None, "x"), (201, "x", None), (202, "", "")]
    df = spark.createDataFrame(rows, "pair_id long, reference_text string, candidate_text string").coalesce(1)
    whole = {r["pair_id"]: tuple(r) for r in metrics.rouge(df).collect()}
    monkeypatch.setattr(token_arrays, "PART_BYTES", 300)
    scored = metrics.rouge(df)
    assert {r["pair_id"]: tuple(r) for r in scored.collect()} == whole
    plan = scored._jdf.queryExecution().toString()
    assert "array_intersect" not in plan and "regexp_extract_all" not in plan
    stems = {i: [[stem(t) for t in tokens(x)] for x in (a, b)] for i, a, b in rows}
    expected = {i: (overlap(a, b, 1)[2], overlap(a, b, 2)[2], prf(table(a, b), len(a), len(b))[2]) for i, (a, b) in stems.items()}
    close({i: r[1:] for i, r in whole.items()}, expected)


def test_stems_are_kept_for_the_next_part(monkeypatch):
    calls = []
    monkeypatch.setattr(stemming, "stem", lambda w: calls.append(w) or stem(w))
    known = {}
    for words in (["runs ", "running ", "cats "], ["cats ", "runs "]):
        codes = stemming.stem_codes(pa.array(words), known)
        assert [codes[0] == c for c in codes] == [stem(words[0].strip()) == stem(w.strip()) for w in words]
    assert calls == ["runs", "running", "cats"]
    monkeypatch.setattr(stemming, "MOST_KNOWN", 2)
    stemming.stem_codes(pa.array(["dogs "]), known)
    assert list(known) == ["dogs "]


def test_many_words_are_stemmed_together(monkeypatch):
    """Rows of letters give the stems of the rules one by one, and leave only exceptions and long words to them."""
    rng = random.Random(8)
    endings = ["", "s", "ies", "sses", "ed", "ied", "eed", "ing", "y", "logi", "e", "ll", *stemming.STEP_2, *stemming.STEP_3, *stemming.STEP_4]
    words = {"".join(rng.choices("aeiouybclstwz9", k=rng.randrange(6))) + "".join(rng.choices(endings, k=2)) for _ in range(20_000)}
    plain = [*stemming.IRREGULAR, "z" * stemming.WIDTH + "ing", "z" * (stemming.WIDTH - 1) + "s", "éational"]
    words = sorted({*words, *STEMS, *plain})
    expected, calls = [stem(w) for w in words], []
    monkeypatch.setattr(stemming, "stem", lambda w: calls.append(w) or stem(w))
    for block in (100, 1 << 15):
        monkeypatch.setattr(stemming, "BLOCK", block)
        assert stemming.stems(pa.array(words)).to_pylist() == expected
    codes = stemming.stem_codes(pa.array([w + " " for w in words]), {}).tolist()
    assert len(set(zip(codes, expected))) == len(set(codes)) == len(set(expected))
    assert set(calls) <= set(plain)


@pytest.mark.parametrize("stemmed", [False, True])
def test_text_metrics_of_a_model_table_share_a_pass(spark, pairs, monkeypatch, stemmed):
    """Unigrams without stems come from the pass that ROUGE takes with them; a null model has a row a part, as before."""
    more = pairs.unionByName(pairs.limit(1).withColumn("model", F.lit(None).cast("string"))).unionByName(
        pairs.limit(1).withColumn("model", F.lit("c")).withColumn("reference_text", F.lit("running runs ran")).withColumn("candidate_text", F.lit("run runs")))
    passes, measure = [], metrics.overlap_of_texts
    monkeypatch.setattr(metrics, "overlap_of_texts", lambda *a, **k: passes.append(a) or measure(*a, **k))
    rows = evaluation.model_table(more, {"a": hooks.stub_encoder}, stemmed=stemmed).collect()
    assert len(passes) == 1
    out = {r["model"]: r for r in rows if r["model"]}
    assert out["c"]["average_unigram_f"] == pytest.approx(0.4) and out["c"]["average_rouge1"] == pytest.approx(0.8 if stemmed else 0.4)
    rouge, unigram = metrics.rouge(more, ["model", "pair_id"], stemmed=stemmed), metrics.unigram_scores(more, ["model", "pair_id"])
    for frame, name in ((rouge, "rouge1"), (rouge, "rouge2"), (rouge, "rougeL"), (unigram, "unigram_f")):
        expected = {r["model"]: r["m"] for r in frame.groupBy("model").agg(F.avg(name).alias("m")).collect()}
        assert {m: r[f"average_{name}"] for m, r in out.items()} == pytest.approx({m: v for m, v in expected.items() if m})
        assert [r[f"average_{name}"] for r in rows if r["model"] is None and r[f"average_{name}"] is not None] == [pytest.approx(expected[None])]
    assert len([r for r in rows if r["model"] is None]) == 3


def test_model_table_of_texts(spark, pairs):
    """ROUGE and unigram means of a model are those of plain Python."""
    out = {r["model"]: r for r in evaluation.model_table(pairs, {"a": hooks.stub_encoder}, stemmed=False).collect()}
    for k, model in enumerate("ab"):
        own = [(tokens(a), tokens(b)) for a, b in TEXTS[k::2]]
        for name, n in (("rouge1", 1), ("rouge2", 2), ("unigram_f", 1)):
            assert out[model][f"average_{name}"] == pytest.approx(sum(overlap(a, b, n)[2] for a, b in own) / len(own))
        assert out[model]["average_rougeL"] == pytest.approx(sum(prf(table(a, b), len(a), len(b))[2] for a, b in own) / len(own))
