"""Operators against plain Python on small tables with nulls, ties, repeats and odd texts."""

import hashlib
import random

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from folioframe.llm import compression_bands, crowds, direct_codes, leaks, near_duplicates, packing, repeats, token_counts, token_ids
from folioframe.llm.wordids import WordIds
from folioframe.session import scratch_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, bucket int, rep string, hash string"


def corpus():
    """Texts of every odd kind: null, empty, blank, long, alike, equal, self-repeating."""
    random.seed(5)
    vocabulary = [random.choice("bcdfg") + random.choice("aeiou") + random.choice(["n", "ß", "T", "é.", ","]) for _ in range(300)]
    prose = lambda n: [random.choice(vocabulary) for _ in range(n)]
    base, passage, chorus = prose(200), prose(60), prose(50)
    texts = [None, "", " \t\n ", "one", "one", "One two", "x" * 5000, "\x85 \xa0　 a\x0bb\x1cc", "a b c d", "A B c d"]
    texts += [" ".join(base)] * 3
    for change in (1, 2, 4, 8, 20):
        edited = list(base)
        for i in random.sample(range(200), change):
            edited[i] = "new" + str(i)
        texts.append(" ".join(edited).replace(" ", "\n", change))
    texts += [" ".join([*prose(30), *passage, *prose(40)]) for _ in range(4)]
    texts.append(" ".join([*chorus, *prose(20), *chorus]))
    texts.append(" ".join(prose(20_000)))
    texts.append(("spam ham " * 2000).strip())
    texts += [" ".join(prose(n)) for n in (9, 10, 34, 35, 36, 90, 300)]
    texts += ["#$%& " * 30 + "\n\nline\nline\n line\n", "<|endoftext|> a <|startoftext|>b", "Don't. We're! 3½ Σς ﬁ 漢字 🙂"]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    table = [(i, t, "en", "s", len(t or ""), 1, "x", "y") for i, t in rows]
    return spark.createDataFrame(table, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Rows without an id, and the same rows twice."""
    text = " ".join(f"w{i}" for i in range(60))
    return spark.createDataFrame([(None, text), (None, None), (7, text), (7, text), (8, "short one")], "doc_id bigint, text string")


def test_quality_rules(docs, rows, empty, odd):
    got = {r["doc_id"]: r.asDict() for r in compression_bands.quality_rules(docs).collect()}
    assert len(got) == len(rows)
    for one, text in rows:
        expected = brute.quality(text)
        assert {k: got[one][k] for k in expected} == expected
        assert not (got[one]["base_failed"] and got[one]["kept"])
    assert compression_bands.quality_rules(empty).count() == 0
    assert compression_bands.quality_rules(odd).count() == 5
    kept = {r["doc_id"] for r in compression_bands.keep_quality(docs).collect()}
    assert kept == {one for one, r in got.items() if r["kept"]}
    assert compression_bands.keep_quality(docs).schema == docs.schema


def test_bands_reject_repetition_and_noise():
    random.seed(1)
    judge = compression_bands.Bands()
    noise = "".join(random.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=4000)).encode()
    prose = " ".join("".join(random.choices("etaoinshrdlu", k=random.randint(1, 9))) for _ in range(2000)).encode()
    assert not judge(("the same line again and again\n" * 200).encode())[0]
    assert not judge(noise)[0]
    assert judge(prose)[0]
    half = prose[:6000] + b"ab " * 3000
    assert not judge(half)[0] and judge(half)[2] > 0
    assert judge(b"short")[0] and judge(b"")[0]


def some_prose(n):
    random.seed(n)
    return " ".join("".join(random.choices("etaoinshrdlu", k=random.randint(1, 9))) for _ in range(n))[:n].encode()


def test_bands_judge_the_end_of_a_text():
    """Noise after the last whole chunk is judged, and a text shorter than a chunk is one chunk."""
    judge = compression_bands.Bands()
    random.seed(2)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    for size in (2080, 2500, 3000):
        prose, noise = some_prose(size), "".join(random.choices(letters, k=1973)).encode()
        good, _, outside, n_chunks = judge(prose + noise)
        assert not good and outside >= 1 and n_chunks == len(prose + noise) // 2048 + 1
        assert judge(prose)[0] and judge(prose)[2:] == (0, 2)
    assert judge(some_prose(4096))[2:] == (0, 2) and judge(some_prose(1000))[2:] == (0, 1) and judge(b"")[2:] == (0, 0)


@pytest.mark.parametrize("size", [48, 64, 100, 127, 128, 200, 300, 400, 511, 512, 700, 767, 1000, 1500, 2000, 2047])
def test_bands_reject_short_noise(size):
    judge = compression_bands.Bands()
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for seed in range(20):
        random.seed(seed)
        noise = " ".join("".join(random.choices(letters, k=random.randint(4, 10))) for _ in range(size))[:size].encode()
        assert not judge(noise)[0]
    assert judge(some_prose(size))[0]
    russian = "Он шёл по дороге и думал о том, что завтра будет новый день, и всё станет иначе, чем было раньше в этом городе. "
    assert judge(russian.encode())[0]


@pytest.mark.parametrize("width", [35, 50])
def test_repeated_passages(docs, rows, empty, width):
    got = {r["doc_id"]: r for r in repeats.repeated_passages(docs, width).collect()}
    expected = brute.repeats(rows, width)
    assert {k: (r["n_words"], r["n_removed"], r["kept_sha256"]) for k, r in got.items()} == expected
    assert sum(n > 0 for _, n, _ in expected.values()) > 8
    for r in got.values():
        assert sum(s["last"] - s["first"] + 1 for s in r["spans"]) == r["n_removed"]
        assert all(a["last"] + 1 < b["first"] for a, b in zip(r["spans"], r["spans"][1:]))
    assert repeats.repeated_passages(empty, width).count() == 0


def test_repeated_passages_odd_rows(odd):
    rows = [(r["doc_id"], r["n_removed"]) for r in repeats.repeated_passages(odd, 35).collect()]
    assert sorted(rows, key=str) == sorted([(7, 60), (7, 60), (8, 0), (None, 60), (None, 0)], key=str)


def test_passages_of_rows_without_an_id(spark):
    """Such rows are documents like any other: their windows count, and their own passages go."""
    part = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    one, two = part("p", 40), part("q", 45)
    texts = [
        (None, f"{part('a', 9)} {one}"), (1, f"{one} {part('b', 30)}"), (None, f"{part('c', 50)} {two}"), (None, f"{two} {part('d', 8)}"),
        (None, part("e", 60)), (None, part("f", 60)), (None, part("f", 60)), (None, f"{part('g', 5)} {part('f', 60)} {part('h', 5)}"),
        (2, part("k", 50)), (None, None), (None, ""),
    ]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    expected = brute.repeats(list(enumerate(t for _, t in texts)))
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeats.repeated_passages(docs).collect()), key=str)
    assert got == sorted(((texts[i][0], *row) for i, row in expected.items()), key=str)
    left = sorted(((r["doc_id"], len((r["text"] or "").split())) for r in repeats.cut_repeated_passages(docs).collect()), key=str)
    assert left == sorted([(texts[i][0], n - gone) for i, (n, gone, _) in expected.items() if not n or gone < n], key=str)


def test_rows_that_repeat_an_id(spark):
    """Unlike texts of one id have their own passages, and a row given twice comes out twice."""
    part = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    passage = part("p", 50)
    rows = [
        (7, f"{part('a', 20)} {passage}"), (7, f"{passage} {part('b', 90)}"), (7, part("c", 60)), (8, f"{part('d', 5)} {passage} {part('e', 9)}"),
        (9, f"{part('f', 40)} {passage}"), (9, f"{part('f', 40)} {passage}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in repeats.repeated_passages(docs).collect())
    assert got == [(7, 60, 0), (7, 70, 50), (7, 140, 50), (8, 64, 50), (9, 90, 90), (9, 90, 90)]
    left = sorted((r["doc_id"], len(r["text"].split())) for r in repeats.cut_repeated_passages(docs).collect())
    assert left == [(7, 20), (7, 60), (7, 90), (8, 14)]
    unlike = spark.createDataFrame([(1, part("g", 30)), (1, part("h", 30)), (1, part("h", 30)), (2, part("h", 30))], "doc_id bigint, text string")
    kept = sorted((r["doc_id"], r["text"]) for r in near_duplicates.drop_near_duplicates(unlike).collect())
    assert kept == [(1, part("g", 30)), (1, part("h", 30))]


def test_cut_passages(docs, rows):
    expected = brute.repeats(rows)
    cut = {r["doc_id"]: r for r in repeats.cut_repeated_passages(docs).collect()}
    texts = dict(rows)
    assert set(cut) == {k for k, (n, gone, _) in expected.items() if not n or gone < n}
    for one, r in cut.items():
        if not expected[one][1]:
            assert r["text"] == texts[one]
        else:
            assert hashlib.sha256(" ".join(brute.words(r["text"])).encode()).hexdigest() == expected[one][2]
            assert r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("k,percent", [(4, 80), (5, 80), (2, 90)])
def test_near_duplicates(docs, rows, empty, k, percent):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates.near_duplicates(docs, k, percent).collect()}
    assert got == brute.near(rows, k, percent)
    assert near_duplicates.near_duplicates(empty, k, percent).count() == 0


def test_near_duplicate_rows_without_id(odd):
    """A row without an id goes with its copies; wordless rows are linked with nothing."""
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates.near_duplicates(odd, 4).collect()), key=str)
    assert got == sorted([(7, 7, True), (7, 7, True), (8, 8, True), (None, 7, False), (None, None, True)], key=str)
    kept = near_duplicates.drop_near_duplicates(odd, 4).collect()
    assert sorted((r["doc_id"] for r in kept), key=str) == sorted([7, 8, None], key=str)


def crowd(size, changes, seed):
    """Texts that are one text with words changed here and there, and their likeness about the threshold."""
    random.seed(seed)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(size):
        own = list(base)
        for j in random.sample(range(120), 3 + i % changes):
            own[j] = f"c{random.randint(0, 9)}"
        texts.append(" ".join(own))
    return texts


def test_near_duplicates_over_rows_without_id(spark):
    """Components over rows without ids, over repeated ids and within both are those of brute force on row numbers."""
    texts = crowd(40, 7, 4) + ["q " * 3 + "r", "Q " * 3 + "R"] + crowd(4, 3, 8)[:1] * 2
    ids = [None if i % 3 else 100 - i for i in range(len(texts))]
    ids[0] = ids[3] = 55
    expected = brute.near(list(enumerate(texts)), 4, 80)
    group = {i: root for i, (_, root, _) in expected.items()}
    group = {i: group[0] if root == group[3] else root for i, root in group.items()}
    least = {root: min((ids[i] for i in group if group[i] == root and ids[i] is not None), default=None) for root in group.values()}
    docs = spark.createDataFrame([(ids[i], t, "n") for i, t in enumerate(texts)], "doc_id bigint, text string, row string")
    got = near_duplicates.near_duplicates(docs, 4, 80).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in got) == sorted((ids[i] or -1, least[group[i]] or -1) for i in group)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["component_id"])
    assert sum(r["kept"] for r in got if not r["component_id"]) == sum(v is None for v in least.values())
    kept = near_duplicates.drop_near_duplicates(docs, 4, 80)
    assert kept.columns == docs.columns
    assert sorted({r["doc_id"] or -1 for r in kept.collect()}) == sorted({v or -1 for v in least.values()})


@pytest.mark.parametrize("block", [1_200, 5_000, 400_000])
def test_crowd_links(spark, block):
    """One bucket of unlike members: its forest has the components of all pairs, whatever the size of the blocks."""
    rows = list(enumerate(crowd(90, 12, 3)))
    weight = sum(len(brute.shingles(t, 4)) + 250 for _, t in rows)
    members = spark.createDataFrame(
        [(1, i, len(brute.shingles(t, 4)), i, weight) for i, t in rows], "bucket bigint, rep bigint, n_shingles bigint, label bigint, weight bigint"
    )
    texts = spark.createDataFrame(rows, "rep bigint, text string")
    links = [(r["u"], r["v"]) for r in crowds.crowd_links(members, texts, 4, 80, block).collect()]
    sets = {i: brute.shingles(t, 4) for i, t in rows}
    assert all(len(sets[u] & sets[v]) * 100 >= 80 * len(sets[u] | sets[v]) for u, v in links)
    linked = lambda a, b: (a, b) in both
    both = {*links, *((v, u) for u, v in links)}
    assert brute.least_reachable([(i, i) for i in sets], linked) == {i: root for i, (_, root, _) in brute.near(rows, 4, 80).items()}
    if block == 400_000:
        assert len(links) < len(rows)
    assert crowds.crowd_links(members.limit(0), texts, 4, 80).count() == 0


def test_near_duplicates_of_unlike_neighbours(spark):
    """Texts that share a bucket with many others that they aren't linked to keep their links."""
    random.seed(9)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(60):
        own = list(base)
        for j in random.sample(range(120), 3 + i % 9):
            own[j] = f"c{random.randint(0, 9)}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates.near_duplicates(docs, 4, 80).collect()}
    assert got == brute.near(rows, 4, 80)


def bench_items():
    texts = dict(corpus())
    words = next(t for t in texts.values() if t and len(t.split()) == 300).split()
    return [
        ("a", " ".join(words[40:60])), ("b", " ".join(words[50:75]).upper()), ("c", "Zeta eta"), ("d", None), ("e", "..."),
        ("f", " ".join(words[100:107])), (None, " ".join(words[:30])), ("g", "spam"), ("a", " ".join(words[40:60])),
        ("h", " ".join(words[200:212])), ("i", " ".join(words[5:16])),
    ]


def test_benchmark_leaks(spark, docs, rows, empty):
    items = spark.createDataFrame(bench_items(), "item_id string, text string")
    given = [(i, t) for i, t in bench_items() if i is not None]
    found = leaks.benchmark_leaks(docs, items)
    digest = F.sha2(F.array_join("items", ","), 256).alias("digest")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["digest"], r["contaminated"]) for r in found.select("*", digest).collect()}
    expected = brute.leaks(rows, given)
    assert got == expected
    assert sum(e[4] for e in expected.values()) >= 2
    clean = {r["doc_id"] for r in leaks.drop_leaks(docs, items).collect()}
    assert clean == {one for one, e in expected.items() if not e[4]}
    assert leaks.benchmark_leaks(empty, items).count() == 0
    none = leaks.benchmark_leaks(docs, items.where("false")).collect()
    assert len(none) == len(rows) and not any(r["contaminated"] for r in none)


def test_leaks_without_python(spark, docs):
    items = spark.createDataFrame(bench_items(), "item_id string, text string")
    plan = leaks.benchmark_leaks(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_token_counts(docs, rows, empty):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for options in ({}, {"part_chars": 40, "batch_bytes": 100}):
        got = {r["doc_id"]: r for r in token_counts.count_tokens(docs, PIECES, **options).collect()}
        for one, text in rows:
            n = len(processor.encode(text or ""))
            assert (got[one]["n_bytes"], got[one]["n_tokens"], got[one]["over_limit"]) == (len((text or "").encode()), n, n > 4096)
    assert token_counts.count_tokens(empty, PIECES).count() == 0


def test_safe_parts():
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert token_counts.split_is_safe(processor)
    random.seed(3)
    letters = ["a", "be", " ", "  ", "\n", "\t", "▁", "é", ".", "漢", " x"]
    for _ in range(3000):
        text = "".join(random.choices(letters, k=random.randint(0, 30)))
        parts = token_counts.safe_parts(text, random.randint(1, 8))
        assert " ".join(parts) == text
        assert sum(len(processor.encode(p)) for p in parts) == len(processor.encode(text))


def test_word_ids_equal_the_library():
    words = WordIds(WORD_BPE, room=50)
    assert words.by_chunk
    random.seed(2)
    letters = list("abcXYZ '\t\n\r.,!?0123456789éÉßñüΣσςİıﬁ½²ª�🙂<|>") + [
        "<|endoftext|>", "<|startoftext|>", "'s", "'re", "'LL", "don't", "é", " ", " ", "\x85", "\x1c", "漢", "ǅ", "​",
    ]
    for _ in range(3000):
        text = "".join(random.choices(letters, k=random.randint(0, 14)))
        assert words(text) == words.whole(text)
    other = WordIds(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_chunk and other("a  b") == other.whole("a  b")


def test_packing(docs, rows, empty):
    pieces = [r.asDict() for r in packing.pack_documents(docs, WORD_BPE, 1).collect()]
    ids = dict(zip([i for i, _ in rows], brute.token_ids([t for _, t in rows], WORD_BPE), strict=True))
    brute.check_pieces(pieces, ids)
    order = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
    assert [(p["doc_id"], p["start"]) for p in order] == sorted((p["doc_id"], p["start"]) for p in order)
    assert packing.pack_documents(empty, WORD_BPE, 1).count() == 0


def test_cheapest_cuts():
    def slow(places, costs, width):
        best = [0] + [None] * (len(places) - 1)
        for j in range(1, len(places)):
            options = [best[i] + width - (places[j] - places[i]) for i in range(j) if places[j] - places[i] <= width]
            best[j] = min(options) + costs[j]
        return best[-1]

    random.seed(4)
    for _ in range(300):
        width = random.randint(5, 40)
        places = [0]
        for _ in range(random.randint(1, 60)):
            places.append(places[-1] + random.randint(1, width))
        costs = [0] + [random.choice([0, 3, 10]) for _ in places[1:]]
        cuts = packing.cheapest_cuts(places, costs, width)
        assert cuts[-1] == len(places) - 1
        steps = list(zip([0, *cuts], cuts))
        assert all(places[b] - places[a] <= width for a, b in steps)
        assert sum(width - places[b] + places[a] + costs[b] for a, b in steps) == slow(places, costs, width)


def test_packing_in_small_horizons():
    import numpy as np

    random.seed(6)
    ends = np.zeros(50, bool)
    ends[:3] = True
    packer = packing.Packer(32, ends, 0, horizon=200, tail=2)
    texts = {i: np.array([random.randint(0, 49) for _ in range(random.choice([1, 5, 30, 400]))], "<u4") for i in range(80)}
    pieces = [p for i, ids in texts.items() for p in packer.add(i, ids.tobytes())] + list(packer.finish())
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    brute.check_pieces([dict(zip(names, p, strict=True)) for p in pieces], texts, 32)


def test_token_files(spark, docs, rows, empty):
    path = scratch_path(spark, "ids")
    token_ids.write_token_ids(docs, path, WORD_BPE, 1, block_ids=500)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_ids.read_documents(spark, path).collect()}
    at, every = 0, []
    for (one, _), ids in zip(rows, brute.token_ids([t for _, t in rows], WORD_BPE), strict=True):
        assert got[one] == (at, len(ids), brute.crc(ids))
        at += len(ids)
        every += ids.tolist()
    asked = [0, 1, at // 2, at - 1, at, -1, 499, 500]
    positions = spark.createDataFrame([(p,) for p in asked], "position bigint")
    found = {r["position"]: r["token"] for r in token_ids.token_at(spark, path, positions, stride=700).collect()}
    assert found == {p: every[p] for p in asked if 0 <= p < at}
    nothing = scratch_path(spark, "ids")
    token_ids.write_token_ids(empty, nothing, WORD_BPE, 1)
    assert token_ids.read_documents(spark, nothing).count() == 0


@pytest.mark.parametrize("top", [1, 255, 256, 50_000, (1 << 32) - 1])
@pytest.mark.parametrize("n", [0, 1, 7, 512, 513, 3000])
def test_direct_codes(top, n):
    import numpy as np

    ids = np.random.default_rng(n).integers(0, top, n, endpoint=True).astype(np.uint32)
    levels = direct_codes.unpacked(direct_codes.packed(direct_codes.encode(ids)))
    assert (direct_codes.decode(levels) == ids).all()
    for i in range(0, n, 37):
        assert direct_codes.access(levels, i) == ids[i]
