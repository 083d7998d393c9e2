"""Phrases, alignment and SimHash against plain Python on small tables with nulls, ties, repeats and odd texts."""

import random
import types

import brute
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from folioframe.llm import alignment, phrases, simhash
from folioframe.llm.tries import Trie

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, lang string, code string, n bigint, w1 int, fp string, block string, rank int"


def table(spark, rows):
    """rows: (doc_id, text, lang); the other columns have names that the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, "x", 1, 2, "y", "z", 3) for i, t, lang in rows], SCHEMA).repartition(3)


def prose(words, n, seed):
    random.seed(seed)
    return " ".join(random.choices(words, k=n))


def phrase_rows():
    few = ["Der", "die", "das", "ß-x", "a.b", "über", "d'r", "\x85", "the", "of"]
    rows = [(i, prose(few, 60, i), random.choice(["de", "en", None])) for i in range(12)]
    rows += [(20, None, "de"), (21, "", "en"), (22, " \t\n", None), (23, "a a a a a. A a a!a a", "fr"), (24, "a a\ta a\x0ba a", "fr")]
    rows += [(None, "new york city new york city, new york", "en")] * 3 + [(30, "x " * 5000, "long"), (31, "und so", "und")]
    return rows


def test_trie_finds_its_paths_only():
    random_numbers = np.random.default_rng(3)
    labels = random_numbers.integers(1, 1 << 63, 400, dtype=np.uint64)
    labels[:50] = (labels[:50] >> np.uint64(32) << np.uint64(32)) | np.uint64(5)  # alike in the low half
    labels[50:90] = labels[50:90] & np.uint64((1 << 32) - 1)  # alike in the high half
    two = np.unique(random_numbers.choice(labels, (3000, 2)), axis=0)
    three = np.unique(np.concatenate([np.tile(labels[:3], (1, 1)), random_numbers.choice(labels, (3000, 3))]), axis=0)
    trie = Trie([np.empty((0, 1), np.uint64), two, three])
    text = random_numbers.choice(np.append(labels, np.uint64(0)), 200_000)
    counts = trie.count(text, 3)
    expected = {}
    known = set(map(tuple, two.tolist())) | set(map(tuple, three.tolist())) | {tuple(p[:2]) for p in three.tolist()}
    plain = text.tolist()
    for n in (2, 3):
        for i in range(len(plain) - n + 1):
            if (path := tuple(plain[i : i + n])) in known:
                expected[path] = expected.get(path, 0) + 1
    reached = np.flatnonzero(counts)
    paths, steps = trie.paths(reached, 3)
    assert {tuple(p[:n]): c for p, n, c in zip(paths.tolist(), steps.tolist(), counts[reached].tolist(), strict=True)} == expected
    none = Trie([np.empty((0, n), np.uint64) for n in (1, 2, 3)])
    assert none.count(text, 3).sum() == 0


@pytest.mark.parametrize("options", [{}, {"max_states": 20}, {"sieve_bits": 8}, {"longest": 2}, {"longest": 4}])
def test_phrases(spark, options):
    rows = phrase_rows()
    docs = table(spark, rows)
    top = None if options else 3
    got = sorted(tuple(r) for r in phrases.mine_phrases(docs, 2, top=top, **options).collect())
    assert got == brute.phrases([(lang, t) for _, t, lang in rows], 2, options.get("longest", 3), top=top) and got


def test_phrases_of_words_that_share_a_code(spark, monkeypatch):
    """Sixteen bits for a word's code: words that would share one get their own."""
    real = xxhash.xxh3_64_intdigest
    weak = types.SimpleNamespace(xxh3_64_intdigest=lambda data, seed=0: (real(data, seed) % 7 + 1) << 33 if seed < 1 << 63 else real(data, seed))
    monkeypatch.setattr(phrases, "xxhash", weak)
    monkeypatch.setattr(phrases, "word_code", lambda lang, word, more=0: weak.xxh3_64_intdigest(word, more) if not more else real(word, more))
    monkeypatch.setattr(phrases.Codes, "__call__", lambda self, lang, words: np.array(
        [0 if w == b"\xff" else self.apart.get((lang, w), phrases.word_code(lang, w)) for w in words], np.uint64))
    rows = phrase_rows()
    got = sorted(tuple(r) for r in phrases.mine_phrases(table(spark, rows), 2).collect())
    assert got == brute.phrases([(lang, t) for _, t, lang in rows], 2)


def test_codes_of_words_that_share_one():
    code = phrases.word_code("en", b"two")
    codes = phrases.Codes({("en", b"two"): 77, ("en", b"one"): 78})
    assert codes("en", [b"one", b"two", b"\xff", b"three"]).tolist() == [78, 77, 0, phrases.word_code("en", b"three")]
    assert codes("de", [b"two"])[0] != 77 and phrases.Codes({})("en", [b"two"])[0] == code


def test_phrases_of_nothing(spark):
    assert phrases.mine_phrases(table(spark, []), 1).count() == 0
    assert phrases.mine_phrases(table(spark, [(1, None, None), (2, "alone", "en")]), 1).count() == 0


def odd_texts():
    return [
        None, "", " ", "  ", "a", "Hello  world", " lead and trail ", "tab\tand\nline\r\n", "a<|endoftext|>b <s> </s> x", "▁x y",
        "x ▁ y", "\x00\x01 \x7f", "é ü ﬁ ½ 漢字 🙂 한국어", "don't we'll I'M 12345 3.14", "a" * 3000, "nb\xa0sp\x85x　wide", "z " * 4000,
        "Ünïcödé wörds mixed with plain ones", "1 2 3 4 5 6 7 8 9 10", "    indented\n\n\n  code();", "​zero​ width", "é combining",
    ]


@pytest.mark.parametrize("block", [1, 1 << 21])
def test_alignment(spark, block):
    words = ["the", "Straße", "naïve", "co-op", "x1", "don't", "…", "ab\ncd", "über.", "🙂🙂"]
    texts = odd_texts() + [prose(words, n, n) for n in (3, 30, 300, 2000)] + ["same text here"] * 3
    rows = [*enumerate(texts), (None, "no id but words"), (3, "again an id")]
    docs = table(spark, [(i, t, "en") for i, t in rows])
    got = sorted((tuple(r) for r in alignment.align_tokenizers(docs, A, B, block).collect()), key=str)
    assert got == sorted(brute.alignment(rows, A, B), key=str)
    assert alignment.align_tokenizers(docs.limit(0), A, B).count() == 0


def test_pointer_jumping():
    # A: ab|cd|ef|g|hi   B: a|bcde|fg|h|i
    ends = alignment.terminals(np.array([2, 4, 6, 7, 9]), np.array([1, 5, 7, 8, 9]))
    assert ends.tolist() == [7, 7, 7, 7, 9, 7, 7, 7, 9, 9]
    long = np.arange(2, 20_001, 2), np.append(np.arange(1, 20_000, 2), 20_000)
    assert set(alignment.terminals(*long).tolist()) == {20_000}
    assert len(alignment.terminals(np.empty(0, np.int64), np.empty(0, np.int64))) == 0


def test_fingerprint():
    for text in [*odd_texts(), "A b", "a B c", prose(["x", "y", "z"], 70_000, 1)]:
        assert simhash.fingerprint(brute.lower_ascii(text or "").encode().split()) == brute.simhash(text)


def near(differing):
    return lambda u, v: (u ^ v).bit_count() <= differing


@pytest.mark.parametrize("crowd", [0, 1, 64])
def test_simhash_groups(spark, crowd):
    base = prose([f"w{i}" for i in range(400)], 300, 9).split()
    rows = list(enumerate([None, "", "one", "One", "one two", *odd_texts()]))
    for i in range(40):
        random.seed(i)
        edited = list(base)
        for at in random.sample(range(300), i % 7):
            edited[at] = f"new{i}"
        rows.append((100 - i, " ".join(edited)))
    rows += [(None, " ".join(base)), (None, "only here without id"), (7, "twice"), (7, "another text")]
    got = simhash.simhash_groups(table(spark, [(i, t, "en") for i, t in rows]), crowd=crowd).collect()
    prints = [(i, brute.simhash(t)) for i, t in rows]
    least = brute.least_reachable(prints, near(3))
    expected = sorted([(i, f"{fp:016x}", least[at]) for at, (i, fp) in enumerate(prints)], key=str)
    assert sorted((tuple(r) for r in got), key=str) == expected
    assert simhash.simhash_groups(table(spark, [])).count() == 0


@pytest.mark.parametrize("differing", [0, 1, 2, 3])
@pytest.mark.parametrize("crowd", [0, 2, 1000])
def test_links_of_fingerprints(spark, differing, crowd):
    """Every pair within the budget once, whatever the crowd."""
    random.seed(differing)
    centres = [0, (1 << 64) - 1, random.getrandbits(64)]
    values = {c ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 4))) for c in centres for _ in range(60)}
    values |= {centres[2] ^ (1 << 63) ^ sum(1 << b for b in random.sample(range(48, 64), 2)) for _ in range(30)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links, _ = simhash.similar_fingerprints(spark.createDataFrame(signed, "fp bigint"), differing, crowd)
    got = [tuple(sorted((r["u"] % (1 << 64), r["v"] % (1 << 64)))) for r in links.collect()]
    expected = sorted((u, v) for u in values for v in values if u < v and near(differing)(u, v))
    assert sorted(got) == expected


def test_a_crowd_of_fingerprints_is_not_paired(spark):
    """Thousands that share three segments: chains grow with the members, not with their pairs."""
    crowd = spark.range(4096).select((F.col("id") * 16).alias("fp"))
    links, _ = simhash.similar_fingerprints(crowd, 1, 16)
    assert links.count() == 4096 * 12 // 2
