"""Phrase collocations: Apriori-safe candidates in double-array tries, counted at all text positions at once."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioframe.llm.tries import Trie
from folioframe.llm.words import byte_column, mixed
from folioframe.session import cut, discard

#: Stands between pieces and between texts; no UTF-8 text has this byte.
_BREAK = b"\xff"
# The characters that end a piece.
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _PIECE_ENDS, b"abcdefghijklmnopqrstuvwxyz " + _BREAK * len(_PIECE_ENDS)
)
_NEXT = np.uint64(0x9E3779B97F4A7C15)
_BUFFER_BYTES, _BUFFER_CODES, _BUFFER_WORDS = 2 << 20, 3 << 19, 1 << 19
#: States in a row of partial counts.
_SLICE = 1 << 13


class Codes:
    """64-bit codes of the words of a language; ``apart`` has codes of their own for words that would share one."""

    def __init__(self, apart: dict[tuple[str, bytes], int]):
        self.apart = apart
        self.shared = np.array(sorted({word_code(*one) for one in apart}), np.uint64)

    def __call__(self, lang: str, words: list[bytes]) -> np.ndarray:
        """Codes of words in order; a break is 0."""
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words, repeat(seed)), np.uint64, len(words))
        codes[codes == np.uint64(xxhash.xxh3_64_intdigest(_BREAK, seed))] = 0
        if len(self.shared):
            for i in np.flatnonzero(np.isin(codes, self.shared)).tolist():
                codes[i] = self.apart.get((lang, words[i]), codes[i])
        return codes


def word_code(lang: str, word: bytes, more: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(word, xxhash.xxh3_64_intdigest(lang.encode()) + more)


def mine_phrases(
    docs: DataFrame, min_count: int = 10, longest: int = 3, top: int | None = None, drop_percent: int = 50,
    max_states: int = 1 << 20, sieve_bits: int = 26, lang: str = "lang", text: str = "text",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: phrases of 2 to ``longest`` words by how their parts belong together.

    Per language (null: ``und``). Texts are ASCII-lowercased, cut into pieces at ``.,;:!?`` and line
    ends, pieces into words at blanks and tabs. A phrase with ``a >= min_count`` occurrences, overlaps
    included, is a candidate. A cut into a first part of ``l`` and a rest of ``r`` occurrences
    scores ``floor(1000000 * a * a / (l * r))``; the lowest-scoring cut counts, the shortest first part
    of equals. A candidate whose words lie inside a longer one with at least ``drop_percent``
    hundredths of its occurrences goes. ``n`` are all word occurrences of the language; ``top`` keeps
    the first so many ranks of each language (by score, ``a``, then phrase in byte order).

    1. Words are counted, in the tasks first.
    2. Candidates, level by level: only positions whose phrases one word shorter may be frequent
       (Apriori) give a phrase. Tasks test this against a bit sieve of fixed size, which lets
       others through but drops none, and send each distinct code with its uses, up to
       ``min_count``; codes that don't reach it in sum are out.
    3. Candidates become double-array tries of at most about ``max_states`` states, one a
       shard of first words, broadcast one after the other. A task advances the states of all positions of its
       texts level by level and counts the accepting ones; the tasks send slices of counts, which are summed.
    4. Counts meet those of their parts by joins, in exact arithmetic (38 digits).

    More shards mean more passes over the texts; nothing else grows with one task's memory.
    Null or empty texts have no words; repeated rows count each. Other columns are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    words, word_path, codes = _words(source)
    frequent = words.where(F.col("n") >= min_count)

    sieves = [_sieve(frequent.select("code"), sieve_bits)]
    for level in range(2, longest):
        found, path = cut(_frequent(_code_uses(source, codes, sieves, level, min_count), ["code"], min_count), "codes")
        sieves.append(_sieve(found, sieve_bits))
        discard(spark, path)
    labels = [f"w{i}" for i in range(1, longest + 1)]
    candidates, candidate_path = cut(
        _frequent(_label_uses(source, codes, sieves, longest, min_count), labels, min_count), "candidates"
    )
    counted, count_path = _trie_counts(source, codes, candidates, longest, max_states)
    phrases, phrase_path = cut(_scored(counted, frequent, longest, drop_percent), "phrases")
    for sieve in sieves:
        sieve.destroy()
    discard(spark, candidate_path, count_path)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(order).cast("bigint"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    out, _ = cut(ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "ranked")
    discard(spark, phrase_path, word_path)
    return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Words and breaks of some texts of one language, again and again."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()

    def out(lang: str) -> tuple[str, list[bytes]]:
        data = _BREAK.join(held.pop(lang)).translate(_PLAIN)
        del sizes[lang]
        return lang, data.replace(_BREAK, b" " + _BREAK + b" ").split()

    for batch in batches:
        for lang, data in zip(batch.column("lang").to_pylist(), byte_column(batch, "text"), strict=True):
            held.setdefault(lang, []).append(data)
            sizes[lang] += len(data) + 1
            if sizes[lang] >= _BUFFER_BYTES:
                yield out(lang)
    for lang in list(held):
        yield out(lang)


def _sliced(batch: pa.RecordBatch, size: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """Small batches, as the other side holds one as a whole."""
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def _coded(batches: Iterator[pa.RecordBatch], codes: Codes) -> Iterator[np.ndarray]:
    for lang, words in _texts(batches):
        yield codes(lang, words)


def _words(source: DataFrame) -> tuple[DataFrame, str, Codes]:
    """``(lang, word, n, code)`` of every word, and the codes, which tell all words of the corpus apart."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                counts.pop(_BREAK, None)
                yield from _sliced(pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()).cast(pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                ], names=["lang", "word", "n"]))
            held.clear()

        for lang, words in _texts(batches):
            held.setdefault(lang, Counter()).update(words)
            if sum(map(len, held.values())) > _BUFFER_WORDS:
                yield from out()
        yield from out()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("lang").to_pylist(), byte_column(batch, "word"), strict=True)
            code = np.fromiter((word_code(*one) for one in pairs), np.uint64, batch.num_rows)
            yield batch.append_column("code", pa.array(code.view(np.int64)))

    counted = source.mapInArrow(count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words, path = cut(counted.mapInArrow(coded, "lang string, word string, n bigint, code bigint"), "words")
    again = words.groupBy("code").agg(F.count("*").alias("held")).where("held > 1 OR code = 0").select("code")
    # a few in 10 billion words share a code by chance
    shared = [(r["lang"], r["word"].encode()) for r in words.join(again, "code", "left_semi").select("lang", "word").collect()]
    apart = {one: word_code(*one, more=i + 1) for i, one in enumerate(sorted(shared))}
    if apart:
        own = [(lang, word.decode(), code - (1 << 64) if code >> 63 else code) for (lang, word), code in apart.items()]
        own = words.sparkSession.createDataFrame(own, "lang string, word string, own bigint")
        words = words.join(F.broadcast(own), ["lang", "word"], "left").select(
            "lang", "word", "n", F.coalesce("own", "code").alias("code")
        )
    return words, path, Codes(apart)


def _sieve(codes: DataFrame, bits: int):
    """A broadcast bit table of ``2 ** bits`` bits with those of the codes' leading bits set."""
    spark = codes.sparkSession
    place = F.shiftrightunsigned("code", 64 - bits)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(63).cast("int"))
    rows = codes.groupBy(F.shiftright(place, 6).alias("cell")).agg(F.bit_or(one).alias("marks")).toArrow()
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[rows.column("cell").to_numpy()] = rows.column("marks").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(table)


def _may_hold(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    place = codes >> np.uint64(64 - (int(len(table)) * 64 - 1).bit_length())
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _levels(words: np.ndarray, sieves: list[np.ndarray], upto: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 2, 3, ... ``upto`` words the first positions of phrases that may be frequent by their parts, and their codes."""
    places = np.flatnonzero(words)
    places = places[_may_hold(sieves[0], words[places])]
    codes = words[places]
    for level in range(2, upto + 1):
        follows = np.flatnonzero(np.diff(places) == 1)
        last = words[places[follows] + level - 1]
        places, codes = places[follows], mixed(codes[follows] * _NEXT + last)
        yield places, codes
        if level < upto:
            passed = _may_hold(sieves[level - 1], codes)
            places, codes = places[passed], codes[passed]


def _code_uses(source: DataFrame, codes: Codes, sieves: list, level: int, most: int) -> DataFrame:
    """Distinct codes of phrases of ``level`` words in parts of the corpus, with their uses there, up to ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            found, uses = np.unique(np.concatenate([*held, np.empty(0, np.uint64)]), return_counts=True)
            yield from _sliced(pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(np.minimum(uses, most).astype(np.int32))], names=["code", "uses"]
            ))

        tables, held = [s.value for s in sieves], []
        for words in _coded(batches, codes):
            for _, found in _levels(words, tables, level):
                pass
            held.append(found)
            if sum(map(len, held)) >= _BUFFER_CODES:
                yield from out(held)
                held = []
        yield from out(held)

    return source.mapInArrow(run, "code bigint, uses int")


def _label_uses(source: DataFrame, codes: Codes, sieves: list, longest: int, most: int) -> DataFrame:
    """The words of phrases that may be frequent by their parts, in parts of the corpus, with their uses there."""
    names = [f"w{i}" for i in range(1, longest + 1)]

    def out(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        found = np.concatenate([h[0] for h in held] or [np.empty(0, np.uint64)])
        order = np.argsort(found, kind="stable")
        found = found[order]
        labels = [np.concatenate([h[1][:, i] for h in held] or [found])[order] for i in range(longest)]
        # unlike phrases of one code stay apart, if need be as several rows
        starts = np.append(True, found[1:] != found[:-1])[: len(found)]
        for column in labels:
            starts[1:] |= column[1:] != column[:-1]
        first = np.flatnonzero(starts)
        uses = np.minimum(np.diff(np.append(first, len(found))), most).astype(np.int32)
        columns = [pa.array(c[first].view(np.int64), mask=c[first] == 0) for c in labels]
        yield from _sliced(pa.RecordBatch.from_arrays([*columns, pa.array(uses)], names=[*names, "uses"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, held = [s.value for s in sieves], []
        for words in _coded(batches, codes):
            for level, (places, found) in enumerate(_levels(words, tables, longest), 2):
                if level <= len(tables):
                    passed = _may_hold(tables[level - 1], found)
                    places, found = places[passed], found[passed]
                labels = np.zeros((len(places), longest), np.uint64)
                for i in range(level):
                    labels[:, i] = words[places + i]
                held.append((found, labels))
            if sum(len(h[0]) for h in held) >= _BUFFER_CODES // 2:
                yield from out(held)
                held = []
        yield from out(held)

    return source.mapInArrow(run, ", ".join([*(f"{name} bigint" for name in names), "uses int"]))


def _frequent(uses: DataFrame, keys: list[str], min_count: int) -> DataFrame:
    return uses.groupBy(*keys).agg(F.sum("uses").alias("uses")).where(F.col("uses") >= min_count).select(*keys)


def _trie_counts(
    source: DataFrame, codes: Codes, candidates: DataFrame, longest: int, max_states: int,
) -> tuple[DataFrame, str]:
    """``(w1, ..., a)`` of the candidates: a broadcast trie a shard of first words, counts summed over the tasks."""
    spark: SparkSession = source.sparkSession
    names = [f"w{i}" for i in range(1, longest + 1)]
    shards = max(1, -(-candidates.count() // max_states))
    parts, paths = [], []
    for shard in range(shards):
        trie = _trie(candidates.where(F.pmod("w1", F.lit(shards)) == shard), names)
        held = spark.sparkContext.broadcast(vars(trie))
        count, add = _counters(held, codes, longest, names)
        summed = source.mapInArrow(count, "slice int, counts binary").repartition("slice")
        part, path = cut(summed.mapInArrow(add, ", ".join(f"{name} bigint" for name in [*names, "a"])), "counts")
        held.destroy()
        parts.append(part)
        paths.append(path)
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.union(part)
    both, path = cut(counted, "counts")
    discard(spark, *paths)
    return both, path


def _trie(candidates: DataFrame, names: list[str]) -> Trie:
    """The trie of one shard, whose size the caller has bounded."""
    rows = candidates.toArrow()
    columns = [rows.column(name).combine_chunks() for name in names]
    lengths = sum(np.asarray(c.is_valid()).astype(np.int64) for c in columns) if rows.num_rows else np.zeros(0, np.int64)
    labels = np.stack([c.fill_null(0).to_numpy().view(np.uint64) for c in columns], axis=1)
    return Trie([labels[lengths == n, :n] for n in range(1, len(names) + 1)])


def _counters(held, codes: Codes, longest: int, names: list[str]) -> tuple[Callable, Callable]:
    """What counts the accepting states of texts, a row for each slice of states, and what adds up slices."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie.of(held.value)
        counts = np.zeros(trie.size, np.int64)
        for words in _coded(batches, codes):
            counts += trie.count(words, longest)
        for i, at in enumerate(range(0, trie.size, _SLICE)):
            part = counts[at : at + _SLICE]
            if part.any():
                small = part.astype(np.min_scalar_type(part.max()))
                packed = bytes([small.itemsize]) + zlib.compress(small.tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed])], names=["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, sums = Trie.of(held.value), {}
        for batch in batches:
            for i, packed in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(packed[1:]), f"<u{packed[0]}")
                sums[i] = sums[i] + part if i in sums else part.astype(np.int64)
        for i, part in sums.items():
            reached = np.flatnonzero(part)
            labels, steps = trie.paths(reached + i * _SLICE, longest)
            columns = [pa.array(labels[:, n].view(np.int64), mask=steps <= n) for n in range(longest)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(part[reached])], names=[*names, "a"])

    return count, add


def _scored(counted: DataFrame, words: DataFrame, longest: int, drop_percent: int) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` of the candidates that stay."""
    names = [f"w{i}" for i in range(1, longest + 1)]
    length = sum((F.when(F.col(n).isNotNull(), 1).otherwise(0) for n in names[1:]), F.lit(1))
    sized = counted.withColumn("size", length)
    # every phrase, words too, by its code array
    coded = F.array_compact(F.array(*names))
    known = sized.select(coded.alias("part"), F.col("a").alias("uses")).union(
        words.select(F.array("code").alias("part"), F.col("n").alias("uses"))
    )
    cuts = sized.withColumn("codes", coded).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    ends = cuts.select(
        "codes", "a", "k", F.slice("codes", 1, F.col("k")).alias("head"),
        F.slice("codes", F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"),
    )
    left = known.select(F.col("part").alias("head"), F.col("uses").alias("l"))
    right = known.select(F.col("part").alias("tail"), F.col("uses").alias("r"))
    scored = ends.join(left, "head").join(right, "tail").withColumn("score", _score("a", "l", "r"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = scored.groupBy("codes").agg(F.first("a").alias("a"), lowest).select("codes", "a", "cut.*")

    inside = [
        sized.where(F.col("size") >= long).select(
            F.explode(F.array_distinct(F.array(*[
                F.when(F.col("size") >= start + short, F.array(*names[start : start + short]))
                for start in range(longest - short + 1)
            ]))).alias("codes"), F.col("a").alias("outer"),
        ).where("codes IS NOT NULL")
        for short, long in ((s, s + 1) for s in range(2, longest))
    ]
    if inside:
        around = inside[0]
        for more in inside[1:]:
            around = around.union(more)
        around = around.groupBy("codes").agg(F.max("outer").alias("outer"))
        kept = best.join(around, "codes", "left").where(
            F.col("outer").isNull() | (F.col("outer").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * drop_percent)
        )
    else:
        kept = best
    named = kept.select("a", "l", "r", "score", "codes", F.posexplode("codes").alias("at", "code")).join(
        words.select("code", "lang", "word"), "code"
    )
    spoken = named.groupBy("codes").agg(
        F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("said"),
        *[F.first(c).alias(c) for c in ("a", "l", "r", "score")],
    )
    return spoken.select("lang", F.array_join("said.word", " ").alias("phrase"), "a", "l", "r", "score")


def _score(a: str, left: str, right: str) -> Column:
    """Exact up to 38 digits; a phrase has no more occurrences than its parts, so it is 1,000,000 at most."""
    wide = {c: f"CAST({c} AS DECIMAL(38,0))" for c in (a, left, right)}
    return F.expr(f"({wide[a]} * {wide[a]} * CAST(1000000 AS DECIMAL(38,0))) div ({wide[left]} * {wide[right]})")
