"""Benchmark decontamination by winnowing, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.session import cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CANDIDATES = "array<struct<fingerprint: bigint, first: int, last: int, window: string>>"
#: Bits of the sieve for each fingerprint of the benchmark, and the most and fewest bits.
SIEVE_BITS, SIEVE_MOST, SIEVE_LEAST = 128, 1 << 20, 1 << 16


def benchmark_leaks(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, gram: int = 5,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(doc_id, text_key, n_words, n_hit, n_items, items, contaminated)`` for every row of ``docs``.

    A document word is hit when it lies in a run of words equal to a window of an item: ``width``
    consecutive item words, or the whole item if it has fewer. ``items`` are the distinct ids, as
    strings in ascending order, of items with a window in the document.

    1. Words are hashed, and every ``gram`` consecutive words once more. The fingerprint of a
       window is the least of its gram hashes, so equal windows have equal fingerprints.
    2. A sieve of bits, made from the benchmark's fingerprints and of bounded size, tells which
       grams of a document may be a fingerprint of the benchmark. Only windows around such a
       gram whose least gram it is are candidates.
    3. Candidate windows are joined to the benchmark's on fingerprint and words. Neighbouring and
       overlapping hits extend each other to the whole shared span.

    The sieve lets some windows through needlessly and holds none back; past its largest size it
    lets more through. Items shorter than ``width`` are fingerprinted whole, one pass for each
    of their lengths.

    Null texts have no words. Items without words or id are left out, and repeated items count
    once. Rows that repeat an id are judged each. Other columns are ignored.
    """
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"), _words(F.col(item_text)).alias("words")
    ).where("item IS NOT NULL AND size(words) > 0")
    lengths = sorted(
        r["n"] for r in items.select(F.least(F.size("words"), F.lit(width)).alias("n")).distinct().collect()
    )
    windows = _all_windows(items, lengths, width, gram)
    known, _ = cut(
        windows.groupBy("fingerprint", "window").agg(F.array_sort(F.collect_set("item")).alias("found")), "windows"
    )
    sieve, bits = _sieve(known.select("fingerprint").distinct())

    parsed = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("text_key"), _words(F.col(text)).alias("words")
    )
    scanned, _ = cut(
        _hashed(parsed, gram).select(
            "doc_id", "text_key", F.size("words").cast("bigint").alias("n_words"),
            _candidates(lengths, width, gram, sieve, bits).alias("candidates"),
        ),
        "scanned",
    )
    hits = (
        scanned.select("doc_id", "text_key", F.explode("candidates").alias("c"))
        .select("doc_id", "text_key", "c.fingerprint", "c.first", "c.last", "c.window")
        .join(known, ["fingerprint", "window"])
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("runs"), F.collect_set("found").alias("found"))
        .select(
            F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), _covered("runs").alias("hit"),
            F.array_sort(F.array_distinct(F.flatten("found"))).alias("found"),
        )
    )
    joined = scanned.select("doc_id", "text_key", "n_words").join(
        hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left"
    )
    found = F.coalesce("found", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "text_key", "n_words", F.coalesce("hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(found).cast("bigint").alias("n_items"), found.alias("items"),
        (F.coalesce("hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without a window of the benchmark."""
    found = benchmark_leaks(docs, benchmark, width, doc_id=doc_id, text=text).where("contaminated")
    leaks = found.select(F.col("doc_id").alias("leak_id"), F.col("text_key").alias("leak_key")).distinct()
    same = docs[doc_id].eqNullSafe(leaks["leak_id"]) & (F.xxhash64(docs[text]) == leaks["leak_key"])
    return docs.join(leaks, same, "left_anti")


def _words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))


def _hashed(rows: DataFrame, gram: int) -> DataFrame:
    """The rows with ``hashes``, one a word, and ``grams``, one a run of ``gram`` words."""
    hashed = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    return hashed.withColumn("grams", _runs(gram))


def _runs(length: int) -> Column:
    """Hash of every run of ``length`` words, by its place; empty for fewer words."""
    if length == 1:
        return F.col("hashes")
    starts = F.sequence(F.lit(1), F.size("hashes") - (length - 1))
    runs = F.transform(starts, lambda i: F.xxhash64(*[F.element_at("hashes", i + j) for j in range(length)]))
    return F.when(F.size("hashes") >= length, runs).otherwise(F.array().cast("array<bigint>"))


def _window(first: Column, length: int, fingerprint: Column) -> Column:
    """A candidate: its words are numbered from 1."""
    return F.struct(
        fingerprint.alias("fingerprint"), first.cast("int").alias("first"), (first + (length - 1)).cast("int").alias("last"),
        F.array_join(F.slice("words", first, length), " ").alias("window"),
    )


def _seeded(length: int, width: int, gram: int) -> bool:
    """Whether windows of the length have a least gram; others are fingerprinted whole."""
    return length == width and length >= gram


def _all_windows(items: DataFrame, lengths: list[int], width: int, gram: int) -> DataFrame:
    """``(item, fingerprint, window)`` for every window of every item."""
    rows = _hashed(items, gram)
    parts = []
    for length in lengths:
        own = rows.where((F.size("words") >= width) if length == width else (F.size("words") == length))
        starts = F.sequence(F.lit(1), F.size("words") - (length - 1))
        if _seeded(length, width, gram):
            made = F.transform(
                starts, lambda s: _window(s, length, F.array_min(F.slice("grams", s, length - gram + 1)))  # noqa: B023
            )
        else:
            made = F.transform(_runs(length), lambda x, i: _window(i + 1, length, x))  # noqa: B023
        parts.append(own.select("item", F.explode(made).alias("w")).select("item", "w.fingerprint", "w.window"))
    if not parts:
        return items.sparkSession.createDataFrame([], "item string, fingerprint bigint, window string")
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    return every


def _sieve(fingerprints: DataFrame) -> tuple[Column, int]:
    """A constant array of 64-bit words with the bits of the fingerprints set, and its bits.

    It has about ``SIEVE_BITS`` bits a fingerprint and never more than ``SIEVE_MOST``, so at most
    16,384 words come to the driver and go out with the plan.
    """
    bits, wanted = SIEVE_LEAST, min(SIEVE_MOST, SIEVE_BITS * fingerprints.count())
    while bits < wanted:
        bits *= 2
    place = F.pmod("fingerprint", F.lit(bits))
    words = fingerprints.select(F.floor(place / 64).alias("word"), (place % 64).cast("int").alias("bit"))
    held = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect()
    filled = [0] * (bits // 64)
    for row in held:
        filled[row["word"]] = row["bits"]
    return F.split(F.lit(",".join(map(str, filled))), ",").cast("array<bigint>"), bits


def _passes(sieve: Column, bits: int, fingerprint: Column) -> Column:
    bit = F.pmod(fingerprint, F.lit(bits))
    word = F.get(sieve, F.floor(bit / 64).cast("int"))
    return F.getbit(word, (bit % 64).cast("int")) == 1


def _candidates(lengths: list[int], width: int, gram: int, sieve: Column, bits: int) -> Column:
    parts = []
    for length in lengths:
        if _seeded(length, width, gram):
            span = length - gram + 1
            marked = F.array_compact(F.transform("grams", lambda x, i: F.when(_passes(sieve, bits, x), i + 1)))
            last = F.size("words") - (length - 1)

            def around(i: Column) -> Column:
                low, high = F.greatest(i - (span - 1), F.lit(1)), F.least(i, last)  # noqa: B023
                starts = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
                own = F.element_at("grams", i)
                chosen = F.filter(starts, lambda s: F.array_min(F.slice("grams", s, span)) == own)  # noqa: B023
                return F.transform(chosen, lambda s: _window(s, length, own))  # noqa: B023

            parts.append(F.flatten(F.transform(marked, around)))
        else:
            parts.append(F.array_compact(F.transform(
                _runs(length), lambda x, i: F.when(_passes(sieve, bits, x), _window(i + 1, length, x))  # noqa: B023
            )))
    return F.concat(*parts) if parts else F.array().cast(_CANDIDATES)


def _covered(runs: str) -> Column:
    """How many words the sorted runs cover together."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))

    def add(held: Column, run: Column) -> Column:
        fresh = run["last"] - F.greatest(run["first"] - 1, held["reach"])
        return F.struct(
            (held["n"] + F.greatest(fresh, F.lit(0))).alias("n"), F.greatest(held["reach"], run["last"]).alias("reach")
        )

    return F.aggregate(runs, start, add, lambda held: held["n"])
