"""Manifest, dedup, progress and document-assembly operators."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioframe.functions.text import normalize_file_name, word_ngrams, words
from folioframe.functions.tokens import closed_text, gram_hashes, gram_places, gram_texts, parts, tokenize
from folioframe.operators.pairing import pending
from folioframe.session import cut

# Fixed value: what is written after each page's text.
PAGE_END = "\n\n"
#: Bits of the sieve of word sequences, as a power of two, and how many sequences it is made for.
SIEVE_BITS, SIEVE_GRAMS = 26, 1 << 25
#: Sequences of a text whose digests are taken at a time.
_DIGESTS = 512


def dedup_report(df: DataFrame, key: str) -> DataFrame:
    """Rows before, after and removed when deduplicating on a key; null is one key."""
    counts = df.select(F.sha2(F.col(key).cast("string"), 256).alias("digest")).groupBy("digest").count()
    before, after = F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))
    return counts.agg(
        before.alias("n_before"), after.alias("n_after"), (before - after).alias("n_removed")
    )


def repeated_keys(df: DataFrame, key: str | Column, name: str = "key") -> DataFrame:
    """Keys with more than one row, and how many."""
    column = F.col(key) if isinstance(key, str) else key
    return (
        df.groupBy(column.alias(name))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def append_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    return existing.unionByName(new)


def manifest_upsert(
    manifest: DataFrame, listing: DataFrame, page_count: Column | None = None,
    retry_nulls: bool = False,
) -> DataFrame:
    """Existing manifest plus one row per listed file that it does not know yet.

    Rows whose page count failed count as known unless ``retry_nulls`` is set.
    """
    known = manifest.filter(F.col("page_count").isNotNull()) if retry_nulls else manifest
    counted = page_count if page_count is not None else F.lit(None)
    new = pending(listing, known, "file_id").select(
        normalize_file_name("name").alias("normalized_name"),
        counted.cast("int").alias("page_count"),
        "file_id",
    )
    return known.select("normalized_name", "page_count", "file_id").unionByName(new)


def volume_progress(
    listed: DataFrame, done: DataFrame, volume: str = "volume", key: str = "key"
) -> DataFrame:
    """Distinct listed and processed papers per volume, and whether it is complete.

    Both sides are tagged and grouped once instead of joined.
    """
    tagged = listed.select(volume, key, F.lit(1).alias("is_listed"), F.lit(0).alias("is_done")).unionByName(
        done.select(volume, key, F.lit(0).alias("is_listed"), F.lit(1).alias("is_done"))
    )
    per_key = (
        tagged.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
        .groupBy(volume, key)
        .agg(F.max("is_listed").alias("listed"), F.max("is_done").alias("done"))
        .filter("listed = 1")
    )
    return per_key.groupBy(volume).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.sum("done").alias("n_done"),
        (F.sum("done") >= F.count(F.lit(1))).alias("complete"),
    )


def complete_models(
    results: DataFrame, articles: DataFrame, model: str = "model", pos: str = "pos"
) -> DataFrame:
    """Models with a result for every listed article; repeats and unlisted articles don't count."""
    listed = articles.select(pos).where(F.col(pos).isNotNull()).distinct()
    total = listed.agg(F.count(F.lit(1)).alias("n"))
    done = results.select(model, pos).distinct().join(listed, pos, "left_semi")
    per_model = done.groupBy(model).agg(F.count(F.lit(1)).alias("n_done"))
    return per_model.withColumn("n_total", total.scalar()).filter("n_done = n_total")


def publishable(
    results: DataFrame, articles: DataFrame, model: str = "model", pos: str = "pos"
) -> DataFrame:
    """Results of complete models only."""
    return results.join(complete_models(results, articles, model, pos), model, "left_semi")


def resume_summary(results: DataFrame, model: str = "model", pos: str = "pos") -> DataFrame:
    """Articles done per model and the position to go on from."""
    return results.groupBy(model).agg(
        (F.max(pos) + 1).alias("next_pos"), F.count(F.lit(1)).alias("n_done")
    )


def high_water_mark(waiting: DataFrame, model: str = "model", pos: str = "pos") -> DataFrame:
    """Length of the finished prefix per model: the first position still to do."""
    return waiting.groupBy(model).agg(F.min(pos).alias("done_prefix"))


def first_positions(df: DataFrame, n: int | None, pos: str = "pos") -> DataFrame:
    """First ``n`` rows of a densely numbered list; None and 0 mean all."""
    return df.filter(F.col(pos) < n) if n else df


def at_position(df: DataFrame, index: int, pos: str = "pos") -> DataFrame:
    return df.filter(F.col(pos) == index)


def assemble_pages(pages: DataFrame, document: str, page: str, text: str) -> DataFrame:
    """``(document, n_pages, text)``: one row a document, its pages in page order.

    Each page is followed by a blank line. Page numbers may begin anywhere and have gaps.
    """
    pieces = pages.select(
        document, page, F.concat(F.coalesce(F.col(text), F.lit("")), F.lit(PAGE_END)).alias("_piece")
    )
    return pieces.groupBy(document).agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.expr(f"listagg(_piece, '') within group (order by `{page}`)").alias("text"),
    )


def sections(documents: DataFrame, key: str, text: str, heading: str) -> DataFrame:
    """Text cut at heading lines: ``(key, section, heading, body)``.

    ``heading`` is a pattern for a whole line. Section 0 is what comes before the first one.
    Headings are the pattern's matches and bodies what lies between them, so no character of
    the text can be mistaken for a mark.
    """
    line = f"(?m)^(?:{heading})$"
    bodies = F.split(F.col(text), line)
    headings = F.concat(F.array(F.lit("")), F.regexp_extract_all(F.col(text), F.lit(line), F.lit(0)))
    pieces = documents.select(key, F.posexplode(F.arrays_zip(headings.alias("heading"), bodies.alias("body"))).alias("section", "piece"))
    return pieces.select(
        key,
        F.col("section").cast("bigint").alias("section"),
        F.col("piece.heading").alias("heading"),
        F.col("piece.body").alias("body"),
    )


def article_parts(documents: DataFrame, key: str, text: str, abstract: str, heading: str) -> DataFrame:
    """``(key, title, abstract, content)``: first line, text under the abstract heading up to
    the next heading line, and everything after that."""
    body = F.col(text)
    after = F.regexp_extract(body, rf"(?ms)^(?:{abstract})\n(.*)", 1)
    own = F.element_at(F.split(after, f"(?m)^(?:{heading})$", 2), 1)
    found = F.regexp_like(body, F.lit(rf"(?m)^(?:{abstract})$"))
    rest = F.when(found, F.substr(after, F.length(own) + 1)).otherwise(F.regexp_replace(body, r"\A[^\n]*\n?", ""))
    return documents.select(
        key,
        F.substring_index(body, "\n", 1).alias("title"),
        F.when(found, own).otherwise(F.lit("")).alias("abstract"),
        rest.alias("content"),
    )


def trigram_check(
    pairs: DataFrame, keys: Sequence[str], checked: str, against: str, n_samples: int | None = None,
    seed: str = "check",
) -> DataFrame:
    """Distinct 3-word sequences of one text, and how many of them the other has.

    All sequences are tested, or a seeded sample: the ``n_samples`` with the smallest digests,
    the same on every run and every partitioning.
    """
    texts = pairs.select(*keys, F.col(checked).alias("_own"), F.col(against).alias("_other"))
    tokens = texts.select(*keys, words("_own").alias("_own"), words("_other").alias("_other"))
    grams = tokens.select(
        *keys, F.array_distinct(word_ngrams("_own", 3)).alias("_own"), word_ngrams("_other", 3).alias("_other")
    )
    tested = grams.select(*keys, _sampled("_own", n_samples, seed).alias("_sample"), "_other")
    return tested.select(
        *keys,
        F.size("_sample").alias("n_sampled"),
        F.size(F.array_intersect("_sample", "_other")).alias("n_found"),
    )


def _sampled(grams: str, n_samples: int | None, seed: str) -> Column:
    """An array of distinct sequences, or the ``n_samples`` of it with the smallest digests."""
    if n_samples is None:
        return F.col(grams)
    ranked = F.array_sort(F.transform(grams, lambda g: F.struct(F.md5(F.concat(F.lit(f"{seed}:"), g)), g.alias("gram"))))
    return F.transform(F.slice(ranked, 1, n_samples), lambda s: s["gram"])


def trigram_check_in_corpus(
    checked: DataFrame, corpus: DataFrame, key: str, text: str = "text", n_samples: int | None = None, seed: str = "check",
) -> DataFrame:
    """Distinct 3-word sequences of each text, and how many of them occur anywhere in another corpus.

    Columns: ``key, n_sampled, n_found``, sampled as in ``trigram_check``. Rows of one key (null is one) are one
    document. Null and short texts have no sequences, and an empty corpus has none to find.

    The checked sequences are written once and make a sieve of bits, of bounded size, which tells what a text of the
    corpus need not send: it holds no sequence back that is asked for. What passes is sent once a batch of texts and meets
    the checked sequences as words, so there are no false hits. With more than ``SIEVE_GRAMS`` checked
    sequences a sieve would be full, and the corpus sends each sequence once a batch.

    A sample of many texts against a corpus of at most ``2 * SIEVE_GRAMS`` bytes goes the other way round: the corpus makes
    the sieve, and of a sample only sequences that pass it are sent, with the number of the others.
    """
    if n_samples and _fits_sieve(corpus, text):
        known, _ = cut(_known_trigrams(corpus, text, None).distinct(), "known")
        sieve = _sieve(known.select(F.col("_known").alias("_gram")))
        asked, _ = cut(_sample_hits(checked, key, text, n_samples, seed, sieve), "asked")
    else:
        asked, _ = cut(_asked_trigrams(checked, key, text, n_samples, seed).withColumn("_absent", F.lit(0).cast("bigint")), "asked")
        sieve = _sieve(asked) if asked.count() <= SIEVE_GRAMS else None
        known, _ = cut(_known_trigrams(corpus, text, sieve).distinct(), "known")
    if sieve:
        sieve.destroy()
    met = asked.join(known, F.col("_gram") == F.col("_known"), "left").distinct()
    sampled = F.count("_gram") + F.sum("_absent")
    return met.groupBy("_key").agg(sampled.alias("n_sampled"), F.count("_known").alias("n_found")).withColumnRenamed("_key", key)


def _fits_sieve(corpus: DataFrame, text: str) -> bool:
    """Whether the texts have at most ``SIEVE_GRAMS`` sequences by their bytes, of which a word takes two or more."""
    return corpus.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)) <= 2 * SIEVE_GRAMS).first()[0]


def _sample_hits(texts: DataFrame, key: str, text: str, n_samples: int, seed: str, sieve: Broadcast) -> DataFrame:
    """``(_key, _gram, _absent)``: the sequences of each row's sample that pass the sieve, and a null one with the number of the others.

    Rows that share a key, null being one, give the whole sample, as their samples are one. Elsewhere a sequence that passes is in
    the sample if fewer than ``n_samples`` distinct ones of its text have smaller digests, which often is refuted after a few.
    """
    prefix = f"{seed}:".encode()

    def digest(gram: bytes) -> bytes:
        return hashlib.md5(prefix + gram).digest()

    def sampled(hits: set[bytes], spans: list[tuple[int, int]], data: bytes) -> list[bytes]:
        asked, seen, least = {digest(g): g for g in hits}, set(), []
        last = max(asked)
        for i in range(0, len(spans), _DIGESTS):
            fresh = {data[a:b] for a, b in spans[i : i + _DIGESTS]} - seen
            seen |= fresh
            least += [d for d in map(digest, fresh) if d <= last]
            if len(least) >= n_samples:
                least = sorted(least)[:n_samples]
                asked = {d: g for d, g in asked.items() if d <= least[-1]}
                if not asked:
                    break
                last = max(asked)
        return list(asked.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, held, again = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            for part in parts(held):
                tokens = tokenize(held[part])
                places, n = gram_places(tokens, 3), part.stop - part.start
                hashes = np.concatenate([np.empty(0, np.uint64), *[h for _, h in gram_hashes(tokens, places, 3)]])
                passing = np.flatnonzero(_passes(sieve.value, hashes))
                data, starts, ends = tokens.data.tobytes(), tokens.starts[places], tokens.ends[places + 2]
                upto = np.searchsorted(tokens.rows[places], np.arange(n + 1)).tolist()
                of_hits = np.searchsorted(passing, upto).tolist()
                rows, grams, absent = [], [], []
                for i in range(n):
                    first, stop = upto[i], upto[i + 1]
                    spans = lambda: list(zip(starts[first:stop].tolist(), ends[first:stop].tolist(), strict=True))  # noqa: B023
                    if again[part.start + i]:
                        found, others = sorted({data[a:b] for a, b in spans()}, key=digest)[:n_samples], 0
                    else:
                        # As many distinct hashes are as many distinct sequences.
                        n_own = len(set(hashes[first : min(stop, first + 2 * n_samples)].tolist()))
                        if n_own < n_samples:
                            n_own = len({data[a:b] for a, b in spans()})
                        hits = {data[starts[j] : ends[j]] for j in passing[of_hits[i] : of_hits[i + 1]]}
                        found = sampled(hits, spans(), data) if hits else []
                        others = min(n_own, n_samples) - len(found)
                    grams += [*found, None]
                    absent += [0] * len(found) + [others]
                    rows += [part.start + i] * (len(found) + 1)
                columns = [keys.take(pa.array(rows, pa.int64())), pa.array(grams, pa.binary()).cast(pa.string()), pa.array(absent, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["_key", "_gram", "_absent"])

    rows = texts.select(F.col(key).alias("_key"), closed_text(text).alias("_text"))
    repeated = rows.groupBy(F.col("_key").alias("_same")).count().where("count > 1")
    again, _ = cut(repeated.select("_same", F.lit(True).alias("_again")), "again")
    rows = rows.join(again, F.col("_key").eqNullSafe(F.col("_same")), "left").drop("_same")
    fields = [rows.schema["_key"], T.StructField("_gram", T.StringType()), T.StructField("_absent", T.LongType())]
    return rows.mapInArrow(run, T.StructType(fields))


def _asked_trigrams(texts: DataFrame, key: str, text: str, n_samples: int | None, seed: str) -> DataFrame:
    """``(_key, _gram)``: the distinct sequences of each row, or its sample; a null one for a row without any."""

    def chosen(grams: list[bytes]) -> list[bytes]:
        if n_samples is None or len(grams) <= n_samples:
            return grams
        digests = b"".join([hashlib.md5(prefix + g).digest() for g in grams])
        lead = np.frombuffer(digests, ">u8")[::2].astype(np.uint64)
        near = np.flatnonzero(lead <= np.partition(lead, n_samples)[n_samples]).tolist()
        return [g for _, g in sorted((digests[16 * i : 16 * i + 16], grams[i]) for i in near)[:n_samples]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, held = batch.column(0), batch.column(1)
            for part in parts(held):
                tokens = tokenize(held[part])
                places, n = gram_places(tokens, 3), part.stop - part.start
                data, starts, ends = tokens.data.tobytes(), tokens.starts[places].tolist(), tokens.ends[places + 2].tolist()
                upto = np.searchsorted(tokens.rows[places], np.arange(n + 1)).tolist()
                grams, sizes = [], []
                for i in range(n):
                    of_row = slice(upto[i], upto[i + 1])
                    found = chosen(list({data[a:b] for a, b in zip(starts[of_row], ends[of_row], strict=True)})) or [None]
                    grams += found
                    sizes.append(len(found))
                rows = pa.array(np.repeat(np.arange(part.start, part.stop), sizes))
                yield pa.RecordBatch.from_arrays([keys.take(rows), pa.array(grams, pa.binary()).cast(pa.string())], ["_key", "_gram"])

    prefix = f"{seed}:".encode()
    rows = texts.select(F.col(key).alias("_key"), closed_text(text).alias("_text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["_key"], T.StructField("_gram", T.StringType())]))


def _known_trigrams(texts: DataFrame, text: str, sieve: Broadcast | None) -> DataFrame:
    """``(_known)``: the sequences of the texts that pass the sieve, each once a part of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0)
            for part in parts(held):
                tokens = tokenize(held[part])
                places = gram_places(tokens, 3)
                if sieve:
                    passed = [block[_passes(sieve.value, hashes)] for block, hashes in gram_hashes(tokens, places, 3)]
                    places = np.concatenate(passed) if passed else places
                found = pc.unique(gram_texts(tokens, places, 3))
                yield pa.RecordBatch.from_arrays([found.cast(pa.string())], ["_known"])

    return texts.select(closed_text(text)).mapInArrow(run, "_known string")


def _sieve(asked: DataFrame) -> Broadcast:
    """A broadcast table of 2 to the power of ``SIEVE_BITS`` bits with those of the sequences' hashes set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0)
            for part in parts(held):
                tokens = tokenize(held[part])
                for _, hashes in gram_hashes(tokens, gram_places(tokens, 3), 3):
                    bits = np.unique(hashes >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(bits >> 6), pa.array(bits & 63)], ["cell", "bit"])

    bits = asked.where("_gram IS NOT NULL").select(closed_text("_gram")).mapInArrow(run, "cell bigint, bit bigint")
    marks = bits.groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("marks")).toArrow()
    table = np.zeros(1 << (SIEVE_BITS - 6), np.uint64)
    table[marks.column("cell").to_numpy()] = marks.column("marks").to_numpy().view(np.uint64)
    return asked.sparkSession.sparkContext.broadcast(table)


def _passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes >> np.uint64(64 - SIEVE_BITS)
    return (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def fuzzy_title_match(
    left: DataFrame, right: DataFrame, key: str = "title", max_distance: int = 2
) -> DataFrame:
    """Distinct (left, right) titles within an edit distance.

    Exact, without all pairs: a right title is cut into ``max_distance + 1`` pieces, and by the
    pigeonhole principle a match contains at least one of them nearly in place (Li et al.,
    "Pass-Join", VLDB 2011). Only titles sharing such a piece are compared. Copies of a title
    are reduced to one before the join.
    """
    k = int(max_distance)
    one = left.select(F.col(key).alias("left_title")).filter("left_title is not null").distinct()
    two = right.select(F.col(key).alias("right_title")).filter("right_title is not null").distinct()
    size, piece = F.col("size"), F.col("piece")

    def cut(df: DataFrame) -> DataFrame:
        # First size % (k+1) pieces from the back are one character longer.
        short = F.expr(f"size div {k + 1}")
        longer = F.pmod(size, F.lit(k + 1))
        extra = F.greatest(piece - (F.lit(k + 1) - longer), F.lit(0))
        return df.withColumn("start", piece * short + extra).withColumn(
            "span", short + F.when(piece >= F.lit(k + 1) - longer, 1).otherwise(0)
        )

    pieces = F.explode(F.sequence(F.lit(0), F.lit(k)))
    index = cut(two.withColumn("size", F.length("right_title")).withColumn("piece", pieces)).select(
        "right_title", "size", "piece",
        F.substr("right_title", F.col("start") + 1, F.col("span")).alias("signature"),
    )
    shift = F.col("left_size") - size
    probe = (
        one.withColumn("left_size", F.length("left_title"))
        .withColumn("size", F.explode(F.sequence(F.greatest(F.col("left_size") - k, F.lit(0)), F.col("left_size") + k)))
        .withColumn("piece", pieces)
    )
    probe = cut(probe)
    lowest = F.greatest(F.col("start") - piece, F.col("start") + shift - (k - piece), F.lit(0))
    highest = F.least(
        F.col("start") + piece, F.col("start") + shift + (k - piece), F.col("left_size") - F.col("span")
    )
    probe = (
        probe.withColumn("low", lowest).withColumn("high", highest).filter("low <= high")
        .withColumn("at", F.explode(F.sequence("low", "high")))
        .select(
            "left_title", "size", "piece",
            F.substr("left_title", F.col("at") + 1, F.col("span")).alias("signature"),
        )
        .distinct()
    )
    distance = F.levenshtein("left_title", "right_title", k)
    return (
        probe.join(index, ["size", "piece", "signature"])
        .select("left_title", "right_title", distance.alias("distance"))
        .filter("distance >= 0")
        .distinct()
    )
