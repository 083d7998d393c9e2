"""SimHash near-duplicates: pigeonring chains of segments choose the pairs whose bits are compared."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.llm.components import connected_components
from folioframe.llm.words import byte_column, lower_ascii
from folioframe.session import cut, discard

_SEGMENTS, _WIDTH = 4, 16
_PART = 1 << 15


def fingerprint(words: list[bytes], k: int = 3, seed: int = 42) -> int:
    """64 bits, each the majority of that bit over the XXH64 of all ``k``-word shingles, repeats included.

    Fewer words are one shingle; without words every bit is 0. A tie gives 0.
    """
    if not words:
        return 0
    k = min(k, len(words))
    plain = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - k + 1].tolist()
    ends = (ends[k - 1 :] - 1).tolist()
    votes = np.zeros(64, np.int64)
    for at in range(0, len(starts), _PART):
        shingles = [plain[a:b] for a, b in zip(starts[at : at + _PART], ends[at : at + _PART], strict=True)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), "<u8", len(shingles))
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view("<u8")[0])


def simhash_groups(
    docs: DataFrame, k: int = 3, differing: int = 3, crowd: int = 64, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    Fingerprints that differ in at most ``differing`` (0 to 3) of their 64 bits are linked;
    ``component_id`` is the smallest id reachable over links, itself included.

    1. Rows of equal fingerprints are one node, so copies cost nothing further on.
    2. A fingerprint is a ring of four segments of 16 bits. By the pigeonring principle a pair within
       the budget has a segment from where each chain of ``n`` consecutive segments differs in at
       most ``n * differing / 4`` bits: 0, 1, 2 and 3 for three. Chains of two are the join key: one side
       as it is, the other also with one bit of the second segment turned on, so a pair meets once.
    3. A key that more than ``crowd`` fingerprints hold isn't joined: its chains are made longer by
       a segment, with all the bits turned that the budget leaves, and for crowds of these
       by another, which is the whole fingerprint. So rows grow with the members of a crowd and not
       with their pairs, and no pair is lost.
    4. Pairs that meet go through the budgets of the remaining chains and the whole; links give components.

    Null or wordless texts have fingerprint zero and are linked like any other. Rows without an
    id take part; their component is null if it has no id at all. Rows that repeat an id are a node
    each, linked by their own fingerprints. Other columns are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    printed, printed_path = cut(_printed(source, k), "fingerprints")
    nodes = printed.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    links, link_path = similar_fingerprints(nodes.select("fp"), differing, crowd)
    labels = connected_components(links)
    grouped, grouped_path = cut(
        nodes.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "rep", F.coalesce("component", "fp").alias("group")),
        "groups",
    )
    discard(spark, link_path)
    least = grouped.groupBy("group").agg(F.min("rep").alias("component_id"))
    by_print = grouped.select("fp", "group").join(least, "group").select("fp", "component_id")
    return printed.join(by_print, "fp").select("doc_id", hexadecimal("fp").alias("fingerprint"), "component_id")


def hexadecimal(fp: str) -> Column:
    """16 lowercase digits of a 64-bit integer."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _printed(source: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(lower_ascii(data).split(), k) for data in byte_column(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64))], names=["doc_id", "fp"]
            )

    return source.mapInArrow(run, "doc_id bigint, fp bigint")


def similar_fingerprints(nodes: DataFrame, differing: int = 3, crowd: int = 64) -> tuple[DataFrame, str]:
    """Links ``(u, v)`` of distinct fingerprints ``fp`` that differ in at most ``differing`` bits, each once, and their table."""
    if not 0 <= differing < _SEGMENTS:
        raise ValueError("four segments allow for 0 to 3 differing bits")
    budgets = [(n * differing) // _SEGMENTS for n in range(1, _SEGMENTS + 1)]
    starts = F.explode(F.array(*[F.struct(F.lit(s).alias("start"), _turned("fp", s).alias("ring")) for s in range(_SEGMENTS)]))
    rings, ring_path = cut(nodes.select("fp", starts.alias("r")).select("fp", "r.start", "r.ring"), "rings")
    held = rings.select(F.col("fp").alias("v"), "start", "ring")
    asking = rings.select(F.col("fp").alias("u"), "start", "ring", F.lit(0).alias("spent"))
    found, scratch = [], [ring_path]
    for segments in range(2, _SEGMENTS + 1):
        held = held.withColumn("key", _head("ring", segments))
        asking = asking.withColumn("key", F.explode(_near_heads(segments, budgets[segments - 1], once=segments == 2)))
        if segments < _SEGMENTS:
            counted = held.groupBy("start", "key").agg(F.count("*").alias("n"))
            crowded, crowd_path = cut(counted.where(F.col("n") > crowd).select("start", "key"), "crowded")
            scratch.append(crowd_path)
            calm = [side.join(crowded, ["start", "key"], "left_anti") for side in (held, asking)]
        else:
            calm = [held, asking]
        found.append(_meeting(*calm, budgets))
        if segments == _SEGMENTS or crowded.isEmpty():
            break
        # what was turned so far stays in the asked ring, and counts against the budget
        turned = F.col("ring").bitwiseXOR(_head("ring", segments)).bitwiseXOR(F.col("key"))
        spent = F.col("spent") + F.bit_count(turned.bitwiseXOR(F.col("ring")))
        held = held.join(crowded, ["start", "key"], "left_semi").select("v", "start", "ring")
        asking = asking.join(crowded, ["start", "key"], "left_semi").select("u", "start", turned.alias("ring"), spent.alias("spent"))
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    written = cut(links, "links")
    discard(nodes.sparkSession, *scratch)
    return written


def _turned(fp: str, start: int) -> Column:
    """The ring read from segment ``start`` on, its first segment in the lowest bits."""
    if start == 0:
        return F.col(fp)
    return F.shiftrightunsigned(fp, _WIDTH * start).bitwiseOR(F.shiftleft(fp, 64 - _WIDTH * start))


def _head(ring: str, segments: int) -> Column:
    bits = _WIDTH * segments
    return F.col(ring) if bits == 64 else F.col(ring).bitwiseAND(F.lit((1 << bits) - 1))


def _near_heads(segments: int, budget: int, once: bool) -> Column:
    """The head of a ring, and those with up to ``budget - spent`` bits of its last segment turned.

    With ``once`` bits are only turned on, so of a pair that differs in one bit one side asks.
    """
    low = _WIDTH * (segments - 1)
    head = _head("ring", segments)
    bits = F.sequence(F.lit(low), F.lit(low + _WIDTH - 1))
    one = F.lit(1).cast("bigint")

    def flips(size: int) -> list[int]:
        places = [1 << (low + i) for i in range(_WIDTH)]
        sums = {0: 0}
        for _ in range(size):
            sums = {mask | p: 0 for mask in sums for p in places if not mask & p}
        return [mask - (1 << 64) if mask >> 63 else mask for mask in sums]

    if once:
        off = F.filter(bits, lambda b: F.getbit(F.col("ring"), b) == 0) if budget else F.array().cast("array<int>")
        return F.concat(F.array(head), F.transform(off, lambda b: head.bitwiseXOR(F.call_function("shiftleft", one, b))))
    every = F.array(head)
    for size in range(1, budget + 1):
        masks = F.lit(flips(size)).cast("array<bigint>")
        more = F.transform(masks, lambda m: head.bitwiseXOR(m))
        every = F.concat(every, F.when(F.col("spent") + size <= budget, more).otherwise(F.array().cast("array<bigint>")))
    return every


def _meeting(held: DataFrame, asking: DataFrame, budgets: list[int]) -> DataFrame:
    """Pairs of one key that keep the budgets of every chain from their start, at their first such start."""
    parts = [
        F.bit_count(_turned("both", s).bitwiseAND(F.lit((1 << _WIDTH) - 1))) for s in range(_SEGMENTS)
    ]
    pairs = asking.join(held.drop("ring"), ["start", "key"]).where("u != v")
    pairs = pairs.withColumn("both", F.col("u").bitwiseXOR(F.col("v"))).where(F.bit_count("both") <= budgets[-1])
    pairs = pairs.select("u", "v", "start", *[part.alias(f"part_{s}") for s, part in enumerate(parts)])
    first = None
    for s in reversed(range(_SEGMENTS)):
        chain = F.lit(True)
        for n, budget in enumerate(budgets, 1):
            total = sum((F.col(f"part_{(s + i) % _SEGMENTS}") for i in range(1, n)), F.col(f"part_{s}"))
            chain = chain & (total <= budget)
        first = F.when(chain, F.lit(s)).otherwise(first if first is not None else F.lit(-1))
    # no bit turned in the key's second segment: both sides ask, and one order counts
    second = F.element_at(F.array(*[F.col(f"part_{s}") for s in range(_SEGMENTS)]), F.pmod(F.col("start") + 1, F.lit(_SEGMENTS)) + 1)
    pairs = pairs.where(F.col("start") == first).where((second > 0) | (F.col("u") < F.col("v")))
    return pairs.select("u", "v")
