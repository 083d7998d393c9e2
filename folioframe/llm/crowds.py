"""Links between the components of a crowded bucket, by blocks of its members' full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.llm.minhash_sketch import shingle_set
from folioframe.llm.words import byte_column, lower_ascii

#: Shingles, with an allowance a member, of a block. Two blocks and one text are what a task holds at most.
BLOCK = 400_000

_SETS = pa.schema([("set_of", pa.int64()), ("grams", pa.binary())])
_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def crowd_links(members: DataFrame, texts: DataFrame, k: int, percent: int, block: int = BLOCK) -> DataFrame:
    """Links ``(u, v)`` that join the components of each bucket of ``members(bucket, rep, n_shingles, label, weight)``.

    A bucket of at most ``block`` is one group. A larger one is dealt into blocks by a hash of the member,
    and each pair of blocks is a group, so any two members meet in one and no task holds more than two
    blocks. A group judges every pair of members of unlike labels on the full sets, unless links that it
    has found already join them, and gives a spanning forest of the labels. ``texts(rep, text)`` has a row
    for each ``rep``. Without members there are no links.
    """
    parts = F.ceil(F.col("weight") / F.lit(block)).cast("int")
    others = F.when(parts == 1, F.array(F.lit(0))).otherwise(
        F.array_except(F.sequence(F.lit(0), parts - 1), F.array(F.col("own")))
    )
    dealt = (
        members.withColumn("own", F.pmod(F.xxhash64("rep"), parts).cast("int"))
        .select("bucket", "rep", "label", "own", F.explode(others).alias("other"))
        .select("bucket", "rep", "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    sets = _sets(texts.join(members.select("rep").distinct(), "rep", "left_semi"), k)
    groups = dealt.join(sets, F.col("rep") == F.col("set_of")).select("bucket", "i", "j", "rep", "label", "grams")

    def judge(table: pa.Table) -> pa.Table:
        return _forest(table, percent)

    return groups.groupBy("bucket", "i", "j").applyInArrow(judge, "u bigint, v bigint").distinct()


def _sets(texts: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                grams = [shingle_set(lower_ascii(data).split(), k).tobytes() for data in byte_column(part, "text")]
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(grams, pa.binary())], schema=_SETS)

    return texts.mapInArrow(run, "set_of bigint, grams binary")


def _forest(table: pa.Table, percent: int) -> pa.Table:
    """Links that join the labels of one group's members, at most one fewer than there are labels.

    Members of the commonest label are never the side that looks, so each pair of unlike labels is
    seen from one side at least. A member looks up the holders of each of its shingles. One whose
    shared shingles alone can't make up the similarity is passed over.
    """
    reps = table.column("rep").to_numpy()
    _, roots = np.unique(table.column("label").to_numpy(), return_inverse=True)
    sizes = np.bincount(roots)
    if len(sizes) < 2:
        return _links([], [])
    sets = [np.frombuffer(value, np.uint64) for value in table.column("grams").to_pylist()]
    lengths = np.array([len(s) for s in sets])
    ends = np.cumsum(lengths)
    _, ids, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owners = np.repeat(np.arange(len(sets)), lengths)[np.argsort(ids, kind="stable")]
    starts = np.cumsum(holders) - holders
    shared = np.add.reduceat(holders[ids] > 1, ends - lengths, dtype=np.int64)
    look = np.flatnonzero((roots != sizes.argmax()) & (shared * 100 >= percent * lengths))
    u, v = [], []
    for x in look:
        own = ids[ends[x] - lengths[x] : ends[x]]
        own = own[holders[own] > 1]
        spans = holders[own]
        at = np.repeat(starts[own] - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
        both = np.bincount(owners[at], minlength=len(sets))
        alike = both * 100 >= (lengths[x] + lengths - both) * percent
        for y in np.flatnonzero(alike & (roots != roots[x])):
            if roots[y] != roots[x]:
                u.append(reps[x])
                v.append(reps[y])
                roots[roots == roots[y]] = roots[x]
    return _links(u, v)


def _links(u: list[int], v: list[int]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=_LINKS)
