"""Ordered scans (running totals, next row, first row) that never hold a whole group in one task.

A group is cut into consecutive segments. Totals are taken per segment, summed over the table of
segments, and added back as offsets to the running totals inside each segment. A group with a
third of all rows is therefore spread over many tasks.

The table of segments is written to the shared folder, so the input is computed twice and no more
however many scans follow each other. Where an order column has gaps, a segment may hold a single row
and a group as many segments as rows. That table is then scanned in the same way, in spans of ``fan``
segments, by as many levels as it takes: no window holds more than ``width`` rows or ``fan`` segments.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioframe.session import cut

SEGMENT, SPAN = "_segment", "_span"
WIDTH = 65_536
#: Segments of a span.
FAN = 1_048_576


def by_width(df: DataFrame, order: str, width: int = WIDTH) -> DataFrame:
    """Segments of ``width`` consecutive values of a non-negative integer order column.

    With an order column that is unique in its group a segment has at most ``width`` rows,
    wherever the values lie. Rows without an order value are a segment before all others.
    """
    return df.withColumn(SEGMENT, F.expr(f"`{order}` div {int(width)}"))


def by_range(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Segments from range partitioning on any sortable columns.

    The result is written to the shared folder: range bounds come from a sample, so the segment
    numbers must be fixed before two branches of a plan use them.
    """
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(count, *order)
    return cut(ranged.withColumn(SEGMENT, F.spark_partition_id().cast("bigint")), "ranged")[0]


def scan_groups(
    segmented: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column | int] | None = None,
    following: Mapping[str, str] | None = None,
    first: Mapping[str, str] | None = None,
    fan: int = FAN,
) -> DataFrame:
    """Add ordered columns per group of a segmented table; null keys form groups like any other.

    ``totals``: name -> amount; adds the inclusive running total ``name`` and the group
    total ``name_all``. ``following``: name -> column whose next value in the group is
    wanted. ``first``: name -> column whose first value in the group is wanted. The segments come
    from ``by_width`` or ``by_range``; neither their size nor ``fan`` ever changes a result.
    """
    totals, following, first = dict(totals or {}), dict(following or {}), dict(first or {})
    keys, order = list(keys), list(order)
    kept = [c for c in segmented.columns if c != SEGMENT]
    for name, amount in totals.items():
        segmented = segmented.withColumn(f"_amount_{name}", F.lit(amount))

    at = F.struct(*order)
    parts = [F.sum(f"_amount_{name}").alias(f"_part_{name}") for name in totals]
    heads = sorted(set(following.values()) | set(first.values()))
    parts += [F.min_by(F.struct(c), at).alias(f"_head_{c}") for c in heads]
    summed, _ = cut(segmented.groupBy(*keys, SEGMENT).agg(*parts), "segments")
    offsets = segment_offsets(summed, keys, list(totals), following, first, fan)

    inside = W.partitionBy(*keys, SEGMENT).orderBy(*order)
    running = inside.rowsBetween(W.unboundedPreceding, 0)
    computed = [
        (F.col(f"_offset_{n}") + F.sum(f"_amount_{n}").over(running)).alias(n) for n in totals
    ]
    computed += [F.col(f"{n}_all") for n in totals]
    computed += [
        F.coalesce(F.lead(F.struct(c)).over(inside), F.col(f"_next_{n}"))[c].alias(n)
        for n, c in following.items()
    ]
    computed += [F.col(f"_first_{n}")[c].alias(n) for n, c in first.items()]
    return _by_place(segmented, offsets, [*keys, SEGMENT]).select(*kept, *computed)


def segment_offsets(
    summed: DataFrame, keys: Sequence[str], totals: Sequence[str], following: Mapping[str, str],
    first: Mapping[str, str], fan: int = FAN,
) -> DataFrame:
    """What ``scan_groups`` adds to the rows of each segment, as one row a segment.

    ``summed`` has ``_part_<total>`` and ``_head_<column>`` of every segment. Segments numbered below ``fan``
    are scanned at once. Others are scanned inside spans of ``fan`` numbers, and the spans, numbered
    by less, by this function.
    """
    if fan < 2:
        raise ValueError("a span has two segments or more")
    last = summed.agg(F.max(SEGMENT)).first()[0]
    spans = last is not None and last >= fan
    place = [F.expr(f"{SEGMENT} div {int(fan)}").alias(SPAN)] if spans else []
    inside = [SPAN] if spans else []
    across = W.partitionBy(*keys, *inside).orderBy(SEGMENT)
    before = across.rowsBetween(W.unboundedPreceding, -1)
    group = W.partitionBy(*keys)
    placed = summed.select("*", *place)
    near = placed.select(
        *keys, SEGMENT, *inside,
        *[F.coalesce(F.sum(f"_part_{n}").over(before), F.lit(0)).alias(f"_offset_{n}") for n in totals],
        *[F.lead(f"_head_{c}").over(across).alias(f"_next_{n}") for n, c in following.items()],
        *([] if spans else [F.sum(f"_part_{n}").over(group).alias(f"{n}_all") for n in totals]),
        *([] if spans else [F.first(f"_head_{c}").over(across).alias(f"_first_{n}") for n, c in first.items()]),
    )
    if not spans:
        return near
    heads = sorted(set(following.values()) | set(first.values()))
    # a struct, as a null segment is a place like any other
    upper = placed.groupBy(*keys, F.col(SPAN).alias(SPAN)).agg(
        *[F.sum(f"_part_{n}").alias(f"_part_{n}") for n in totals],
        *[F.min_by(f"_head_{c}", F.struct(SEGMENT)).alias(f"_head_{c}") for c in heads],
    )
    upper, _ = cut(upper.withColumnRenamed(SPAN, SEGMENT), "spans")
    renamed = {f"_offset_{n}": f"_far_{n}" for n in totals} | {f"_next_{n}": f"_after_{n}" for n in following}
    far = segment_offsets(upper, keys, totals, following, first, fan).withColumnsRenamed(renamed | {SEGMENT: SPAN})
    return _by_place(near, far, [*keys, SPAN]).select(
        *[near[c] for c in [*keys, SEGMENT]],
        *[(F.col(f"_offset_{n}") + F.col(f"_far_{n}")).alias(f"_offset_{n}") for n in totals],
        *[F.coalesce(f"_next_{n}", f"_after_{n}").alias(f"_next_{n}") for n in following],
        *[F.col(f"{n}_all") for n in totals],
        *[F.col(f"_first_{n}") for n in first],
    )


def _by_place(rows: DataFrame, offsets: DataFrame, place: Sequence[str]) -> DataFrame:
    """Every row with the offsets of its place; nulls are equal."""
    named = offsets.withColumnsRenamed({c: f"_at_{i}" for i, c in enumerate(place)})
    same = F.lit(True)
    for i, c in enumerate(place):
        same = same & rows[c].eqNullSafe(named[f"_at_{i}"])
    return rows.join(named, same, "left")


def dense_position(
    df: DataFrame, order: Sequence[str], name: str = "pos", partitions: int | None = None
) -> DataFrame:
    """Positions 0, 1, 2, ... in the given total order, without a single-task window."""
    counted = scan_groups(by_range(df, order, partitions), [], order, totals={name: 1})
    return counted.withColumn(name, F.col(name) - 1).drop(f"{name}_all")
