"""Dataset profile: counts and the numeric summary."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def column_types(df: DataFrame) -> DataFrame:
    """``(column, type)`` in column order; read from the schema, no job."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def row_counts(df: DataFrame) -> DataFrame:
    """``(column, n_rows, n_non_null)`` for every column in one pass."""
    cells = [
        F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_rows"), F.count(F.col(c)).alias("n_non_null"))
        for c in df.columns
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, n, mean, std, min, q25, q50, q75, max)`` of numeric columns.

    Counts, moments and ends come from one pass without a shuffle of rows. Quartiles interpolate
    linearly and are exact (``order_statistics``). A column without values gives no row. The frame
    is read a few times; cut it before if it is dear to compute.
    """
    moments = _moments(df, columns).collect()  # a row a column
    sizes = {r["column"]: r["n"] for r in moments}
    wanted = {c: {rank for p in QUARTILES.values() for rank in _ranks(n, p)[:2]} for c, n in sizes.items()}
    found = order_statistics(df, wanted)
    rows = []
    for r in moments:
        name, cells = r["column"], []
        for p in QUARTILES.values():
            low, high, share = _ranks(r["n"], p)
            lower, upper = found[name, low], found[name, high]
            cells.append(lower + (upper - lower) * share if share else lower)
        rows.append((name, r["n"], r["mean"], r["std"], r["min"], *cells, r["max"]))
    kinds = ", ".join(f"{q} double" for q in QUARTILES)
    return df.sparkSession.createDataFrame(rows, f"column string, n bigint, mean double, std double, min double, {kinds}, max double")


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    """The ranks around the quantile, from 0, and how far it lies between them."""
    at = (n - 1) * p
    low = int(at)
    return low, low + (at > low), at - low


#: Bits that are known after each round of ``order_statistics``; a round with few values left goes on to the last.
ROUNDS = (16, 32, 48, 64)
_FEW = 1 << 20


def order_statistics(df: DataFrame, ranks: Mapping[str, set[int]]) -> dict[tuple[str, int], float]:
    """The values at the given ranks (from 0) of numeric columns, exactly.

    Radix selection: doubles are mapped to 64-bit integers of the same order. A round counts, for all
    columns in one pass, the values that share the bits known of a wanted one by their next 16
    bits, tasks first. A running sum over these at most 65,536 counts tells which holds the rank. Nothing but
    counts is shuffled, and a column's values are never together; when a million values or fewer
    are left, the next round counts all their bits. NaN comes last, as in Spark, and nulls don't count.
    """
    targets = {(c, rank): (0, rank) for c, wanted in ranks.items() for rank in wanted}
    names = [c for c, wanted in ranks.items() if wanted]
    if not names:
        return {}
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    known, left = 0, None
    for bits in ROUNDS:
        if bits <= known:
            continue
        bits = ROUNDS[-1] if left is not None and left <= _FEW else bits
        open_ = [sorted({targets[c, r][0] for r in ranks[c]}) for c in names]
        counted = values.mapInArrow(_digit_counter(open_, known, bits), "place int, digit bigint, n bigint")
        sums = counted.groupBy("place", "digit").agg(F.sum("n").alias("n")).withColumn(
            "prefix", F.shiftright("digit", bits - known) if known else F.lit(0).cast("bigint")
        )
        upto = Window.partitionBy("place", "prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("upto", F.sum("n").over(upto))
        spark = df.sparkSession
        asked = [(names.index(c), prefix, rank, rest) for (c, rank), (prefix, rest) in targets.items()]
        asked = spark.createDataFrame(asked, "place int, prefix bigint, rank bigint, rest bigint")
        holds = (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest"))
        rows = sums.join(F.broadcast(asked), ["place", "prefix"]).where(holds).collect()  # a row a rank
        targets = {(names[r["place"]], r["rank"]): (r["digit"], r["rest"] - (r["upto"] - r["n"])) for r in rows}
        left = sum({(r["place"], r["digit"]): r["n"] for r in rows}.values())
        known = bits
    keys = list(targets)
    found = _as_doubles(np.array([targets[k][0] for k in keys], np.int64))
    return dict(zip(keys, found.tolist(), strict=True))


def _as_integers(values: np.ndarray) -> np.ndarray:
    """64-bit integers in the order of the doubles; both zeros are one, and so are all NaN."""
    plain = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)
    return plain ^ ((plain >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def _as_doubles(integers: np.ndarray) -> np.ndarray:
    return (integers ^ ((integers >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)


def _digit_counter(open_: list[list[int]], known: int, bits: int) -> Callable:
    """Counts of the leading ``bits`` of each column's values whose first ``known`` bits are among the open ones."""

    def out(place: int, held: list[np.ndarray]) -> pa.RecordBatch:
        digits, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(digits), place, np.int32)), pa.array(digits), pa.array(n)], names=["place", "digit", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in open_]
        for batch in batches:
            for place, prefixes in enumerate(open_):
                column = batch.column(place)
                whole = _as_integers(column.drop_null().to_numpy(zero_copy_only=False))
                if known:
                    whole = whole[np.isin(whole >> np.int64(64 - known), prefixes)]
                if len(whole):
                    held[place].append(whole >> np.int64(64 - bits))
                if sum(map(len, held[place])) >= _FEW:
                    yield out(place, held[place])
                    held[place] = []
        for place, rest in enumerate(held):
            if rest:
                yield out(place, rest)

    return run


def describe_roughly(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """As ``describe`` in one pass, with quartiles from a sketch: values of the column, not interpolated."""
    sketched = {q: lambda c, p=p: F.percentile_approx(c, p, accuracy) for q, p in QUARTILES.items()}
    return _described(_moments(df, columns, sketched))


def _described(table: DataFrame) -> DataFrame:
    return table.select("column", "n", "mean", "std", "min", *QUARTILES, "max")


def _moments(
    df: DataFrame, columns: Sequence[str], more: Mapping[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    rows = []
    for name in columns:
        value = F.col(name).cast("double")
        rows.append(F.struct(
            F.lit(name).alias("column"), F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"), F.max(value).alias("max"), *[make(value).alias(q) for q, make in (more or {}).items()],
        ))
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows")).where("n > 0")
