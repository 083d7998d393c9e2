"""Pairing of two lists, and incremental work lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def strict_zip(left: DataFrame, right: DataFrame, on: str = "pos") -> DataFrame:
    """Pair i-th with i-th; the query fails when either side has no partner.

    Both sides carry dense positions, so a missing partner means unequal lengths. The check
    is part of the one join, no separate counting jobs.
    """
    a = left.withColumn("_in_left", F.lit(True))
    b = right.withColumn("_in_right", F.lit(True))
    both = F.col("_in_left") & F.col("_in_right")
    message = F.format_string(f"lists differ in length: no partner at {on} %s", F.col(on).cast("string"))
    checked = F.when(both, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return a.join(b, on, "full").filter(checked).drop("_in_left", "_in_right")


def truncating_zip(left: DataFrame, right: DataFrame, on: str = "pos") -> DataFrame:
    """Pair i-th with i-th up to the shorter list's length."""
    return left.join(right, on)


def last_wins(df: DataFrame, key: str, order: str | Sequence[str] = "pos") -> DataFrame:
    """The row that comes last among those with the same key, by the order columns."""
    return _survivors(df, key, order, F.max)


def first_wins(df: DataFrame, key: str, order: str | Sequence[str] = "pos") -> DataFrame:
    """The row that comes first among those with the same key (null counts as one key)."""
    return _survivors(df, key, order, F.min)


def _survivors(df: DataFrame, key: str, order: str | Sequence[str], pick) -> DataFrame:
    """One row a key; rows that tie in all order columns are told apart by their other columns.

    Order columns need not be unique in the table, as where every file numbers its own rows. Only
    digests and orders are aggregated, combined before the shuffle, so a key with a third of
    all rows costs one row a task. The wide rows meet the survivors on digest, order and
    content together, which has no hot value unless whole rows repeat.
    """
    orders = [order] if isinstance(order, str) else list(order)
    digest = F.coalesce(F.sha2(F.col(key).cast("string"), 256), F.lit("null"))
    place = F.struct(*orders, F.xxhash64(*df.columns).alias("_content"))
    marked = df.withColumn("_digest", digest).withColumn("_place", place)
    winners = marked.groupBy("_digest").agg(pick("_place").alias("_place"))
    kept = marked.join(
        winners.select(F.col("_digest").alias("_won"), F.col("_place").alias("_at")),
        (F.col("_digest") == F.col("_won")) & F.col("_place").eqNullSafe(F.col("_at")), "left_semi",
    )
    # only repeats of one row share a digest now
    return kept.dropDuplicates(["_digest"]).drop("_digest", "_place")


def title_join(
    left: DataFrame, right: DataFrame, title: str = "title", pos: str | Sequence[str] = "pos"
) -> DataFrame:
    """Left rows with the last right row of the same title, by one or several order columns.

    Left duplicates stay, left rows without a partner go. The right side is unique per
    title, so a hot title on the left is split by AQE's skew join.
    """
    orders = [pos] if isinstance(pos, str) else list(pos)
    return left.join(last_wins(right, title, orders).drop(*orders), title)


def pending(df: DataFrame, done: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in the processed set; blank keys there do not count."""
    keys = [key] if isinstance(key, str) else list(key)
    usable = F.lit(True)
    for name in keys:
        usable = usable & F.col(name).isNotNull() & (F.col(name).cast("string") != "")
    return df.join(done.select(*keys).filter(usable), keys, "left_anti")


def work_list(
    articles: DataFrame, models: Sequence[str], done: DataFrame | None = None, pos: str = "pos"
) -> DataFrame:
    """One row per (article, model) still to do.

    The models done are gathered per article (at most as many as are asked for), so an article
    is shuffled once and not once per model. The product comes from a literal array, not a join.
    """
    asked = F.array(*[F.lit(m) for m in models])
    if done is None:
        return articles.withColumn("model", F.explode(asked))
    known = done.filter(F.col("model").isin(*models)).groupBy(pos).agg(F.collect_set("model").alias("_done"))
    left = F.array_except(asked, F.coalesce("_done", F.array().cast("array<string>")))
    return articles.join(known, pos, "left").withColumn("model", F.explode(left)).drop("_done")


def first_usable_attempt(
    attempts: DataFrame, keys: Sequence[str], value: str, attempt: str = "attempt", limit: int = 3
) -> DataFrame:
    """Per key the first non-null value within the allowed attempts."""
    usable = attempts.filter((F.col(attempt) <= limit) & F.col(value).isNotNull())
    return usable.groupBy(*keys).agg(F.min_by(value, attempt).alias(value))


def drop_blank_distinct(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-empty keys of a processed list."""
    return df.select(key).filter(F.coalesce(F.col(key), F.lit("")) != "").distinct()
