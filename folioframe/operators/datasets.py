"""Training-set steps: reproducible splits and length budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioframe.functions.text import whitespace_tokens

# Fixed value: the seed of the training scripts' split.
SEED = 3407
BUCKETS = 1_000_000
PREFIX = 4


def split_digest(key: str, seed: int = SEED) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def hash_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = SEED) -> DataFrame:
    """Add ``split`` (``train`` or ``validation``) from a digest of the key alone: the same for
    every partitioning, no shuffle, sizes close to the wanted share."""
    number = F.conv(F.substring(split_digest(key, seed), 1, 8), 16, 10).cast("bigint")
    test = number % BUCKETS < int(round(test_size * BUCKETS))
    return df.withColumn("split", F.when(test, "validation").otherwise("train"))


def exact_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = SEED) -> DataFrame:
    """Like ``hash_split`` with exactly ``ceil(test_size * n)`` validation rows.

    One plan: rows are counted by digest prefix, prefix sums over the at most 65,536 prefixes tell
    which lie wholly on one side, and only rows of the one prefix on the boundary are ranked by
    digest and key. Keys are unique and not null.
    """
    keyed = df.withColumn("_digest", split_digest(key, seed)).withColumn("_prefix", F.substring("_digest", 1, PREFIX))
    counts = keyed.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_rows"))
    upto = F.sum("_rows").over(W.orderBy("_prefix").rowsBetween(W.unboundedPreceding, 0))
    total = F.sum("_rows").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    # the share is rounded first, so that 0.2 * 5 is 1 and not a little more
    wanted = F.ceil(F.round(total * F.lit(float(test_size)), 9))
    sums = counts.select("_prefix", (upto - F.col("_rows")).alias("_before"), upto.alias("_upto"), wanted.alias("_wanted"))
    placed = keyed.join(sums, "_prefix")
    boundary = (F.col("_before") < F.col("_wanted")) & (F.col("_wanted") < F.col("_upto"))
    rank = F.col("_before") + F.row_number().over(W.partitionBy("_prefix").orderBy("_digest", key))
    sides = placed.where(~boundary).withColumn("_test", F.col("_upto") <= F.col("_wanted")).unionByName(
        placed.where(boundary).withColumn("_test", rank <= F.col("_wanted"))
    )
    return sides.withColumn("split", F.when(F.col("_test"), "validation").otherwise("train")).select(*df.columns, "split")


def fit_budget(df: DataFrame, text: str, max_tokens: int) -> DataFrame:
    """Add ``n_tokens``, ``over_budget`` and ``budget_text``.

    A text inside the budget stays as it is; a longer one ends with its token ``max_tokens``, all
    white space before it kept.
    """
    blank = "[ \\t\\r\\n]+"
    gaps = F.regexp_extract_all(text, F.lit(blank), F.lit(0))
    # the white space before each token; none before a first token that opens the text
    leading = F.when(F.regexp_like(text, F.lit("^" + blank)), gaps).otherwise(F.concat(F.array(F.lit("")), gaps))
    parts = F.zip_with(
        F.slice(leading, 1, max_tokens), F.slice(whitespace_tokens(text), 1, max_tokens), lambda gap, token: F.concat(gap, token)
    )
    return (
        df.withColumn("n_tokens", F.size(whitespace_tokens(text)))
        .withColumn("over_budget", F.col("n_tokens") > max_tokens)
        .withColumn("budget_text", F.when(F.col("over_budget"), F.array_join(parts, "")).otherwise(F.col(text)))
    )


def budget_report(df: DataFrame, text: str, max_tokens: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """Rows, tokens and rows over each budget, per group."""
    sized = df.select(*by, F.size(whitespace_tokens(text)).alias("_n"))
    return sized.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("_n").alias("n_tokens"),
        F.max("_n").alias("max_tokens"),
        *[F.count_if(F.col("_n") > b).alias(f"over_{b}") for b in max_tokens],
    )
