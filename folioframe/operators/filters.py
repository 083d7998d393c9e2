"""Row predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions.text import as_column, source_article


def exclude_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Drop rows on a skip list; rows without a value stay."""
    listed = F.col(column).isin(*values) if values else F.lit(False)
    return df.filter(~F.coalesce(listed, F.lit(False)))


def has_suffix(column: Column | str, suffix: str = ".pdf") -> Column:
    """Case-sensitive suffix test."""
    return F.endswith(as_column(column), F.lit(suffix))


def eligibility(
    df: DataFrame, title: str = "title", content: str = "content",
    original: str = "original_abstract", generated: str = "generated_abstract",
) -> DataFrame:
    """Add ``reject_reason``: why a pair cannot be scored, NULL when it can."""
    return df.withColumn(
        "reject_reason",
        F.when(source_article(title, content) == "", F.lit("no source article"))
        .when(F.col(original).isNull(), F.lit("no original abstract"))
        .when(F.col(generated).isNull(), F.lit("no generated abstract")),
    )


def scorable(df: DataFrame, **columns: str) -> DataFrame:
    """Pairs that can be scored."""
    return eligibility(df, **columns).filter(F.col("reject_reason").isNull()).drop("reject_reason")


def succeeded(column: Column | str) -> Column:
    """True for a non-empty generation; its negation selects the work that stays pending."""
    return F.coalesce(as_column(column), F.lit("")) != ""


def fetched(status: Column | str) -> Column:
    """True for a successful fetch."""
    return F.coalesce(as_column(status) == 200, F.lit(False))


def links(
    edges: DataFrame, href_contains: str | None = None, class_equals: str | None = None
) -> DataFrame:
    """Link rows by href substring and exact class value."""
    if href_contains is not None:
        edges = edges.filter(F.contains(F.col("href"), F.lit(href_contains)))
    if class_equals is not None:
        edges = edges.filter(F.col("class") == class_equals)
    return edges
