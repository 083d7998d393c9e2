"""Link table of fetched pages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.functions.markup import anchor_text, anchors, attribute
from folioframe.operators.filters import links

# What marks each kind of link on a listing page.
VENUE_HREF = "/venues/"
VOLUME_HREF = "/volumes/"
PAPER_CLASS, PAPER_HREF = "align-middle", "/"
PDF_CLASS, PDF_HREF = "btn btn-primary", ".pdf"


def page_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``(key, pos, href, class, text)``: one row per anchor, in page order."""
    found = pages.select(key, F.posexplode(anchors(html)).alias("pos", "anchor"))
    return found.select(
        key,
        F.col("pos").cast("bigint").alias("pos"),
        attribute("anchor", "href").alias("href"),
        attribute("anchor", "class").alias("class"),
        anchor_text("anchor").alias("text"),
    )


def venue_links(edges: DataFrame) -> DataFrame:
    return links(edges, href_contains=VENUE_HREF)


def volume_links(edges: DataFrame) -> DataFrame:
    return links(edges, href_contains=VOLUME_HREF)


def paper_links(edges: DataFrame) -> DataFrame:
    return links(edges, PAPER_HREF, PAPER_CLASS)


def pdf_links(edges: DataFrame) -> DataFrame:
    return links(edges, PDF_HREF, PDF_CLASS)


def link_kinds(others: Mapping[str, Column] | None = None) -> Column:
    """The kinds that a row of ``page_links`` is of, as an array: one pass over the links."""
    has = lambda text: F.contains("href", F.lit(text))
    tests = {
        "venue": has(VENUE_HREF), "volume": has(VOLUME_HREF), "paper": has(PAPER_HREF) & (F.col("class") == PAPER_CLASS),
        "pdf": has(PDF_HREF) & (F.col("class") == PDF_CLASS), **(others or {}),
    }
    return F.array_compact(F.array(*[F.when(test, kind) for kind, test in tests.items()]))
