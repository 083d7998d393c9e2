"""Link extraction from page markup by pattern.

Comments, scripts and styles are removed first. This is pattern matching, not an HTML parser.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioframe.functions.text import as_column

INVISIBLE = r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
# An opening tag, whose quoted values may hold any sign, and what follows up to its end or the next anchor.
OPENING = r"""<a(?:\s(?:[^>"']|"[^"]*"|'[^']*')*)?>"""
ANCHOR = rf"(?is){OPENING}(?:(?!<a[\s>]).)*?(?:</a\s*>|(?=<a[\s>])|\z)"
OPENING_TAG = rf"(?is)^{OPENING}"
ANY_TAG = r"(?s)<[^>]*>"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"


def visible_markup(html: Column | str) -> Column:
    return F.regexp_replace(as_column(html), INVISIBLE, "")


def anchors(html: Column | str) -> Column:
    """Anchor elements in page order."""
    return F.regexp_extract_all(visible_markup(html), F.lit(ANCHOR), F.lit(0))


def attribute(anchor: Column | str, name: str) -> Column:
    """Attribute of an anchor's opening tag, double-quoted, single-quoted or bare; empty when absent."""
    tag = F.regexp_extract(as_column(anchor), OPENING_TAG, 0)
    # other attributes are passed over whole, so a name inside a value isn't taken for one
    before = r"""(?is)^<a(?:\s+(?!{name}\s*=)[^\s=>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*"""
    value = r"""\s+{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    pattern = (before + value).replace("{name}", name)
    return F.concat(*[F.regexp_extract(tag, pattern, group) for group in (1, 2, 3)])


def anchor_text(anchor: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(as_column(anchor), OPENING_TAG, ""), ANY_TAG, "")


def page_title(html: Column | str) -> Column:
    return F.regexp_extract(as_column(html), TITLE, 1)
