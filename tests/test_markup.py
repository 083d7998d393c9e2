from folioframe.operators import links
from folioframe.operators.filters import exclude_values, fetched, has_suffix
from pyspark.sql import functions as F

HTML = """<html><script>var x = '<a href="/hidden">no</a>';</script><!-- <a href="/comment">no</a> -->
<a class="align-middle" href="/2023.x.1">First <b>Paper</b></a>
<a href='/volumes/v1/' class='plain'>Volume</a> <a HREF="/venues/acl/">ACL</a> <abbr href="/not">x</abbr>
<a class="btn btn-primary" href="https://h/2023.x.1.pdf">PDF</a><a name="anchor">none</a></html>"""


def test_page_links(spark):
    pages = spark.createDataFrame([(1, HTML), (2, "no links")], "page_id long, html string")
    edges = links.page_links(pages)
    rows = {r["pos"]: (r["href"], r["class"], r["text"]) for r in edges.collect()}
    assert rows == {
        0: ("/2023.x.1", "align-middle", "First Paper"),
        1: ("/volumes/v1/", "plain", "Volume"),
        2: ("/venues/acl/", "", "ACL"),
        3: ("https://h/2023.x.1.pdf", "btn btn-primary", "PDF"),
        4: ("", "", "none"),
    }
    found = {k: [r["pos"] for r in f(edges).collect()] for k, f in {
        "venue": links.venue_links, "volume": links.volume_links, "paper": links.paper_links, "pdf": links.pdf_links,
    }.items()}
    assert found == {"venue": [2], "volume": [1], "paper": [0], "pdf": [3]}


def test_attribute_forms(spark):
    html = """<a href="/x/it's.pdf">A</a><a class=align-middle href=/b>B</a><a title="href='/no'" href='/say"hi"'>C</a>
<a data-href="/no" href = "/d>e">D<a href="/open">unclosed"""
    rows = {r["pos"]: (r["href"], r["class"], r["text"]) for r in links.page_links(
        spark.createDataFrame([(1, html)], "page_id long, html string")).collect()}
    assert rows == {
        0: ("/x/it's.pdf", "", "A"), 1: ("/b", "align-middle", "B"), 2: ('/say"hi"', "", "C"), 3: ("/d>e", "", "D"),
        4: ("/open", "", "unclosed"),
    }


def test_predicates(spark):
    df = spark.createDataFrame([("a.pdf", 200), ("b.PDF", 404), (None, None)], "name string, status int")
    assert [r["name"] for r in exclude_values(df, "name", ["a.pdf"]).collect()] == ["b.PDF", None]
    assert exclude_values(df, "name", []).count() == 3
    assert df.filter(has_suffix("name")).count() == 1
    assert [r["v"] for r in df.select(fetched("status").alias("v")).collect()] == [True, False, False]
