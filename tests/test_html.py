from html import unescape
from html.parser import HTMLParser

from pyspark.sql import functions as F

from docflow.functions import html as H


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            values = [v or "" for k, v in attrs if k == "href"]
            self.found += values[-1:]


PAGES = [
    '<a href="/a">x</a> <A HREF=\'/b\'>y</A> <a href=/c>z</a>',
    '<a class="k" data-x="a > b" href="/d?x=1&amp;y=2">t</a>',
    "<!-- <a href='/no'> --><a href='/e'>",
    '<script>var s = "<a href=\'/no\'>"; </script><a href="/f">',
    '<script>"<!--"</script><a href="/g"><!-- <script> --><a href="/h">',
    '<style>a{}</style><a title="x href=/no" href="/i">',
    '<abbr href="/no"><area href="/no"><link href="/no"><a name="n"><a href>',
    '<a href="/j" href="/k"><a\n\thref = "/l"\n>',
    '<div data-x="<a href=\'/no\'>"><a href="/m&#233;&#xe9;&eacute;">',
    '<a href=""><a href="x&unknown;y"><p>no link</p>',
    "plain text",
    '<a href="/the,"><a href="/für">',
]


def test_links_equal_a_parser(spark):
    df = spark.createDataFrame(list(enumerate(PAGES)), "i int, html string")
    got = {r[0]: r[1] for r in df.select("i", H.hrefs(F.col("html"))).collect()}
    for i, page in enumerate(PAGES):
        parser = _Anchors()
        parser.feed(page)
        assert got[i] == parser.found, page


def test_long_tags_and_pages(spark):
    page = "<a " + " ".join(f'd{i}="v{i}"' for i in range(5000)) + ' href="/z">' + "<p x='1'>" * 20000
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(H.hrefs(F.col("html"))).first()[0] == ["/z"]


def test_entities(spark):
    cases = ["a &amp; b", "&lt;&gt;&quot;&apos;", "&#65;&#x42;&#X43;", "&eacute;&Omega;&nbsp;",
             "&#128512;", "&#0;", "&#x110000;", "&#99999999999999999999;", "&#150;", "&amp;amp;",
             "&", "&;", "a&&b", "&#;", "&#xD800;", "plain", "&amp;lt; &lt;b&gt;"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r[0] for r in df.select(H.decode_entities(F.col("t"))).collect()]
    assert got == [unescape(c) for c in cases]


def test_title_and_text(spark):
    rows = [
        ("<html><head><title>Quarterly Survey</title></head><body>Tide tables inside.</body></html>",
         "Quarterly Survey", "Quarterly SurveyTide tables inside."),
        ("<body><script>no</script>a<b>b</b><!-- c -->d &amp; e</body>", "No title found", "abd & e"),
        ("<!DOCTYPE html><title></title>x<style>p{}</style>", "None", "x"),
        ("<script>'<title>no</title>'</script><TITLE lang='x'>A &lt; B</TITLE>", "A < B", "A < B"),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "html string")
    got = H.with_title_and_text(df).collect()
    assert [(r.title, r.text) for r in got] == [r[1:] for r in rows]


def test_names_of_html5(spark):
    df = spark.createDataFrame([("a&period;pdf &NotEqualTilde; &nosuchname; &amp;",)], "t string")
    got = df.select(H.decode_entities(F.col("t"))).first()[0]
    assert got == "a.pdf ≂̸ &nosuchname; &"
