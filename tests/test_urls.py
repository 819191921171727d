from urllib.parse import urljoin, urlparse

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from docflow.functions import urls

ROOT = "https://docs.example.org/lib/specs"

HREFS = [
    "document1.pdf", "subpage.html", "categories/structural/", "../SPEC-1.pdf", "#top", "?p=2",
    "mailto:x.pdf", "//cdn.x/y.pdf", "/lib/specs-old/", "", ".", "..", "./", "../", "a/./b/../c",
    "../../../../x", "/a/../../x", "/a//b", "a//b", "a//", "?", "#", "/x?", "/x#", "/x?#", "/x?#f",
    "/x?a#", "g;x=1/../y", ";x", "g;x", "g;x?y#s", "/.", "/..", "/a/.", "/a/..", "...", "..g", "g.",
    "https:g", "HTTPS://Other.example/A/../b?x#y", "http://h/p", "http:rel", "javascript:void(0)",
    "tel:+1;ext=2", "//", "///p", "////p", "//h", "//h?q", "//h#f", "  /lead", "/in\nner\t.pdf",
    "a b.pdf", "é.pdf", "x.pdf?v=1", "x.pdf#p2", "1:2", "a:b", "foo.bar:baz", "/p?u=http://z/../q",
    "#a#b", "?a?b", "/..;p", "x/..;p", "//user@h:80/p", "//[::1]:8080/p", "?/../x", "b/?c=/./d",
]
BASES = [
    ROOT, "https://docs.example.org/lib/specs/", "https://docs.example.org",
    "http://docs.example.org/a/b/c.html?q=1#frag", "https://docs.example.org/a//b//c",
    "https://docs.example.org/a;p/b;q", "https://docs.example.org?x=1",
    "https://docs.example.org/lib/specs/categories/structural/",
]


def _resolve(spark, pairs):
    df = spark.createDataFrame(pairs, "base string, href string")
    return [r.target_url for r in urls.resolve_links(df, "base").collect()]


@pytest.mark.parametrize("base", BASES)
def test_resolution_equals_standard_library(spark, base):
    got = _resolve(spark, [(base, h) for h in HREFS])
    assert dict(zip(HREFS, got)) == {h: urljoin(base, h) for h in HREFS}


def test_malformed_host_gives_null(spark):
    bad = ["//[::1/p", "http://a]b/", "//[zz]/x"]
    assert _resolve(spark, [(ROOT, h) for h in bad]) == [None] * 3


segment = st.sampled_from(["", ".", "..", "a", "b.pdf", "c;p", "...", ".d", "x y"])
reference = st.builds(
    lambda head, segs, tail: head + "/".join(segs) + tail,
    st.sampled_from(["", "/", "//h", "//h/", "https:", "http://k"]),
    st.lists(segment, max_size=6),
    st.sampled_from(["", "?", "#", "?q", "#f", "?q#f", "?#", "?/../z"]),
)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(BASES), reference), min_size=150, max_size=150))
def test_resolution_on_random_references(spark, pairs):
    assert _resolve(spark, pairs) == [urljoin(b, h) for b, h in pairs]


def test_file_names(spark):
    cases = ["https://h/a/b.pdf", "https://h/?q=.pdf", "https://h/a/doc;v=1.pdf", "https://h",
             "https://h/a/", "mailto:x.pdf", "mailto:x;y.pdf", "https://h/a%20b.pdf",
             "https://h/a;b/c.pdf", "x.pdf", "https://h/a.pdf?x=/y.pdf#/z.pdf"]
    df = spark.createDataFrame([(c,) for c in cases], "url string")
    got = {r[0]: r[1] for r in df.select("url", urls.document_filename(F.col("url"))).collect()}
    for case in cases:
        name = urlparse(case).path.split("/")[-1]
        if name:
            assert got[case] == name
    assert got["https://h/?q=.pdf"] == "document_1b1afe04.pdf"
    assert got["https://h/a/doc;v=1.pdf"] == "doc"


def test_scope_document_and_root(spark):
    df = spark.createDataFrame(
        [(ROOT,), (ROOT + "/x",), (ROOT + "-old/",), (ROOT + "?p=2",), (ROOT + "/A.PDF",),
         (ROOT + "/a.pdf?v=1",)], "url string")
    u = F.col("url")
    rows = df.select(urls.in_scope(u, ROOT), urls.in_scope(u, ROOT, True), urls.is_document(u)).collect()
    assert [r[0] for r in rows] == [True] * 6
    assert [r[1] for r in rows] == [True, True, False, True, True, True]
    assert [r[2] for r in rows] == [False, False, False, False, True, False]
    roots = spark.createDataFrame([("https://h",), ("https://h///",)], "b string")
    assert {r[0] for r in roots.select(urls.root_url(F.col("b"), "lib/specs")).collect()} == {
        "https://h/lib/specs"}


def test_category(spark):
    df = spark.createDataFrame(
        [(ROOT + "/civil/a.pdf",), (ROOT + "/a.pdf",), ("https://o/x/y.pdf",)], "url string")
    assert [r[0] for r in df.select(urls.url_category(F.col("url"), ROOT)).collect()] == [
        "civil", None, None]
