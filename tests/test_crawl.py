import random

import pytest
from pyspark.sql import functions as F

from docflow import schemas
from docflow.operators import crawl, outcome
from docflow.plans.collection import run_discovery

ROOT = "https://docs.example.org/lib/specs"
SITE = "https://docs.example.org"


def pages(spark, rows):
    full = [(i, *row, *[None] * (4 - len(row))) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, schemas.PAGES)


def anchors(*hrefs):
    return "<html><body>" + "".join(f'<a href="{h}">x</a>' for h in hrefs) + "</body></html>"


def urls_of(df):
    return {r["url"] for r in df.collect()}


def test_links_relative_to_a_root_without_slash_leave_the_scope(spark):
    site = pages(spark, [
        (ROOT, anchors("survey-map.pdf", "annex.html", "harbour.pdf")),
        (f"{SITE}/lib/annex.html", anchors("annex-figures.pdf", "https://elsewhere.example/tide.pdf")),
    ])
    found = crawl.discover(site, ROOT)
    assert urls_of(found.documents) == {f"{SITE}/lib/survey-map.pdf", f"{SITE}/lib/harbour.pdf"}
    assert urls_of(found.visited) == {ROOT}


def test_failed_root(spark):
    site = pages(spark, [(ROOT, anchors("a.pdf"), 404)])
    documents, events = run_discovery(site, ROOT)
    assert documents.count() == 0
    rows = {r["event_type"]: r for r in events.collect()}
    assert set(rows) == {"crawl_error", "crawl_complete"}
    assert rows["crawl_complete"]["pdf_count"] == 0
    assert rows["crawl_error"]["url"] == ROOT


def test_walk_rules(spark):
    site = pages(spark, [
        (ROOT, anchors(
            "/lib/specs/a", "/lib/specs-old/", "#top", "?p=2", "mailto:x.pdf", "//cdn.example/y.PDF",
            "/lib/specs/x.pdf?v=1", "/elsewhere", "http://[bad/z.pdf")),
        (f"{ROOT}/a", anchors("../../up.pdf", "/lib/specs/a", "/lib/specs")),
        (f"{SITE}/lib/specs-old/", anchors("old.pdf")),
        (f"{ROOT}/x.pdf?v=1", anchors("/q.pdf")),
        (f"{SITE}/elsewhere", anchors("/never.pdf")),
        (f"{ROOT}#top", None, None, "timed out"),
    ])
    found = crawl.discover(site, ROOT)
    assert urls_of(found.visited) == {
        ROOT, f"{ROOT}/a", f"{SITE}/lib/specs-old/", f"{ROOT}#top", f"{ROOT}?p=2", f"{ROOT}/x.pdf?v=1"}
    assert {r["url"]: r["filename"] for r in found.documents.collect()} == {
        "mailto:x.pdf": "x.pdf",
        "https://cdn.example/y.PDF": "y.PDF",
        f"{SITE}/up.pdf": "up.pdf",
        f"{SITE}/lib/specs-old/old.pdf": "old.pdf",
        f"{SITE}/q.pdf": "q.pdf",
    }
    assert found.links.filter("target_url is null").count() == 1
    errors = {r["url"]: r["error"] for r in crawl.crawl_outcomes(found.visited, site).collect()}
    assert errors[ROOT] is None
    assert errors[f"{ROOT}#top"] == "timed out"
    assert errors[f"{ROOT}?p=2"] == "not observed"
    strict = crawl.discover(site, ROOT, strict=True, strip_fragment=True)
    assert urls_of(strict.visited) == {ROOT, f"{ROOT}/a", f"{ROOT}?p=2", f"{ROOT}/x.pdf?v=1"}


@pytest.mark.parametrize("seed,hot_rows", [(1, 1_000_000), (2, 3), (3, 1)])
def test_reachability_on_random_cyclic_graphs(spark, seed, hot_rows):
    rng = random.Random(seed)
    n = 60
    edges = [(f"u{rng.randrange(n)}", f"u{rng.randrange(n)}") for _ in range(80)]
    edges += [("u1", f"u{i}") for i in range(0, n, 3)]  # a hub with a third of all pages
    depth, frontier = {"u0": 0}, ["u0"]
    while frontier:
        nxt = {b for a, b in edges if a in frontier and b not in depth}
        depth |= {b: depth[frontier[0]] + 1 for b in nxt}
        frontier = sorted(nxt)
    links = spark.createDataFrame(edges, "page_url string, target_url string")
    got = crawl.reachable(links, "u0", hot_rows=hot_rows, slices=4)
    assert {r["url"]: r["depth"] for r in got.collect()} == depth
    near = crawl.reachable(links, "u0", max_depth=1)
    assert {r["url"] for r in near.collect()} == {u for u, d in depth.items() if d <= 1}


def test_page_profile(spark):
    site = pages(spark, [
        ("https://h/", "<html><title>Harbour Notes</title><body>Low water at noon.</body></html>"),
        ("https://g/", None, None, "socket reset by peer"),
        ("https://f/", "é" * 600),
    ])
    rows = {r["url"]: r for r in crawl.page_profile(site).collect()}
    assert rows["https://h/"].asDict() == {
        "status": "success", "url": "https://h/", "status_code": 200, "content_length": 72,
        "title": "Harbour Notes", "sample_text": "Harbour NotesLow water at noon.", "error": None}
    failed = rows["https://g/"]
    assert (failed.status, failed.title, failed.sample_text, failed.error) == (
        "failure", "", "", "socket reset by peer")
    assert (failed.status_code, failed.content_length) == (None, None)
    long = rows["https://f/"]
    assert (long.title, len(long.sample_text), long.content_length) == ("No title found", 500, 1200)


def test_fetch_schedule_ranks_within_hosts(spark):
    rng = random.Random(5)
    found = [f"https://hot.example/{rng.randrange(10**6)}" for _ in range(900)]
    found += [f"https://h{i % 40}.example/{i}" for i in range(300)]
    docs = spark.createDataFrame([(u,) for u in found + found[:50]], "url string")
    rows = crawl.fetch_schedule(docs, 0.5).collect()
    expected = {}
    by_host = {}
    for u in sorted(set(found)):
        host = u.split("/")[2]
        by_host[host] = by_host.get(host, 0) + 1
        expected[u] = (by_host[host], (by_host[host] - 1) * 0.5)
    assert {r["url"]: (r["position"], r["start_seconds"]) for r in rows} == expected


def test_events_of_a_full_mode_crawl(spark):
    site = pages(spark, [(ROOT, anchors("a.pdf", "/lib/specs/x"))])
    found = crawl.discover(site, ROOT)
    events = outcome.events_from_crawl(
        crawl.crawl_outcomes(found.visited, site), found.documents, "r", F.current_timestamp(), "full")
    assert sorted((r["event_type"], r["retry_count"], r["pdf_count"]) for r in events.collect()) == [
        ("crawl_complete", None, 1), ("crawl_error", 0, None)]
