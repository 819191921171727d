import hashlib
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docflow import schemas
from docflow.functions import content
from docflow.operators import change, outcome, reports
from docflow.plans.collection import run_collection, store_run
from docflow.sources import documents
from docflow.sources.events import read_events
from docflow.sources.manifests import ManifestStore, empty_manifest

ROOT = "https://docs.example.org/lib/specs"
D1, D2 = "https://docs.example.org/lib/SPEC-1.pdf", "https://docs.example.org/lib/SPEC-3.pdf"
JAN1, JAN2 = "Wed, 01 Jan 2025 00:00:00 GMT", "Thu, 02 Jan 2025 00:00:00 GMT"


def _tables(spark, bodies, heads=None, attempts=()):
    if heads is None:
        heads = [(u, str(len(b)), JAN1, None) for u, b in bodies]
    return (
        spark.createDataFrame(heads, schemas.HEADS),
        spark.createDataFrame(list(attempts), schemas.ATTEMPTS),
        spark.createDataFrame(bodies, schemas.BODIES),
    )


def _site(spark, *hrefs):
    html = "".join(f'<a href="{h}">x</a>' for h in hrefs)
    return spark.createDataFrame([(0, ROOT, html, 200, None)], schemas.PAGES)


def _run(spark, site, tables, manifest, **options):
    at = F.lit(options.pop("at", "2025-01-05 00:00:00")).cast("timestamp")
    return run_collection(
        site, ROOT, *tables, manifest, manifest.select("filename", F.col("size").alias("length")),
        "run", at, **options)


def _statuses(run):
    return {r["filename"]: r["status"] for r in run.results.collect()}


def test_three_incremental_runs(spark):
    site = _site(spark, "SPEC-1.pdf", "SPEC-3.pdf")
    b1, b2 = b"%PDF-1.4\none\n%%EOF", b"%PDF-1.4\ntwo\n%%EOF"
    first = _run(spark, site, _tables(spark, [(D1, b1), (D2, b2)]), empty_manifest(spark))
    assert _statuses(first) == {"SPEC-1.pdf": "success", "SPEC-3.pdf": "success"}
    summary = first.summary.first()
    assert (summary.pages_visited, summary.pdfs_found, summary.success_count, summary.skipped_count,
            summary.total_files_tracked, summary.incremental_mode) == (1, 2, 2, 0, 2, True)
    entry = {r["filename"]: r for r in first.manifest.collect()}["SPEC-1.pdf"]
    assert (entry.url, entry.size, entry.checksum, entry.last_modified, entry.local_path) == (
        D1, len(b1), hashlib.sha256(b1).hexdigest(), JAN1, "documents/SPEC-1.pdf")
    assert sorted(r["event_type"] for r in first.events.collect()) == [
        "crawl_complete", "crawl_success", "download_success", "download_success"]

    second = _run(spark, site, _tables(spark, [], [(D1, str(len(b1)), JAN1, None),
                                                   (D2, str(len(b2)), JAN1, None)]), first.manifest)
    assert _statuses(second) == {"SPEC-1.pdf": "skipped_unchanged", "SPEC-3.pdf": "skipped_unchanged"}
    assert second.summary.first().skipped_count == 2
    assert not [r for r in second.events.collect() if r["event_type"].startswith("download")]

    longer = b"%PDF-1.4\none UPDATED\n%%EOF"
    third = _run(
        spark, site,
        _tables(spark, [(D1, longer)], [(D1, str(len(longer)), JAN2, None), (D2, str(len(b2)), JAN1, None)]),
        second.manifest, at="2025-01-06 00:00:00")
    assert _statuses(third) == {"SPEC-1.pdf": "success", "SPEC-3.pdf": "skipped_unchanged"}
    status = reports.incremental_status(third.manifest, "here").first()
    assert (status.total_files, status.status, status.metadata_file) == (2, "ready_for_incremental", "here")
    assert status.latest_download == datetime(2025, 1, 6)
    updated = {r["filename"]: r for r in third.manifest.collect()}["SPEC-1.pdf"]
    assert (updated.size, updated.last_modified) == (len(longer), JAN2)


def test_stored_runs(spark, tmp_path):
    store = ManifestStore(spark, str(tmp_path / "manifest"))
    docs, log = str(tmp_path / "docs"), str(tmp_path / "events")
    site = _site(spark, "SPEC-1.pdf", "SPEC-3.pdf")
    b1, b2 = b"%PDF-1.4\none\n%%EOF", b"no document"
    tables = _tables(spark, [(D1, b1), (D2, b2)])
    for _ in range(2):  # the second time as after a failure: nothing is doubled
        store_run(_run(spark, site, tables, empty_manifest(spark)), tables[2], store, docs, log)
    assert [r["filename"] for r in store.read().collect()] == ["SPEC-1.pdf"]
    assert read_events(spark, log).count() == 4
    latest = documents.latest_documents(spark, docs)
    content_rows = documents.document_contents(spark, docs, latest).collect()
    assert [(r["filename"], bytes(r["content"])) for r in content_rows] == [("SPEC-1.pdf", b1)]


def test_status_without_downloads(spark):
    status = reports.incremental_status(empty_manifest(spark), "here").first()
    assert status.asDict() == {
        "total_files": 0, "total_size_mb": None, "latest_download": None, "metadata_file": None,
        "status": "no_previous_downloads"}


def test_statuses_of_single_documents(spark):
    names = ["ok", "big", "edge", "bad", "nohead", "badlen", "dead", "third", "nobody"]
    site = _site(spark, *[f"{n}.pdf" for n in names])
    u = {n: f"https://docs.example.org/lib/{n}.pdf" for n in names}
    pdf = b"%PDF-1.4\n%%EOF"
    when = datetime(2025, 1, 1)
    tables = _tables(
        spark,
        [(u[n], pdf) for n in names if n not in ("bad", "dead", "nobody")]
        + [(u["bad"], b"This is not a PDF")],
        [(u[n], "15", None, None) for n in ("ok", "bad", "dead", "third", "nobody")]
        + [(u["big"], str(content.SIZE_CAP + 1), None, None), (u["edge"], str(content.SIZE_CAP), None, None),
           (u["badlen"], "many", None, None)],
        [(u["dead"], i, False, f"boom {i}", when) for i in (1, 2, 3, 4)]
        + [(u["dead"], 5, True, None, when)]
        + [(u["third"], 1, False, "a", when), (u["third"], 2, False, "b", when),
           (u["third"], 3, True, None, when)],
    )
    run = _run(spark, site, tables, empty_manifest(spark))
    assert _statuses(run) == {
        "ok.pdf": "success", "big.pdf": "too_large", "edge.pdf": "success", "bad.pdf": "invalid_pdf",
        "nohead.pdf": "error", "badlen.pdf": "error", "dead.pdf": "error", "third.pdf": "success",
        "nobody.pdf": "error"}
    events = [(r["event_type"], r["file"], r["error"]) for r in run.events.collect()]
    assert sorted(e for e in events if e[0] == "download_retry") == [
        ("download_retry", "dead.pdf", f"boom {i}") for i in (1, 2, 3)
    ] + [("download_retry", "third.pdf", "a"), ("download_retry", "third.pdf", "b")]
    assert ("download_error", "dead.pdf", "boom 3") in events
    assert ("size_error", "big.pdf", "File too large") in events
    assert ("validation_error", "bad.pdf", "Invalid PDF format") in events
    assert {r["filename"] for r in run.manifest.collect()} == {"ok.pdf", "edge.pdf", "third.pdf"}
    forced = _run(spark, site, tables, empty_manifest(spark), validator=F.lit(True))
    assert _statuses(forced)["bad.pdf"] == "success"
    full = _run(spark, site, tables, run.manifest, mode="full")
    assert _statuses(full)["ok.pdf"] == "success"
    assert {r["event_type"] for r in full.events.collect()} == {
        "crawl_complete", "upload_ok", "upload_error", "size_error", "validation_error",
        "download_error"}


def test_restricted_run(spark):
    site = _site(spark, "SPEC-1.pdf", "SPEC-3.pdf")
    only = spark.createDataFrame([(D2,)], "url string")
    run = _run(spark, site, _tables(spark, [(D1, b"%PDF-\n%%EOF"), (D2, b"%PDF-\n%%EOF")]),
               empty_manifest(spark), only=only)
    assert _statuses(run) == {"SPEC-3.pdf": "success"}


def test_change_rules_in_order(spark):
    u = lambda n: f"https://h/{n}.pdf"
    cases = {  # name: (on disk, manifest (size, url, date) or None, length, date) -> reason
        "a": (False, (5, u("a"), JAN1), "5", JAN1, "missing_file"),
        "b": (True, None, "5", JAN1, "no_metadata"),
        "c": (True, (6, "x", JAN2), "5", JAN1, "size_changed"),
        "d": (True, (5, "x", JAN2), "5", JAN1, "url_changed"),
        "e": (True, (5, u("e"), JAN2), "5", JAN1, "last_modified_changed"),
        "f": (True, (5, u("f"), None), "5", JAN1, "last_modified_changed"),
        "g": (True, (5, u("g"), JAN2), "5", None, "unchanged"),
        "h": (True, (5, u("h"), JAN1), "5", JAN1, "unchanged"),
        "i": (True, (5, u("i"), JAN1), None, JAN1, "size_changed"),
        "j": (True, (None, u("j"), JAN1), "0", JAN1, "size_changed"),
        "k": (True, (5, u("k"), JAN2), "5", "", "unchanged"),
        "l": (False, None, "5x", JAN1, "head_error"),
        "m": (True, (5, u("m"), JAN1), "5.0", JAN1, "head_error"),
    }
    docs = spark.createDataFrame([(u(n),) for n in cases], "url string")
    manifest = spark.createDataFrame(
        [(f"{n}.pdf", m[1], m[0], None, m[2], None, None) for n, (_, m, *_r) in cases.items() if m],
        schemas.MANIFEST)
    stored = spark.createDataFrame([(f"{n}.pdf", 1) for n, c in cases.items() if c[0]], schemas.STORED)
    heads = change.head_observations(
        spark.createDataFrame([(u(n), c[2], c[3], None) for n, c in cases.items()], schemas.HEADS))
    for hot_rows in (1_000_000, 1):
        got = change.change_decision(change.candidates(docs), manifest, stored, heads, hot_rows)
        assert {r["filename"][0]: r["reason"] for r in got.collect()} == {
            n: c[4] for n, c in cases.items()}


def _sequential(docs, manifest, stored):
    """Document after document, each against the state the ones before it left."""
    manifest, stored, results, fetched = dict(manifest), set(stored), {}, set()
    for url, size, ok in sorted(docs):
        name = url.rsplit("/", 1)[1]
        entry = manifest.get(name)
        if name in stored and entry == (url, size):
            results[name] = "skipped_unchanged"
            continue
        fetched.add(url)
        results[name] = "success" if ok else "invalid_pdf"
        if ok:
            manifest[name] = (url, size)
            stored.add(name)
    return results, manifest, fetched


@pytest.mark.parametrize("seed", range(3))
def test_shared_file_names_equal_sequential_processing(spark, seed):
    rng = random.Random(seed)
    docs, manifest, stored = [], {}, set()
    for n in range(150):
        hosts = [h for h in "abcd" if rng.random() < 0.6] or ["a"]
        for h in hosts:
            docs.append((f"https://{h}.example/f{n}.pdf", rng.choice([10, 20]), rng.random() < 0.7))
        if rng.random() < 0.8:
            manifest[f"f{n}.pdf"] = (f"https://{rng.choice(hosts)}.example/f{n}.pdf", rng.choice([10, 20]))
        if rng.random() < 0.8:
            stored.add(f"f{n}.pdf")
    results, after, fetched = _sequential(docs, manifest, stored)

    urls = spark.createDataFrame([(d[0],) for d in docs], "url string")
    heads = spark.createDataFrame(
        [(d[0], d[1], None, None) for d in docs],
        "url string, content_length bigint, last_modified string, head_error string")
    entries = spark.createDataFrame(
        [(k, v[0], v[1], None, None, None, None) for k, v in manifest.items()], schemas.MANIFEST)
    files = spark.createDataFrame([(f, 1) for f in stored], schemas.STORED)
    inspected = spark.createDataFrame(
        [(d[0], d[1], "sum", d[2]) for d in docs],
        "url string, body_size bigint, checksum string, is_valid boolean")
    outcomes = outcome.outcome_status(
        change.change_decision(change.candidates(urls), entries, files, heads),
        spark.createDataFrame([], schemas.FOLDED_ATTEMPTS), inspected)
    assert {r["filename"]: r["status"] for r in outcome.file_results(outcomes).collect()} == results
    assert {r["url"] for r in outcomes.filter("decision = 'fetch'").collect()} == fetched
    updated = outcome.upsert_manifest(
        entries, outcome.manifest_rows(outcomes, F.current_timestamp(), "x"))
    assert {r["filename"]: (r["url"], r["size"]) for r in updated.collect()} == after


def test_attempts_with_gaps_and_a_hot_key(spark):
    rows = [("hot", i, i >= 5000, "e", None) for i in range(1, 5001)]
    rows += [("gap", 10, False, "x", None), ("gap", 30, True, None, None), ("gap", 40, False, "y", None)]
    got = {r["url"]: r for r in outcome.fold_attempts(
        spark.createDataFrame(rows, schemas.ATTEMPTS).repartition(8)).collect()}
    assert (got["hot"].ok, got["hot"].attempts, got["hot"].failures) == (False, 3, 3)
    assert (got["gap"].ok, got["gap"].attempts, got["gap"].failures, got["gap"].last_error) == (
        True, 2, 1, None)


def test_upsert_and_diff_are_stable(spark):
    rows = [(f"f{i}", f"u{i}", i, "c", None, None, None) for i in range(20)]
    manifest = spark.createDataFrame(rows, schemas.MANIFEST)
    again = outcome.upsert_manifest(manifest, manifest.filter("size > 5"))
    assert sorted(again.collect()) == sorted(manifest.collect())
    diff = change.snapshot_diff(manifest, manifest, ["filename"], ["url", "size"])
    assert {r["change"] for r in diff.collect()} == {"unchanged"}


def test_pdf_check(spark):
    cases = {
        b"%PDF-1.4\ntest content\n%%EOF": True, b"not a pdf": False, b"%PDF-1.4\n": False,
        b"%PDF-1.4\n%%EOF" + b"x" * 1019: True, b"%PDF-1.4\n%%EOF" + b"x" * 5000: True, b"\n\n%PDF-1.4\n%%EOF": True, b" " * 1024 + b"%PDF-1.4\n%%EOF": False, b"": False,
        b"%PDF-" + b"\xff\xfe" * 5000 + b"%%EOF\r\n": True,
    }
    df = spark.createDataFrame([(k,) for k in cases], "content binary")
    got = {bytes(r[0]): r[1] for r in df.select("content", content.pdf_check(F.col("content"))).collect()}
    assert got == cases


def test_small_expressions(spark):
    df = spark.createDataFrame([(1,), (3,), (4,), (9,)], "n int")
    waits = df.select(content.wait_seconds(F.col("n")), content.wait_seconds(F.col("n"), *content.PROBE_WAIT))
    assert [tuple(r) for r in waits.collect()] == [(4.0, 2.0), (4.0, 4.0), (8.0, 8.0), (10.0, 8.0)]
    sizes = spark.createDataFrame(
        [(1023,), (1024,), (102400,), (1024000,), (10240000,), (51200000,)], "s bigint")
    assert [r[0] for r in sizes.select(content.size_band(F.col("s"))).collect()] == [
        None, "small", "medium", "large", "very_large", None]
    ages = spark.createDataFrame([(0,), (29,), (30,), (89,), (90,)], "d int").select(
        content.storage_tier(F.date_sub(F.lit("2025-05-01").cast("date"), F.col("d")),
                             F.lit("2025-05-01").cast("date")))
    assert [r[0] for r in ages.collect()] == [
        "standard", "standard", "infrequent", "infrequent", "archive"]
    ts = spark.range(1).select(content.epoch_timestamp(F.lit(1735689600.123456))).first()[0]
    assert ts == datetime(2025, 1, 1, 0, 0, 0, 123456)


def test_a_committed_run_stored_again_keeps_its_bodies(spark, tmp_path):
    store = ManifestStore(spark, str(tmp_path / "manifest"))
    docs, log = str(tmp_path / "docs"), str(tmp_path / "events")
    site = _site(spark, "SPEC-1.pdf")
    body = b"%PDF-1.4\nkept\n%%EOF"
    tables = _tables(spark, [(D1, body)])
    for _ in range(2):
        store_run(_run(spark, site, tables, store.read()), tables[2], store, docs, log)
    latest = documents.latest_documents(spark, docs, store.runs())
    assert [bytes(r["content"]) for r in documents.document_contents(spark, docs, latest).collect()] == [body]
    assert "download_success" in {r["event_type"] for r in read_events(spark, log).collect()}


def test_the_latest_body_is_that_of_the_last_committed_run(spark, tmp_path):
    store, docs = ManifestStore(spark, str(tmp_path / "manifest")), str(tmp_path / "docs")
    for n in (2, 9, 10, 11):
        rows = spark.createDataFrame([("a.pdf", "https://a/a.pdf", str(n), b"x")],
                                     "filename string, url string, checksum string, content binary")
        documents.write_documents(rows, docs, f"batch-{n}")
        if n < 11:  # the last one is never committed
            store.append(empty_manifest(spark), f"batch-{n}")
    assert documents.latest_documents(spark, docs, store.runs()).first()["run_id"] == "batch-10"


def test_repeated_observations_count_once(spark, tmp_path):
    site = _site(spark, "SPEC-1.pdf")
    good, cut = b"%PDF-1.4\nwhole\n%%EOF", b"%PDF-1.4\nlonger, but cut off"
    heads = [(D1, "20", JAN1, None), (D1, "20", JAN1, None), (D1, None, None, "timed out")]
    failed = spark.createDataFrame([(0, ROOT, None, None, "reset")], schemas.PAGES)
    tables = _tables(spark, [(D1, cut), (D1, good), (D1, b"%PDF-1.4\n%%EOF")], heads)
    run = _run(spark, site.unionByName(site).unionByName(failed), tables, empty_manifest(spark))
    entry = run.new_entries.collect()
    assert [(r["url"], r["size"], r["checksum"]) for r in entry] == [
        (D1, len(good), hashlib.sha256(good).hexdigest())]
    assert sorted(r["event_type"] for r in run.events.collect()) == [
        "crawl_complete", "crawl_success", "download_success"]
    store = ManifestStore(spark, str(tmp_path / "store"))
    store_run(run, tables[2], store, str(tmp_path / "docs"), str(tmp_path / "events"))
    kept = documents.document_contents(
        spark, str(tmp_path / "docs"), documents.latest_documents(spark, str(tmp_path / "docs")))
    assert [bytes(r["content"]) for r in kept.collect()] == [good]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_change_decision_joins_from_the_candidates(spark):
    docs = spark.createDataFrame([(D1,)], "url string")
    heads = change.head_observations(spark.createDataFrame([(D1, "5", JAN1, None)], schemas.HEADS))
    stored = spark.createDataFrame([], schemas.STORED)
    decided = change.change_decision(change.candidates(docs), empty_manifest(spark), stored, heads)
    assert "FullOuter" not in _plan(decided)
    full = change.full_decision(change.candidates(docs), heads)
    assert [(r["decision"], r["reason"]) for r in full.collect()] == [("fetch", "full_run")]
    assert "known" not in _plan(full) and "on_disk" not in _plan(full)


def test_duplicate_files_hash_bodies_once(spark, tmp_path):
    spark.createDataFrame([("a", b"1"), ("b", b"1"), ("c", b"2")], "filename string, content binary"
                          ).write.parquet(str(tmp_path / "files"))
    hashed = spark.read.parquet(str(tmp_path / "files")).select(
        content.content_checksum(F.col("content")).alias("checksum"), "filename",
        F.octet_length("content").cast("bigint").alias("size"))
    found = reports.duplicate_files(hashed)
    assert "content" not in _plan(found) and "sha2" not in _plan(found)
    assert sorted((r["filename"], r["is_keeper"]) for r in found.collect()) == [("a", True), ("b", False)]
