import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docflow import reliable, schemas
from docflow.operators import crawl, outcome
from docflow.sources import documents, events, manifests, storage, tables


def _entry(i):
    return {"url": f"https://h/{i}.pdf", "size": i, "checksum": "c", "last_modified": None if i % 2 else "d",
            "downloaded_at": "2025-01-01T10:00:00.000123", "local_path": f"pdfs/{i}.pdf"}


@pytest.mark.parametrize("indent", [2, None])
def test_manifest_json(spark, tmp_path, indent):
    file = tmp_path / "m.json"
    file.write_text(json.dumps({f'na"m}}e {i}.pdf': _entry(i) for i in range(300)}, indent=indent))
    rows = manifests.read_manifest_json(spark, str(file)).orderBy("size").collect()
    assert len(rows) == 300
    assert rows[7].asDict() == {
        "filename": 'na"m}e 7.pdf', "url": "https://h/7.pdf", "size": 7, "checksum": "c",
        "last_modified": None, "downloaded_at": datetime(2025, 1, 1, 10, 0, 0, 123), "local_path": "pdfs/7.pdf"}


def test_manifest_json_is_split_over_tasks(spark, tmp_path):
    file = tmp_path / "m.json"
    file.write_text(json.dumps({f"{i}.pdf": _entry(i) for i in range(5000)}, indent=2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        rows = manifests.read_manifest_json(spark, str(file))
        assert rows.rdd.getNumPartitions() > 4
        assert rows.select("filename").distinct().count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_missing_or_corrupt_manifest_is_empty(spark, tmp_path):
    text = json.dumps({f"{i}.pdf": _entry(i) for i in range(9)}, indent=2)
    bad = {"cut": text[:-40], "cut_after_entry": text[:-2], "noise": "not json", "open": "{", "half": text[: len(text) // 2],
           "middle": text.replace('"size": 4', '"size": four "'), "compact": json.dumps({"a": _entry(1)})[:-3]}
    assert manifests.read_manifest_json(spark, str(tmp_path / "none.json")).count() == 0
    for name, content in bad.items():
        file = tmp_path / f"{name}.json"
        file.write_text(content)
        assert manifests.read_manifest_json(spark, str(file)).count() == 0, name
    for name, content in {"empty_map": "{}", "blank": ""}.items():
        file = tmp_path / f"{name}.json"
        file.write_text(content)
        assert manifests.read_manifest_json(spark, str(file)).count() == 0


def _manifest(spark, rows):
    return spark.createDataFrame([(f, f"u/{f}", s, None, None, None, None) for f, s in rows], schemas.MANIFEST)


def test_manifest_store(spark, tmp_path):
    store = manifests.ManifestStore(spark, str(tmp_path / "store"))
    assert store.read().count() == 0
    sizes = lambda: {r["filename"]: r["size"] for r in store.read().collect()}
    store.append(_manifest(spark, [("a", 1), ("b", 1)]), "r1")
    store.append(_manifest(spark, [("b", 2), ("c", 2)]), "r2")
    assert sizes() == {"a": 1, "b": 2, "c": 2}
    store.append(_manifest(spark, [("a", 99)]), "r1")  # a repeated run is left alone
    assert sizes() == {"a": 1, "b": 2, "c": 2}
    store.compact("k1")
    assert len(store.commits()[0]) == 1 and sizes() == {"a": 1, "b": 2, "c": 2}
    store.append(_manifest(spark, [("a", 3)]), "r3")
    assert sizes() == {"a": 3, "b": 2, "c": 2}
    # Data of a run that died before its commit is not seen, and is replaced later.
    _manifest(spark, [("a", 77)]).withColumn("seq", F.lit(5).cast("bigint")).write.parquet(
        str(tmp_path / "store" / "runs" / f"{store.commits()[0][-1].seq + 1}-r4"))
    assert sizes()["a"] == 3
    store.append(_manifest(spark, [("a", 4)]), "r4")
    assert sizes()["a"] == 4


def test_event_log_forms(spark, tmp_path):
    newer = [{"timestamp": 1735689600.25, "event_type": "crawl_success", "url": "https://h/"},
             {"timestamp": 1735689601.5, "event_type": "crawl_complete", "pdf_count": 2}]
    older = [{"stage": "upload_ok", "file": "a.pdf", "size": 3, "checksum": "c"},
             {"stage": "download_error", "file": "a.pdf", "error": "x", "retry_count": 0}]
    for name, log, indent in (("n", newer, 2), ("o", older, 2), ("c", newer, None)):
        (tmp_path / name).write_text(json.dumps(log, indent=indent))
    rows = events.read_event_array(spark, str(tmp_path / "n"), "r").collect()
    assert [(r.timestamp, r.event_type, r.url, r.pdf_count) for r in rows] == [
        (datetime(2025, 1, 1, 0, 0, 0, 250000), "crawl_success", "https://h/", None),
        (datetime(2025, 1, 1, 0, 0, 1, 500000), "crawl_complete", None, 2)]
    assert events.read_event_array(spark, str(tmp_path / "c"), "r").collect() == rows
    old = events.read_event_array(spark, str(tmp_path / "o"), "r").collect()
    assert [(r.event_type, r.size, r.retry_count) for r in old] == [
        ("upload_ok", 3, None), ("download_error", None, 0)]
    log = events.read_event_array(spark, str(tmp_path / "n"), "run-7")
    for kind in ("parquet", "json"):
        path = str(tmp_path / f"log-{kind}")
        events.write_events(log, path, kind)
        events.write_events(log.withColumn("run_id", F.lit("run-8")), path, kind)
        back = events.read_events(spark, path, kind)
        assert back.schema == schemas.EVENTS
        assert sorted(back.filter("run_id = 'run-7'").collect()) == sorted(log.collect())
        assert back.count() == 4


def test_documents(spark, tmp_path):
    folder = tmp_path / "files" / "sub"
    folder.mkdir(parents=True)
    (folder / "a.pdf").write_bytes(b"12345")
    (folder / "b.pdf").write_bytes(b"1" * 100)
    stored = documents.stored_files(spark, str(tmp_path / "files"))
    assert {tuple(r) for r in stored.collect()} == {("a.pdf", 5), ("b.pdf", 100)}
    assert "content" not in stored._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    small = documents.read_folder(spark, str(tmp_path / "files"), 10)
    assert [(r.filename, bytes(r.content)) for r in small.collect()] == [("a.pdf", b"12345")]
    assert "PushedFilters: [IsNotNull(length), LessThanOrEqual(length,10)]" in (
        small._jdf.queryExecution().executedPlan().toString())


def test_document_store(spark, tmp_path):
    path = str(tmp_path / "store")
    ok = lambda *u: spark.createDataFrame([(x, "success") for x in u], "url string, status string")
    bodies = lambda *rows: spark.createDataFrame(list(rows), schemas.BODIES)
    first = bodies(("https://a/x.pdf", b"1"), ("https://b/x.pdf", b"2"), ("https://a/y.pdf", b"3"), ("https://a/z.pdf", b"4"))
    documents.write_documents(
        documents.select_stored(first, ok("https://a/x.pdf", "https://b/x.pdf", "https://a/y.pdf")), path, "r1")
    documents.write_documents(
        documents.select_stored(bodies(("https://a/y.pdf", b"5")), ok("https://a/y.pdf")), path, "r2")
    latest = documents.latest_documents(spark, path)
    assert {r["filename"]: (r["url"], r["run_id"]) for r in latest.collect()} == {
        "x.pdf": ("https://b/x.pdf", "r1"), "y.pdf": ("https://a/y.pdf", "r2")}
    content = documents.document_contents(spark, path, latest)
    assert {r["filename"]: bytes(r["content"]) for r in content.collect()} == {"x.pdf": b"2", "y.pdf": b"5"}


def test_tables_round_trip(spark, tmp_path):
    for name, read, schema in (
        ("pages", tables.read_pages, schemas.PAGES), ("heads", tables.read_heads, schemas.HEADS),
        ("attempts", tables.read_attempts, schemas.ATTEMPTS), ("bodies", tables.read_bodies, schemas.BODIES),
    ):
        path = str(tmp_path / name)
        tables.conform(spark.createDataFrame([("https://h/",)], "url string"), schema).write.parquet(path)
        assert read(spark, path).schema == schema and read(spark, path).first()["url"] == "https://h/"
    spark.createDataFrame([(1, "u", "h")], "page_id bigint, url string, html string").write.parquet(str(tmp_path / "bare"))
    assert tables.read_pages(spark, str(tmp_path / "bare")).first().status_code is None


def test_profiles_round_trip(spark, tmp_path):
    page = spark.createDataFrame([(1, "u", "<title>t</title>x", 200, None)], schemas.PAGES)
    profile = crawl.page_profile(page)
    tables.write_profiles(profile, str(tmp_path / "p"))
    assert tables.read_profiles(spark, str(tmp_path / "p")).collect() == profile.collect()


def test_storage_uri():
    assert storage.storage_uri("s3", "b", "/p/q/") == "s3a://b/p/q"
    assert storage.storage_uri("gcs", "b") == "gs://b"
    assert storage.storage_uri("azure", "c", "p", account="acct") == "abfss://c@acct.dfs.core.windows.net/p"
    assert storage.storage_uri("local", prefix="/data/x/") == "/data/x"
    for args in (("ftp", "b"), ("s3", ""), ("azure", "c")):
        with pytest.raises(ValueError):
            storage.storage_uri(*args)


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/unique"


class _Session:
    def __init__(self, master, setting=None, folder=None):
        self.sparkContext = _Context(master, folder)
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}


def test_shared_folder(spark):
    with pytest.raises(ValueError):
        reliable.shared_dir(_Session("yarn"))
    assert reliable.shared_dir(_Session("yarn", "/shared/cp")) == "file:/shared/cp/unique"
    assert reliable.shared_dir(_Session("yarn", "/shared/cp", "file:/other/x")) == "file:/shared/cp/unique"
    assert reliable.shared_dir(_Session("yarn", "/shared/cp", "file:/shared/cp/a")) == "file:/shared/cp/a"
    assert "docflow-checkpoint-" in reliable.shared_dir(_Session("local[2]"))
    assert reliable.shared_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert reliable.new_folder(spark, "x").startswith(reliable.shared_dir(spark))


def test_event_schema_of_derived_events(spark):
    rows = spark.createDataFrame([("crawl_error", "u")], "event_type string, url string")
    assert outcome.as_events(rows, "r", F.current_timestamp()).schema.names == schemas.EVENTS.names


def test_a_body_without_url_is_not_stored(spark):
    bodies = spark.createDataFrame([(None, b"1"), ("https://a/x.pdf", b"2")], "url string, content binary")
    outcomes = spark.createDataFrame([(None, "success"), ("https://a/x.pdf", "success")], "url string, status string")
    assert [r.url for r in documents.select_stored(bodies, outcomes).collect()] == ["https://a/x.pdf"]
