from datetime import datetime, timedelta

from pyspark.sql import functions as F

from docflow import schemas
from docflow.operators import monitor
from docflow.sources import documents
from docflow.sources.events import read_events
from docflow.sources.manifests import ManifestStore
from docflow.streaming import alerts, incremental

T0 = datetime(2025, 1, 1)


def _write(spark, path, rows):
    spark.createDataFrame(rows, schemas.OBSERVATIONS).coalesce(1).write.mode("append").parquet(path)


def _row(name, text, day, date="d1", error=None, length=None):
    body = b"%PDF-1.4\n" + text.encode() + b"\n%%EOF"
    return (f"https://h/{name}.pdf", length or str(len(body)), date, error, None if error else body,
            T0 + timedelta(days=day))


def _sizes(store):
    return {r["filename"]: (r["size"], r["downloaded_at"].day) for r in store.read().collect()}


def test_incremental_stream(spark, tmp_path):
    source, where, checkpoint = (str(tmp_path / n) for n in ("in", "store", "cp"))
    store = ManifestStore(spark, where)

    def advance(rows):
        _write(spark, source, rows)
        stream = spark.readStream.schema(schemas.OBSERVATIONS).parquet(source)
        incremental.incremental_stream(stream, where, checkpoint).awaitTermination()

    advance([_row("a", "1", 0), _row("b", "22", 0), _row("c", "1", 0, error="timed out"),
             _row("a", "0", -1)])  # the later observation of a URL counts
    assert _sizes(store) == {"a.pdf": (16, 1), "b.pdf": (17, 1)}
    advance([_row("a", "1", 1), _row("b", "22 more", 1), _row("c", "1", 1)])
    assert _sizes(store) == {"a.pdf": (16, 1), "b.pdf": (22, 2), "c.pdf": (16, 2)}
    commits = len(store.commits()[0])
    advance([_row("a", "1", 2), _row("b", "22 more", 2)])  # nothing new: an empty run
    assert _sizes(store) == {"a.pdf": (16, 1), "b.pdf": (22, 2), "c.pdf": (16, 2)}
    assert len(store.commits()[0]) == commits + 1


def test_a_batch_delivered_twice_counts_once(spark, tmp_path):
    store = ManifestStore(spark, str(tmp_path / "store"))
    docs = str(tmp_path / "docs")
    rows = spark.createDataFrame([_row("a", "1", 0), _row("a", "older", -1)], schemas.OBSERVATIONS)
    other = spark.createDataFrame([_row("a", "123", 5)], schemas.OBSERVATIONS)
    incremental.process_batch(rows, store, "batch-0", documents_path=docs)
    incremental.process_batch(other, store, "batch-0", documents_path=docs)
    assert _sizes(store) == {"a.pdf": (16, 1)}
    bodies = documents.document_contents(spark, docs, documents.latest_documents(spark, docs))
    assert [bytes(r["content"]) for r in bodies.collect()] == [b"%PDF-1.4\n1\n%%EOF"]
    incremental.process_batch(other, store, "batch-1", compact_every=2, documents_path=docs)
    assert _sizes(store) == {"a.pdf": (18, 6)}
    assert [c.kind for c in store.commits()[0]] == ["snapshot"]


def test_repeated_observations(spark, tmp_path):
    source = str(tmp_path / "in")
    for _ in range(3):
        _write(spark, source, [_row("a", "1", 0), _row("b", "1", 0), _row("a", "1", 0, date="d2")])
    stream = spark.readStream.schema(schemas.OBSERVATIONS).option("maxFilesPerTrigger", 1).parquet(source)
    (incremental.distinct_observations(stream).select("url", "last_modified").writeStream
     .format("parquet").option("path", str(tmp_path / "out"))
     .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination())
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(map(tuple, out)) == [
        ("https://h/a.pdf", "d1"), ("https://h/a.pdf", "d2"), ("https://h/b.pdf", "d1")]


def test_alert_streams_equal_batch(spark, tmp_path):
    rows = [("r", T0 + timedelta(minutes=m), "download_error" if m % 7 == 0 else "download_success")
            for m in range(600)]
    log = spark.createDataFrame(rows, "run_id string, timestamp timestamp, event_type string")
    log.write.parquet(str(tmp_path / "in"))
    read = lambda: spark.readStream.schema(log.schema).parquet(str(tmp_path / "in"))
    for start, batch, name in (
        (alerts.error_rate_stream, monitor.error_rate_windows(log), "e"),
        (alerts.rate_stream, monitor.rate_windows(log), "r"),
    ):
        out = str(tmp_path / f"out-{name}")
        start(read(), out, str(tmp_path / f"cp-{name}")).awaitTermination()
        written = spark.read.parquet(out)
        closed = batch.filter(F.col("window_start") <= written.agg(F.max("window_start")).first()[0])
        assert sorted(map(tuple, written.collect())) == sorted(map(tuple, closed.collect()))
        assert written.count() >= 9


def test_stream_leaves_events(spark, tmp_path):
    source, where, checkpoint, log = (str(tmp_path / n) for n in ("in", "store", "cp", "log"))
    bad = ("https://h/bad.pdf", "3", "d1", None, b"no!", T0)
    _write(spark, source, [_row("a", "1", 0), _row("c", "1", 0, error="timed out"), bad,
                           _row("big", "1", 0, length=str(1 << 40))])
    for day in (1, 2):
        stream = spark.readStream.schema(schemas.OBSERVATIONS).parquet(source)
        incremental.incremental_stream(stream, where, checkpoint, events_path=log).awaitTermination()
        got = sorted((r["event_type"], r["file"], r["error"]) for r in read_events(spark, log).collect())
        assert got == sorted([
            ("download_success", "a.pdf", None), ("download_error", "c.pdf", "timed out"),
            ("validation_error", "bad.pdf", "Invalid PDF format"), ("size_error", "big.pdf", "File too large"),
        ] + [("download_success", "z.pdf", None)] * (day - 1))
        _write(spark, source, [_row("a", "1", day), _row("z", "1", day)])
