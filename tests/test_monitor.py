import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docflow import schemas
from docflow.operators import monitor, reports, skew

T0 = datetime(2025, 1, 1)


def _runs(samples, min_seconds):
    """Consecutive breached instants per series, the plain way."""
    out, instants = [], {}
    for key, t, bad in samples:
        instants.setdefault((key, t), []).append(bad)
    by_key = {}
    for (key, t), flags in instants.items():
        by_key.setdefault(key, []).append((t, all(flags), len(flags)))
    for key, rows in by_key.items():
        run = []
        for t, bad, n in sorted(rows, key=lambda r: r[0]) + [(None, False, 0)]:
            if bad:
                run.append((t, n))
            elif run:
                seconds = (run[-1][0] - run[0][0]).total_seconds()
                if seconds > min_seconds:
                    out.append((key, run[0][0], run[-1][0], sum(n for _, n in run), seconds))
                run = []
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,share,hot_rows", [(0, 0.5, 10**6), (1, 0.9, 10**6), (2, 0.97, 10), (3, 1.0, 5)])
def test_sustained_breach_equals_plain_scan(spark, seed, share, hot_rows):
    rng = random.Random(seed)
    samples = [
        (rng.choice(["a", "a", "b", None]), T0 + timedelta(seconds=rng.randrange(20000)), rng.random() < share)
        for _ in range(1500)
    ]
    df = spark.createDataFrame(samples, "k string, ts timestamp, bad boolean").repartition(5)
    got = monitor.sustained_breach(df, F.col("bad"), 300, ["k"], hot_rows=hot_rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == _runs(samples, 300)


def test_sustained_breach_without_key(spark):
    rows = [(T0 + timedelta(minutes=m), v) for m, v in enumerate([600] * 32 + [400] + [600] * 30)]
    df = spark.createDataFrame(rows, "ts timestamp, mb int")
    got = monitor.sustained_breach(df, F.col("mb") > 500, 1800).collect()
    assert [(r.run_start, r.run_end, r.samples) for r in got] == [(T0, T0 + timedelta(minutes=31), 32)]


def _events(spark, rows):
    return spark.createDataFrame(rows, "timestamp timestamp, event_type string, file string, "
                                       "error string, size bigint")


def test_windows(spark):
    rows = [(T0 + timedelta(minutes=m), "download_success", f"f{m}", None, 2**20) for m in range(0, 50, 10)]
    rows += [(T0 + timedelta(minutes=5), "download_error", "g", "HTTP 503 at https://h/1", None)]
    rows += [(T0 + timedelta(hours=2), "download_success", "z", None, 2**20)]
    events = _events(spark, rows)
    hours = {r.window_start: r for r in monitor.error_rate_windows(events).collect()}
    assert hours[T0].alert and hours[T0].error_rate == pytest.approx(1 / 6)
    assert not hours[T0 + timedelta(hours=2)].alert
    minutes = monitor.fill_windows(monitor.rate_windows(events)).orderBy("window_start").collect()
    assert len(minutes) == 121 and sum(r.files for r in minutes) == 6
    assert [r.window_start for r in minutes] == [T0 + timedelta(minutes=i) for i in range(121)]
    alerts = monitor.slow_download_alerts(events).collect()
    assert [(r.run_start, r.samples) for r in alerts] == [(T0, 121)]


def test_reports_on_events(spark):
    rows = [
        (T0, "download_retry", "a", "timeout after 10 s at https://h/a.pdf", None),
        (T0 + timedelta(seconds=4), "download_success", "a", None, 2**20),
        (T0 + timedelta(seconds=6), "download_retry", "b", "timeout after 99 s at https://h/b.pdf", None),
        (T0 + timedelta(seconds=10), "download_error", "b", "timeout after 7 s at https://h/b.pdf", None),
    ]
    events = _events(spark, rows)
    tp = reports.throughput(events).first()
    assert (tp.files, tp.failures, tp.total_size_mb, tp.files_per_second) == (1, 1, 1.0, 0.1)
    assert reports.throughput(events.limit(0)).first().files_per_second == 0.0
    patterns = {(r.event_type, r.pattern): (r.n, r.approx_files) for r in reports.error_patterns(events).collect()}
    text = "timeout after <n> s at <url>"
    assert patterns == {("download_retry", text): (2, 2), ("download_error", text): (1, 1)}
    stats = reports.processing_stats(events).first()
    assert (stats.files, stats.avg_seconds, stats.success_rate, stats.failure_rate) == (2, 4.0, 0.5, 0.5)
    assert reports.success_rate(spark.createDataFrame([], "status string")).first().success_rate is None


def test_growth_and_duplicates(spark):
    manifest = spark.createDataFrame(
        [(f"f{i}", "u", 100, "c", None, T0 + timedelta(days=i // 2), None) for i in range(6)], schemas.MANIFEST)
    grown = reports.storage_growth(manifest, 600).orderBy("day").collect()
    assert [(r.total_bytes, r.over_quota_alert) for r in grown] == [(200, False), (400, False), (600, True)]
    docs = spark.createDataFrame([("x", "s", 10), ("y", "s", 10), ("z", "t", 5)],
                                 "filename string, checksum string, size bigint")
    assert [tuple(r) for r in reports.duplicate_content(docs).collect()] == [("s", 2, "x", 10)]


def test_lookup_with_a_hot_key(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(40)], "k string, v int")
    plain = sorted(map(tuple, left.join(right, "k", "left").select("k", "id", "v").collect()), key=str)
    for hot_rows in (10**6, 500, 1):
        joined = skew.lookup_join(left, right, ["k"], ["id"], "left", hot_rows, slices=8)
        assert sorted(map(tuple, joined.select("k", "id", "v").collect()), key=str) == plain
        kept = skew.lookup_join(left, right, ["k"], ["id"], "left_semi", hot_rows, slices=8)
        assert kept.count() == left.join(right, "k", "left_semi").count()
    # One listed key suffices: keys beyond the bound are joined unspread.
    bounded = skew.lookup_join(left, right, ["k"], ["id"], "left", 1, hot_keys=1, slices=8)
    assert sorted(map(tuple, bounded.select("k", "id", "v").collect()), key=str) == plain
    hot = skew.heavy_keys(left, ["k"], 500)
    slices = skew.sliced(left, hot, ["k"], ["id"], 8).groupBy("k").agg(F.count_distinct("_slice").alias("n"))
    assert {r["k"]: r["n"] for r in slices.filter("n > 1").collect()} == {"hot": 8}


def test_latest_by_takes_one_whole_row(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "x")],
                                 "k string, n int, v string")
    assert sorted(map(tuple, skew.latest_by(rows, ["k"], ["n"]).collect())) == [("a", 3, "z"), ("b", 1, "x")]


@pytest.mark.parametrize("minutes", [1, 7, 60, 90, 120])
def test_filled_windows_of_any_width(spark, minutes):
    times = [datetime(2025, 1, 1, 0, 5) + timedelta(minutes=m) for m in (0, 3, 200, 201, 777, 1500)]
    events = spark.createDataFrame([(t, "download_success") for t in times], "timestamp timestamp, event_type string")
    rows = monitor.fill_windows(monitor.rate_windows(events, f"{minutes} minutes"), minutes * 60).collect()
    starts = sorted(r["window_start"] for r in rows)
    assert sum(r["files"] for r in rows) == len(times)
    assert {b - a for a, b in zip(starts, starts[1:])} <= {timedelta(minutes=minutes)}
    assert len(starts) == len(set(starts))
