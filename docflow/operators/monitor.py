"""Alert windows over the event log and over metric series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.operators import skew
from docflow.operators.reports import ERROR_EVENTS, SUCCESS_EVENTS


def error_rate_windows(
    events: DataFrame, width: str = "1 hour", threshold: float = 0.10, watermark: str | None = None
) -> DataFrame:
    """Events, errors, error rate and alert flag per tumbling window.

    Batch or stream; a stream names the `watermark` after which late rows are dropped.
    """
    rows = events if watermark is None else events.withWatermark("timestamp", watermark)
    errors = F.col("event_type").isin(*ERROR_EVENTS)
    counted = rows.groupBy(F.window("timestamp", width)).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(errors).alias("errors")
    )
    rate = F.col("errors") / F.col("events")
    return counted.select(
        F.col("window.start").alias("window_start"),
        "events",
        "errors",
        rate.alias("error_rate"),
        (rate > threshold).alias("alert"),
    )


def rate_windows(events: DataFrame, width: str = "1 minute", watermark: str | None = None) -> DataFrame:
    """Stored files per tumbling window; windows without events are absent (see `fill_windows`)."""
    rows = events if watermark is None else events.withWatermark("timestamp", watermark)
    return (
        rows.groupBy(F.window("timestamp", width))
        .agg(F.count_if(F.col("event_type").isin(*SUCCESS_EVENTS)).alias("files"))
        .select(F.col("window.start").alias("window_start"), "files")
    )


def fill_windows(windows: DataFrame, width_seconds: int = 60) -> DataFrame:
    """Adds the missing windows between the first and the last one, with zero files.

    The gaps are filled in stretches of about an hour, each a multiple of the width counted from
    the first window, so no single array spans the whole log and every width keeps its grid.
    """
    stretch = width_seconds * max(1, 3600 // width_seconds)
    seconds = F.unix_seconds("window_start")
    span = windows.agg(F.min(seconds).alias("lo"), F.max(seconds).alias("hi")).filter("lo IS NOT NULL")
    starts = span.select("hi", F.explode(F.sequence("lo", "hi", F.lit(stretch).cast("bigint"))).alias("at"))
    last = F.least(F.col("hi"), F.col("at") + stretch - width_seconds)
    grid = F.sequence("at", last, F.lit(width_seconds).cast("bigint"))
    spine = starts.repartition("at").select(F.explode(F.transform(grid, F.timestamp_seconds)).alias("window_start"))
    return spine.join(windows, "window_start", "left").fillna(0, ["files"]).withColumn(
        "files_per_second", F.col("files") / F.lit(float(width_seconds))
    )


def sustained_breach(
    series: DataFrame,
    breached: Column,
    min_seconds: int,
    keys: list[str] | None = None,
    ts: str = "ts",
    hot_rows: int = skew.HOT_ROWS,
) -> DataFrame:
    """Runs of consecutive samples in breach that last longer than `min_seconds`.

    Output per run: keys, first and last breached sample, number of samples. An instant with
    samples on both sides counts as not in breach.

    Samples are never sorted per series. Time is cut into buckets as long as the wanted
    duration: a run inside a bucket, ended on both sides, is too short to matter, so a bucket
    comes down to the samples before its first and after its last sample not in breach, or to
    all of them. Two aggregates (combined before the shuffle) yield these pieces, and only
    the pieces, a few per bucket of calendar time, are put in order and joined into runs.
    """
    keys = keys or []
    # As a struct, a null key is a key like any other in the join below.
    which = F.struct(*keys) if keys else F.lit(0)
    bucket_keys = ["_series", "_bucket"]
    rows = series.filter(F.col(ts).isNotNull()).select(
        which.alias("_series"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"),
        F.coalesce(breached, F.lit(False)).alias("_bad"),
    ).withColumn("_bucket", F.floor(F.col("_at") / F.lit(min_seconds * 1_000_000)))

    good = F.when(~F.col("_bad"), F.col("_at"))
    limits = rows.groupBy(*bucket_keys).agg(F.min(good).alias("_good"), F.max(good).alias("_good_end"))
    bad_rows = rows.filter("_bad").drop("_bad")
    placed = skew.lookup_join(bad_rows, limits, bucket_keys, ["_at"], "left", hot_rows)
    piece = (
        F.when(F.col("_good").isNull(), "whole")
        .when(F.col("_at") < F.col("_good"), "head")
        .when(F.col("_at") > F.col("_good_end"), "tail")
    )
    pieces = (
        placed.withColumn("_piece", piece)
        .filter(F.col("_piece").isNotNull())
        .groupBy(*bucket_keys, "_piece")
        .agg(
            F.min("_at").alias("_start"),
            F.max("_at").alias("_end"),
            F.count(F.lit(1)).alias("_samples"),
        )
    )
    breaks = limits.filter(F.col("_good").isNotNull()).select(
        *bucket_keys,
        F.lit("break").alias("_piece"),
        F.col("_good").alias("_start"),
        F.col("_good_end").alias("_end"),
        F.lit(0).cast("bigint").alias("_samples"),
    )
    # A piece belongs to the last break before it. Only a bucket's tail lies behind the break
    # of its own bucket.
    before = Window.partitionBy("_series").orderBy("_start").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    runs = (
        pieces.unionByName(breaks)
        .withColumn(
            "_run", F.max(F.when(F.col("_piece") == "break", F.col("_start"))).over(before)
        )
        .filter(F.col("_piece") != "break")
        .groupBy("_series", "_run")
        .agg(
            F.timestamp_micros(F.min("_start")).alias("run_start"),
            F.timestamp_micros(F.max("_end")).alias("run_end"),
            F.sum("_samples").alias("samples"),
        )
    )
    seconds = (F.unix_micros("run_end") - F.unix_micros("run_start")) / F.lit(1e6)
    return (
        runs.withColumn("duration_seconds", seconds)
        .filter(F.col("duration_seconds") > min_seconds)
        .select(*[F.col("_series")[k].alias(k) for k in keys],
                "run_start", "run_end", "samples", "duration_seconds")
    )


def slow_download_alerts(
    events: DataFrame, min_rate: float = 1.0, min_seconds: int = 1800
) -> DataFrame:
    """Spans in which fewer than `min_rate` files per second were stored, minute by minute."""
    minutes = fill_windows(rate_windows(events))
    return sustained_breach(
        minutes, F.col("files_per_second") < min_rate, min_seconds, ts="window_start"
    )
