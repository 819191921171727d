"""Summaries of outcomes, manifest and event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions import content
from docflow.operators import skew
from docflow.reliable import saved

# Which events count as stored and as failed.
SUCCESS_EVENTS = ("download_success", "upload_ok")
ERROR_EVENTS = (
    "crawl_error", "size_error", "validation_error", "download_error", "upload_error",
)


def outcome_counts(results: DataFrame) -> DataFrame:
    """Rows per status."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def success_rate(results: DataFrame) -> DataFrame:
    """Share of results with success; null where there are none."""
    return results.agg(
        F.count(F.lit(1)).alias("results"),
        F.avg((F.col("status") == "success").cast("double")).alias("success_rate"),
    )


def run_summary(
    visited: DataFrame,
    documents: DataFrame,
    results: DataFrame,
    manifest: DataFrame,
    duration_seconds: Column,
    output: str,
    mode: str = "incremental",
) -> DataFrame:
    """One row per run. Counts are per file name, documents found per URL.

    The per-file results stay a table of their own; the row carries their counts by status,
    a map with as many entries as there are statuses.
    """
    one = F.count(F.lit(1))
    by_status = results.groupBy("status").agg(one.alias("n"))
    counts = by_status.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias(
            "status_counts"
        )
    )
    n = lambda status: F.coalesce(
        F.try_element_at("status_counts", F.lit(status)), F.lit(0)
    ).cast("bigint")
    return counts.select(
        duration_seconds.cast("double").alias("duration_seconds"),
        visited.agg(one).scalar().alias("pages_visited"),
        documents.agg(one).scalar().alias("pdfs_found"),
        "status_counts",
        n("success").alias("success_count"),
        n("skipped_unchanged").alias("skipped_count"),
        manifest.agg(one).scalar().alias("total_files_tracked"),
        F.lit(mode == "incremental").alias("incremental_mode"),
        F.lit(output).alias("output_directory"),
    )


def incremental_status(manifest: DataFrame, location: str) -> DataFrame:
    """Tracked files, their size in MiB and the latest download; one row."""
    totals = manifest.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("_size"),
        F.max("downloaded_at").alias("_latest"),
    )
    some = F.col("total_files") > 0
    return totals.select(
        "total_files",
        F.when(some, content.mebibytes(F.col("_size"))).alias("total_size_mb"),
        F.when(some, F.col("_latest")).alias("latest_download"),
        F.when(some, F.lit(location)).alias("metadata_file"),
        F.when(some, "ready_for_incremental").otherwise("no_previous_downloads").alias("status"),
    )


def throughput(events: DataFrame) -> DataFrame:
    """Stored files per second, MiB, failures, over the span of the log."""
    ok = F.col("event_type").isin(*SUCCESS_EVENTS)
    totals = events.agg(
        F.count_if(ok).alias("files"),
        F.count_if(F.col("event_type").isin(*ERROR_EVENTS)).alias("failures"),
        F.coalesce(F.sum(F.when(ok, F.col("size"))), F.lit(0)).alias("_size"),
        ((F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))) / F.lit(1e6)).alias(
            "_seconds"
        ),
    )
    return totals.select(
        "files",
        "failures",
        content.mebibytes(F.col("_size")).alias("total_size_mb"),
        F.coalesce("_seconds", F.lit(0.0)).alias("duration_seconds"),
        F.when(F.col("_seconds") > 0, F.col("files") / F.col("_seconds"))
        .otherwise(F.lit(0.0))
        .alias("files_per_second"),
    )


def error_pattern(error: Column) -> Column:
    """Message with URLs and numbers replaced, so that equal causes look equal."""
    no_urls = F.regexp_replace(error, r"[A-Za-z][A-Za-z0-9+.\-]*://[^\s'\")]+", "<url>")
    return F.regexp_replace(no_urls, r"[0-9]+", "<n>")


def error_patterns(events: DataFrame) -> DataFrame:
    """Failed events by type and message pattern, with first and last time seen."""
    return (
        events.filter(F.col("error").isNotNull())
        .groupBy("event_type", error_pattern(F.col("error")).alias("pattern"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
            F.approx_count_distinct("file").alias("approx_files"),
        )
    )


def processing_stats(events: DataFrame) -> DataFrame:
    """Time from first to last event of a file, and success and failure rates of the log."""
    ok, failed = (F.col("event_type").isin(*e) for e in (SUCCESS_EVENTS, ERROR_EVENTS))
    files = events.filter(F.col("file").isNotNull()).groupBy("file").agg(
        F.min("timestamp").alias("_first"),
        F.max("timestamp").alias("_last"),
        F.count_if(ok).alias("_ok"),
        F.count_if(failed).alias("_failed"),
    )
    seconds = (F.unix_micros("_last") - F.unix_micros("_first")) / F.lit(1e6)
    settled = F.sum("_ok") + F.sum("_failed")
    return files.withColumn("_seconds", seconds).agg(
        F.count(F.lit(1)).alias("files"),
        F.avg("_seconds").alias("avg_seconds"),
        F.percentile_approx("_seconds", 0.5).alias("median_seconds"),
        F.percentile_approx("_seconds", 0.95).alias("p95_seconds"),
        F.try_divide(F.sum("_ok"), settled).alias("success_rate"),
        F.try_divide(F.sum("_failed"), settled).alias("failure_rate"),
    )


def daily_trend(events: DataFrame) -> DataFrame:
    """Stored files and bytes per day with the change from the day before in the log.

    Windows over the whole table see one row per day, a number that calendar time bounds.
    """
    by_day = events.filter(F.col("event_type").isin(*SUCCESS_EVENTS)).groupBy(
        F.to_date("timestamp").alias("day")
    ).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))
    days = Window.orderBy("day")
    return by_day.select(
        "day",
        "files",
        "bytes",
        (F.col("files") - F.lag("files").over(days)).alias("files_delta"),
        (F.col("bytes") - F.lag("bytes").over(days)).alias("bytes_delta"),
    )


def storage_growth(manifest: DataFrame, quota_bytes: int, alert_share: float = 0.8) -> DataFrame:
    """Bytes per day of download, running total, share of the quota and alert flag."""
    by_day = manifest.groupBy(F.to_date("downloaded_at").alias("day")).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    )
    so_far = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    grown = by_day.withColumn("total_bytes", F.sum("bytes").over(so_far))
    share = F.col("total_bytes") / F.lit(float(quota_bytes))
    return grown.withColumns({"quota_share": share, "over_quota_alert": share > alert_share})


def storage_tiers(manifest: DataFrame, as_of: Column) -> DataFrame:
    """Files and bytes per storage tier."""
    return manifest.groupBy(
        content.storage_tier(F.col("downloaded_at"), as_of).alias("tier")
    ).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"))


def duplicate_content(documents: DataFrame) -> DataFrame:
    """Checksums held by several files: copies, the one to keep, and bytes to be saved."""
    return (
        documents.groupBy("checksum")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("filename").alias("keeper"),
            (F.sum("size") - F.max("size")).alias("wasted_bytes"),
        )
        .filter("copies > 1")
    )


def duplicate_files(documents: DataFrame, hot_rows: int = skew.HOT_ROWS) -> DataFrame:
    """Every file whose content another file has too, and whether it is the one to keep.

    The checksums are written once, so each body is read and hashed once.
    """
    documents = saved(documents.select("checksum", "filename", "size"), "checksums")
    found = skew.lookup_join(
        documents, duplicate_content(documents), ["checksum"], ["filename"], "inner", hot_rows
    )
    return found.select(
        "checksum", "filename", "size", "copies",
        (F.col("filename") == F.col("keeper")).alias("is_keeper"),
    )


def collection_profile(resources: DataFrame) -> DataFrame:
    """Files and bytes by category and size band, with subtotals and total."""
    return (
        resources.rollup("category", "band")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("size").alias("bytes"),
            F.grouping_id().alias("level"),
        )
    )
